"""From raw documents to token files: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from uidloom.llm import stages
from uidloom.sources.session import materialize

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", stages.good),
    ("near_dedup", stages.deduplicated),
    ("decontamination", stages.decontaminated),
    ("mixing", stages.mixed),
    ("token_output", stages.tokens),
]

#: The stages learn models, link by signatures and draw copies, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
