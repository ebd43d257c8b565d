"""The stages of the corpus pipeline. Each takes all documents that the stage before it kept.

All but the last return the columns of documents. Ids may be null or repeated: where near duplicates are removed
documents are told apart by id and text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from uidloom.llm import decontaminate, mixing, near_dedup, quality, token_output
from uidloom.sources.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
QUALITY = 0.7
NEAR_PERCENT = 80


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = quality.scorer(spark, quality.train(docs, labels, allowed=quality.may_learn(F.col("doc_id"))))
    return docs.select(*COLUMNS).where(score("text") >= QUALITY)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null last, then by text.

    Documents are told apart by id and text, not by the id alone: each distinct pair gets a number of its own, in the
    order of ids, and the groups are found among the numbers. Of fully equal pairs one row stays. Documents without
    words are near to nothing, so all their rows stay.
    """
    docs = docs.select(*COLUMNS)
    numbered = materialize(_numbered(docs), "numbered")
    has_words = F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    one = numbered.where(has_words).groupBy("doc_id", "text_key").agg(F.min_by("text", "n").alias("text"), F.min("n").alias("n"))
    found = near_dedup.near_duplicates(one.select(F.col("n").alias("doc_id"), "text"), NEAR_PERCENT)
    stay = materialize(found.where("kept").select(F.col("doc_id").alias("n")), "kept")
    kept = numbered.join(stay, "n", "left_semi")
    return kept.unionByName(numbered.where(~has_words)).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number ``n`` each, ascending by id (null last) and text, and a digest of the text."""
    keyed = docs.withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    order = [F.col("doc_id").isNull(), "doc_id", "text_key"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_matches(docs.select(*COLUMNS), benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources get their target weights."""
    return mixing.repeat_rows(docs, mixing.mix(docs), COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold per document."""
    path = token_output.new_folder(spark, "tokens")
    token_output.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_output.read_tokens(spark, path)
