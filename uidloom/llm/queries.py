"""The thin queries of the operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from uidloom.llm import (
    decontaminate,
    html_text,
    language,
    mixing,
    near_dedup,
    prefix_trie,
    quality,
    repeats,
    spelling,
    token_count,
    token_output,
    toxicity,
)
from uidloom.llm.exact_dedup import DigestIndex
from uidloom.sources.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.new_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_output.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_output.read_tokens(spark, path)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, may_learn = table(spark, sf_dir, "documents"), quality.may_learn(F.col("doc_id"))
    score = quality.scorer(spark, quality.train(docs, table(spark, sf_dir, "labels"), allowed=may_learn))
    scored = docs.select("doc_id", (~may_learn).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, may_learn = table(spark, sf_dir, "documents"), toxicity.may_learn(F.col("doc_id"))
    score = toxicity.scorer(spark, toxicity.train(docs, table(spark, sf_dir, "labels"), allowed=may_learn))
    scored = docs.select("doc_id", (~may_learn).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, may_learn = table(spark, sf_dir, "documents"), language.may_learn(F.col("doc_id"))
    found = language.identify(docs, language.train(docs, allowed=may_learn))
    return found.select("doc_id", (~may_learn).alias("held_out"), "lang_pred", "score")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts a new index, adds all documents to it, and drops it once the answer is written."""
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    answer = materialize(index.add(table(spark, sf_dir, "documents")), "exact_dedup")
    index.drop()
    return answer


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations start with turns of the first of their twenty, as many as the checksum of their id says."""
    return prefix_trie.conversation_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"), group=20, most=4))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    return token_count.count_tokens(docs, path, limit=1024)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_html_text": op4_html_text,
    "op5_near_dedup": op5_near_dedup,
    "op6_repeats": op6_repeats,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_counts": op12_token_counts,
    "op13_spelling": op13_spelling,
}
