"""Exact de-duplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. New rows are grouped by digest, and the groups that the index
does not hold yet are found by a sort-merge anti-join that moves no row of the index. What a batch holds is appended
once, under the batch's name.

Defined results: null text counts as empty; white space is no part of a text; of equal texts the longest row
stays, then the one with the smallest id (null ids last), then one of the fully equal rows. Repeated rows count
as rows. An empty table gives no rows. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from uidloom.sources.session import materialize

WHITE_SPACE = " \t\n\x0b\x0c\r"


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without its white space."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, ""), 256)


def _with_decision(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Each row with what was decided for its text; the rows of a text with many copies stay where they are.

    A text is hot if it has more rows than an average partition, so there are no more hot texts than partitions, and
    these are broadcast.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col("n") * partitions > rows.count()
    hot = F.broadcast(decided.where(is_hot))
    met = rows.join(hot, "text_sha256")
    rest = rows.join(hot.select("text_sha256"), "text_sha256", "left_anti").join(decided.where(~is_hot), "text_sha256")
    return met.unionByName(rest)


class DigestIndex:
    """A table ``(text_sha256, keep_id, n_rows, batch)``: a row per text and batch that held it, with its rows there.

    The first batch of a text says which row stays; later batches only add rows. So ``group_size`` is a sum on reading,
    and a batch that is added again, as after a failed job, is replaced by what was appended the first time.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (text_sha256 STRING, keep_id BIGINT, n_rows BIGINT, batch STRING, "
            f"is_first BOOLEAN) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS"
        )

    def entries(self) -> DataFrame:
        """One row per text: the id that stays, and all rows seen so far."""
        return self._texts(self.spark.table(self.table))

    @staticmethod
    def _texts(rows: DataFrame) -> DataFrame:
        # Grouped by the bucket column, so no row of the index moves.
        return rows.groupBy("text_sha256").agg(
            F.max(F.when(F.col("is_first"), F.col("keep_id"))).alias("keep_id"), F.sum("n_rows").alias("n_rows")
        )

    def add(
        self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None
    ) -> DataFrame:
        """Append what the batch holds, and return one row per row of ``docs``.

        A text that an earlier batch held keeps its row of then, so all its new rows are dropped. ``group_size`` counts
        the equal rows of all batches up to this one. With the name of a batch that is there already nothing is
        appended, and the rows are judged as they were then.
        """
        batch = batch or uuid.uuid4().hex
        text = F.col(text_column)
        rows = materialize(
            docs.select(
                F.col(id_column).cast("bigint").alias("doc_id"),
                text_digest(text).alias("text_sha256"),
                F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
                F.monotonically_increasing_id().alias("row"),
            ),
            "digests",
        )
        best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "row"))
        groups = rows.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("n"))
        index = self.spark.table(self.table)
        again = not index.where(F.col("batch") == batch).isEmpty()
        # Of a batch that is there already, the texts it brought are not known to it.
        earlier = index.where(F.col("batch") != batch)
        if again:
            brought = index.where((F.col("batch") == batch) & F.col("is_first")).select("text_sha256")
            earlier = earlier.join(brought, "text_sha256", "left_anti")
        known = self._texts(earlier).withColumn("known", F.lit(True))
        decided = materialize(
            groups.hint("merge")
            .join(known, "text_sha256", "left")
            .select(
                "text_sha256",
                F.when(F.col("known"), F.col("keep_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
                F.when(F.col("known").isNull(), F.col("best.row")).alias("keep_row"),
                (F.col("n") + F.coalesce("n_rows", F.lit(0))).alias("group_size"),
                "n",
            ),
            "decided",
        )
        if not again:
            texts = decided.hint("merge")
            held = known.select("text_sha256")
            new = texts.join(held, "text_sha256", "left_anti").withColumn("is_first", F.lit(True))
            old = texts.join(held, "text_sha256", "left_semi").withColumn("is_first", F.lit(False))
            (
                new.unionByName(old)
                .select("text_sha256", "keep_id", F.col("n").alias("n_rows"), F.lit(batch).alias("batch"), "is_first")
                .repartition(self.buckets, "text_sha256")
                .write.mode("append")
                .format("parquet")
                .bucketBy(self.buckets, "text_sha256")
                .sortBy("text_sha256")
                .saveAsTable(self.table)
            )
        return _with_decision(rows, decided).select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
            "text_sha256",
        )

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
