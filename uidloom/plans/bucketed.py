"""Resolved rows kept in buckets of their users, so that a later run over them moves narrow rows only.

A store is a table bucketed by table, user id and share. The rows of a user with more rows than an average bucket,
and the rows without a user, are cut into shares when they first enter a store; all other rows have share 0. The share
is a column of the store, so a later run needs no list of hot users: it gives each share that occurs the values of its
user, moves these few columns to the buckets, and joins them to the wide rows where those lie.

A store is never changed. A run writes a new one, which the catalog lists only after all of its rows are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from uidloom.operators.resolve import USER, mapped_users, users_after, write_back_by
from uidloom.operators.skew import HotKeys, hot_keys, partition_count, shares_for, shares_of
from uidloom.operators.valid_uuid import choices, set_valid_uuid
from uidloom.sources.session import materialize, scratch

STORED_SHARE = "user_share"
"""Reserved column of a store."""
BY = [*USER, STORED_SHARE]


def dealt(rows: DataFrame, hot_users: dict[str, int]) -> DataFrame:
    """The rows with their share, counted by their place in the task that reads them, so that copies spread too.

    ``rows`` must be read from files or a table: those give a lost task the same rows in the same order again.
    """
    shares = F.when(F.col("user_id").isNull(), shares_for(1.0, partition_count(rows))).otherwise(shares_of("user_id", hot_users))
    return rows.withColumn(STORED_SHARE, F.pmod(F.monotonically_increasing_id(), shares).cast("int"))


def _save(rows: DataFrame, table: str, buckets: int, path: str | None) -> int:
    """Write rows that lie in their buckets already, one file for each, and return their number."""
    written = Observation(f"stored_{uuid.uuid4().hex}")
    writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write.format("parquet")
    writer = writer.bucketBy(buckets, *BY).sortBy(*BY)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return written.get["rows"]


def save_store(
    rows: DataFrame, table: str, hot_users: dict[str, int] | None = None, buckets: int | None = None, path: str | None = None
) -> int:
    """Write rows as a new store, and return their number. This is the one time that the wide rows are shuffled.

    There are as many buckets as shuffle partitions unless said otherwise. ``hot_users`` as ``hot_keys`` gives them;
    without it they are measured. An existing table is an error.
    """
    hot = hot_keys(rows, ["user_id"])["user_id"] if hot_users is None else hot_users
    buckets = buckets or partition_count(rows)
    return _save(dealt(rows, hot).repartition(buckets, *BY), table, buckets, path)


def bucket_count(spark: SparkSession, table: str) -> int:
    """The number of buckets of a store; an error if the table is none."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    columns = [c.strip("` []") for c in described.get("Bucket Columns", "").split(",")]
    if columns != BY:
        raise ValueError(f"{table} is not bucketed by {BY}")
    return int(described["Num Buckets"])


def rewritten(stored: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of a store with the values of the user map, each in its bucket.

    The shares that occur are found within the buckets. They meet the map, which is narrow, and move to the buckets.
    A merge join keeps the wide rows in theirs; beside a broadcast the planner would read the files without regard
    to buckets, and each task would write a file for each.
    """

    def join(wide: DataFrame, narrow: DataFrame) -> DataFrame:
        shares = stored.where("user_id IS NOT NULL").select(*BY).distinct()
        return wide.hint("merge").join(shares.join(narrow, USER), BY, "left")

    return write_back_by(stored, users, join)


def rerun_store(
    spark: SparkSession,
    table: str,
    target: str,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
    path: str | None = None,
) -> int:
    """Resolve the rows of a store again and write them as a new one, with the valid id; returns the number of rows.

    Values of the earlier run are cleared or kept as in any run. Users and choices come from the narrow columns, and
    the wide rows are read once and written to the buckets they came from. Running it again gives the same rows.
    """
    buckets, stored = bucket_count(spark, table), spark.table(table)
    with scratch(spark, "rerun") as folder:
        users, _ = mapped_users(stored, masters, personas, watched, hot)
        users = materialize(users, "user_map", folder)
        after = materialize(users_after(stored, users, {}), "users_after", folder)
        chosen = materialize(choices(after, "n_rows"), "choices", folder)
        n_rows = _save(set_valid_uuid(rewritten(stored, users), chosen), target, buckets, path)
        expected = after.agg(F.sum("n_rows")).first()[0] or 0
    if n_rows != expected:
        spark.sql(f"DROP TABLE {target}")
        raise RuntimeError(f"{n_rows} rows written to {target}, but {table} has {expected}")
    return n_rows
