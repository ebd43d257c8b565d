"""Joins that stay even when one key holds a large part of the rows.

The hot keys are measured first, in one pass over the key columns. They only decide where a row
is matched, never whether: any choice of hot keys gives the same result.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

MAX_HOT_KEYS = 5000
"""Most hot values told apart in one column. A key is hot above the rows of an average partition, so there are at
most as many as partitions; beyond this bound the smallest of them are left to adaptive execution."""
BROADCAST_ROWS = 100_000
SKETCH_GROUPS = 128
SHARES_PER_PARTITION = 4
SHARE = "_share"

HotKeys = dict[str, dict[str, int]]
"""Per key column, its hot values and into how many shares the rows of each are cut."""


def partition_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shares_for(part: float, partitions: int) -> int:
    """Shares for a key with this part of all rows: a power of 4, so that few sizes occur."""
    shares = 1
    while shares < part * partitions * SHARES_PER_PARTITION:
        shares *= 4
    return shares


def hot_keys(
    rows: DataFrame, columns: Sequence[str], counted: tuple[str, DataFrame, int] | None = None
) -> HotKeys:
    """Per string column, the values that hold more rows than an average shuffle partition.

    One scan of the given columns feeds a frequent-items sketch of fixed size per column and task; sketches
    are merged in two steps, and the driver gets as many values per column as there are partitions,
    ``MAX_HOT_KEYS`` at most. A key too rare
    for the sketch is left to the skew handling of adaptive execution.

    ``counted`` adds a column whose values are counted already, in the same job: its name, a frame with the value and
    its ``n_rows``, and the number of all rows. No more values than partitions pass.
    """
    partitions = partition_count(rows)
    most = min(MAX_HOT_KEYS, partitions)
    tracked = 8 * most
    values = (
        rows.select(*columns)
        .unpivot([], list(columns), "name", "value")
        .where("value IS NOT NULL")
        .withColumn("part", F.spark_partition_id() % SKETCH_GROUPS)
    )
    sketches = values.groupBy("name", "part").agg(
        F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("sketch"), F.count("value").alias("n")
    )
    merged = sketches.groupBy("name").agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n")
    )
    top = merged.select("name", "n", F.expr(f"inline(approx_top_k_estimate(sketch, {most}))"))
    names = list(columns)
    if counted is not None:
        name, counts, total = counted
        exact = counts.select(F.lit(name).alias("name"), F.lit(total).alias("n"), F.col(name).alias("item"), F.col("n_rows").alias("count"))
        top, names = top.unionByName(exact.where("item IS NOT NULL")), [*names, name]
    hot = top.where(F.col("count") * partitions > F.col("n")).collect()
    found: HotKeys = {name: {} for name in names}
    for row in sorted(hot, key=lambda row: -row["count"]):
        if len(found[row["name"]]) < most:
            found[row["name"]].setdefault(row["item"], shares_for(row["count"] / row["n"], partitions))
    return found


def shares_of(key: str, hot: Mapping[str, int]) -> Column:
    shares = F.lit(1)
    for size in sorted(set(hot.values())):
        shares = F.when(F.col(key).isin([k for k, n in hot.items() if n == size]), size).otherwise(shares)
    return shares


def _hashed(rows: DataFrame) -> list[str]:
    """The columns that a hash can take."""
    return [f"`{name}`" for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    hot: Mapping[str, int],
    how: str = "left",
    on: Sequence[str] | None = None,
) -> DataFrame:
    """Join rows to a lookup that is unique on ``on``, with hot and null values of ``key`` spread over the partitions.

    ``on`` is the key alone unless given. The rows of a hot key are cut by a hash of the whole row, which a
    lost task computes again alike, and its lookup rows are repeated once per share. The shares of a key
    follow its part of the rows, so all repeats together are bounded by a small multiple of the number of
    partitions. The rows are read once, hot keys or not. Copies of one row share a hash.
    """
    null_shares = shares_for(1.0, partition_count(rows))
    shares = F.when(F.col(key).isNull(), null_shares).otherwise(shares_of(key, hot))
    share = F.when(shares > 1, F.pmod(F.xxhash64(*_hashed(rows)), shares).cast("int")).otherwise(0)
    repeats = F.sequence(F.lit(0), shares_of(key, hot) - 1)
    return (
        rows.withColumn(SHARE, share)
        .join(lookup.withColumn(SHARE, F.explode(repeats)), [*(on or [key]), SHARE], how)
        .drop(SHARE)
    )


def split_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], key: str, hot: Collection[str]
) -> DataFrame:
    """Left join rows to a lookup that is unique on ``on``; only rows with an ordinary key are shuffled.

    Rows whose key is null or hot stay where they were read and meet a broadcast of the hot lookup rows.
    It holds at most one row per hot key and value of the other ``on`` columns; if these are more than
    ``BROADCAST_ROWS``, they are joined without a broadcast. This costs a second scan of the rows, and
    copies of one row cannot pile up.
    """
    is_hot = F.col(key).isin(list(hot))
    apart = F.col(key).isNull() | is_hot
    few = lookup.where(is_hot)
    if len(few.select(*on).take(BROADCAST_ROWS + 1)) <= BROADCAST_ROWS:
        few = F.broadcast(few)
    stay = rows.where(apart).join(few, list(on), "left")
    move = rows.where(~apart).join(lookup.where(~is_hot), list(on), "left")
    return stay.unionByName(move)
