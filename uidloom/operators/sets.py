"""Distinct rows, unions, limits and count comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

DIFFERENCE = "_difference"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once; copies fall together before the shuffle."""
    return df.dropDuplicates()


def first_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def union_tables(
    frames: Mapping[str, DataFrame], columns: Sequence[str], types: Mapping[str, str] | None = None, keyed: bool = False
) -> DataFrame:
    """Many tables as one frame with the table's name as a key column; ``keyed`` frames hold it in ``metadata_table``.

    ``types`` gives the type of a column in the result; any other column has the type of the first table with it.
    A column that a table lacks is null. No tables give a frame without rows. The union is built as a
    balanced tree, so that each plan is analysed a few times only, however many tables there are.
    """
    found = {field.name.lower(): field.dataType for df in reversed(frames.values()) for field in df.schema.fields}
    kinds = {c.lower(): (types or {}).get(c.lower(), found.get(c.lower(), "string")) for c in columns}

    def shaped(name: str, df: DataFrame) -> DataFrame:
        own = {c.lower(): F.col(f"`{c}`") for c in df.columns}
        cells = [own.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
        return df.select("metadata_table" if keyed else F.lit(name).alias("metadata_table"), *cells)

    parts = [shaped(name, df) for name, df in frames.items()]
    if not parts:
        spark = SparkSession.active()
        empty = spark.range(0).select(F.lit(None).cast("string").alias("metadata_table"))
        return empty.select("metadata_table", *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
    while len(parts) > 1:
        pairs = zip(parts[::2], parts[1::2])
        parts = [a.unionByName(b) for a, b in pairs] + parts[len(parts) // 2 * 2 :]
    return parts[0]


def reconcile_counts(source: DataFrame, copy: DataFrame, key: str = "metadata_table") -> DataFrame:
    """Per key: the row counts of a source and its copy, and whether they are equal."""
    counted = source.select(key, F.lit(1).alias("s"), F.lit(None).cast("int").alias("c")).unionByName(
        copy.select(key, F.lit(None).cast("int").alias("s"), F.lit(1).alias("c"))
    )
    counts = counted.groupBy(key).agg(F.count("s").alias("source_count"), F.count("c").alias("copy_count"))
    return counts.withColumn("equal", F.col("source_count") == F.col("copy_count"))


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one frame has more often than the other, with the difference as last column.

    One aggregation over both frames; copies of a row are counted before the shuffle.
    """
    both = left.withColumn(DIFFERENCE, F.lit(1)).unionByName(right.withColumn(DIFFERENCE, F.lit(-1)))
    return both.groupBy(*left.columns).agg(F.sum(DIFFERENCE).alias(DIFFERENCE)).where(F.col(DIFFERENCE) != 0)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return differing_rows(left, right).isEmpty()
