"""How often the UUID columns exist and agree, per table.

Input is a resolved frame: rows from ``write_back``, or the user map with ``weight="n_rows"``. Both give the
same numbers on a fresh run, but the user map does not need the wide rows at all. Every report comes from
one aggregation by table; only partial sums, one row per table and task, are shuffled.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from uidloom.functions.fixed import RID_COLUMN, UUID_COLUMNS, VALID_UUID
from uidloom.functions.frames import has_column
from uidloom.functions.names import combo_label
from uidloom.functions.values import all_equal, percent, thousands

COMBOS = [combo for size in range(2, len(UUID_COLUMNS) + 1) for combo in combinations(UUID_COLUMNS, size)]
PAIRS = [combo for combo in COMBOS if len(combo) == 2]


def combo_name(combo: tuple[str, ...]) -> str:
    return "-".join(combo)


def count_where(condition: Column, weight: str | None = None) -> Column:
    """Number of rows for which the condition is true; a weight column says how many rows one row stands for."""
    n = F.lit(1).cast("long") if weight is None else F.col(weight)
    return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")


def row_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.groupBy("metadata_table").agg(count_where(F.lit(True), weight).alias("total"))


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if has_column(df, name) else F.lit(None).cast("string")


def uuid_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per table: total rows and the non-null count of each UUID column."""
    return df.groupBy("metadata_table").agg(
        count_where(F.lit(True), weight).alias("total"),
        *[count_where(_column(df, c).isNotNull(), weight).alias(c) for c in UUID_COLUMNS],
    )


def for_tables(report: DataFrame, descriptors: DataFrame) -> DataFrame:
    """A report with one row for every described table, also for those without rows.

    A count that has no row is 0; the count of a path that cannot run, the rid path of a table without a rid,
    is null.
    """
    tables = descriptors.select("metadata_table", F.array_contains("columns", RID_COLUMN).alias("_has_rid"))
    joined = tables.join(report, "metadata_table", "left")

    def filled(name: str, kind: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(0).cast(kind))
        return (F.when(F.col("_has_rid"), value) if name == UUID_COLUMNS[-1] else value).alias(name)

    return joined.select(*[F.col(n) if n == "metadata_table" else filled(n, kind) for n, kind in report.dtypes])


def uuid_counts_long(counts: DataFrame) -> DataFrame:
    """The wide counts as one row per table and column."""
    return counts.unpivot(["metadata_table"], ["total", *UUID_COLUMNS], "name", "n")


def all_equal_summary(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table: rows whose user id equals the first three UUID columns, and their percent."""
    same = all_equal([F.col("user_id"), *[_column(df, c) for c in UUID_COLUMNS[:3]]])
    counts = df.groupBy("metadata_table").agg(
        count_where(F.lit(True), weight).alias("total_count"),
        count_where(same, weight).alias("all_4_equal_count"),
    )
    return counts.withColumn("all_4_equal_percent", percent(F.col("all_4_equal_count"), F.col("total_count")))


def combo_counts_wide(df: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per table: the count of each UUID column and, named ``a-b``, of each combination agreeing."""
    return df.groupBy("metadata_table").agg(
        *[count_where(_column(df, c).isNotNull(), weight).alias(c) for c in UUID_COLUMNS],
        *[
            count_where(all_equal([_column(df, c) for c in combo]), weight).alias(combo_name(combo))
            for combo in COMBOS
        ],
    )


def combo_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table and combination of 2 to 4 UUID columns: the rows in which all of them agree.

    Only columns with a value in some row of the table take part; a combination that never agrees counts 0.
    """
    entries = [
        F.when(
            F.least(*combo) > 0,
            F.struct(F.lit(combo_name(combo)).alias("combo"), F.col(f"`{combo_name(combo)}`").alias("n")),
        )
        for combo in COMBOS
    ]
    wide = combo_counts_wide(df, weight)
    return wide.select("metadata_table", F.inline(F.array_compact(F.array(*entries))))


def combo_report(counts: DataFrame) -> DataFrame:
    """Combo counts as labels ``table@A-B`` with a formatted count."""
    return counts.select(
        combo_label(F.col("metadata_table"), F.col("combo")).alias("label"), thousands(F.col("n")).alias("n")
    )


def valid_uuid_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table: the rows that have a valid id."""
    return df.groupBy("metadata_table").agg(
        count_where(F.col(VALID_UUID).isNotNull(), weight).alias(VALID_UUID),
    )


def null_valid_uuid_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table: the rows that stay without a valid id."""
    return df.groupBy("metadata_table").agg(
        count_where(F.col(VALID_UUID).isNull(), weight).alias("unresolved"),
    )


def fillable_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table: the rows without a valid id that each UUID column could fill."""
    return df.groupBy("metadata_table").agg(
        *[
            count_where(F.col(VALID_UUID).isNull() & _column(df, c).isNotNull(), weight).alias(c)
            for c in UUID_COLUMNS
        ]
    )


def non_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per table: the non-null count of each given column."""
    return df.groupBy("metadata_table").agg(*[F.count(c).alias(c) for c in columns])
