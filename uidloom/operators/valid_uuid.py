"""One valid id per row: the best agreeing pair first, then a fallback column.

The choice of pair and fallback is one small row per table, computed here or given by the caller. It is broadcast if
it has few rows, which is checked; of several choices for one table the smallest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from uidloom.functions.fixed import UUID_COLUMNS, VALID_UUID
from uidloom.functions.frames import has_column, reset_column
from uidloom.operators.coverage import PAIRS, combo_name, count_where

CHOICE = "_choice"
BROADCAST_ROWS = 100_000


def _best(entries: list[tuple[str, Column]], name: str) -> list[Column]:
    """The entry with the highest count above 0, the first by name on a tie, as columns ``name`` and ``n``."""
    ranked = F.array_min(
        F.array(*[F.when(n > 0, F.struct((-n).alias("rank"), F.lit(entry).alias("entry"))) for entry, n in entries])
    )
    return [ranked["entry"].alias(name), (-ranked["rank"]).alias("n")]


def choices(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table: the best pair ``combo`` with its count, and the ``fallback`` column with its count.

    The best pair agrees most often. The fallback has most values among the rows where that pair does not
    agree. One aggregation counts both, for every pair, so the resolved frame is read once.
    """
    agree = {combo_name(pair): F.col(pair[0]) == F.col(pair[1]) for pair in PAIRS}
    third = {
        f"{combo_name(pair)}/{c}": agree[combo_name(pair)] & F.col(c).isNotNull()
        for pair in PAIRS
        for c in UUID_COLUMNS
        if c not in pair
    }
    counts = df.groupBy("metadata_table").agg(
        *[count_where(F.col(c).isNotNull(), weight).alias(c) for c in UUID_COLUMNS],
        *[count_where(condition, weight).alias(name) for name, condition in {**agree, **third}.items()],
    )
    best = counts.select("*", *_best([(pair, F.col(f"`{pair}`")) for pair in agree], "combo"))

    def left_open(column: str) -> Column:
        """Values of the column outside the rows where the best pair agrees; a member has one in all of those."""
        covered = [
            F.when(
                F.col("combo") == combo_name(pair),
                F.col(f"`{combo_name(pair)}`" if column in pair else f"`{combo_name(pair)}/{column}`"),
            )
            for pair in PAIRS
        ]
        return F.col(column) - F.coalesce(*covered, F.lit(0))

    fallback, n_fallback = _best([(c, left_open(c)) for c in UUID_COLUMNS], "fallback")
    return best.select(
        "metadata_table", "combo", F.col("n").alias("combo_n"), fallback, n_fallback.alias("fallback_n")
    )


def best_combo(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table with an agreeing pair: that pair and its count."""
    found = choices(df, weight).where("combo IS NOT NULL")
    return found.select("metadata_table", "combo", F.col("combo_n").alias("n"))


def fallback_column(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per table with something left to fill: the fallback column and how many rows it fills."""
    found = choices(df, weight).where("fallback IS NOT NULL")
    return found.select("metadata_table", "fallback", F.col("fallback_n").alias("n"))


def choices_from(df: DataFrame, combos: dict[str, str], fallbacks: dict[str, str]) -> DataFrame:
    """Choices made by the caller: table to ``a-b``, and table to column."""
    tables = sorted({*combos, *fallbacks})
    return df.sparkSession.createDataFrame(
        [(t, combos.get(t), fallbacks.get(t)) for t in tables],
        "metadata_table string, combo string, fallback string",
    )


def _value_of(name: Column) -> Column:
    """The value of the UUID column with the given name."""
    return F.coalesce(*[F.when(F.lower(name) == c, F.col(c)) for c in UUID_COLUMNS])


def _with_choices(df: DataFrame, chosen: DataFrame) -> DataFrame:
    single = chosen.groupBy("metadata_table").agg(F.min(F.struct("combo", "fallback")).alias(CHOICE))
    few = single.take(BROADCAST_ROWS + 1)
    if len(few) <= BROADCAST_ROWS:  # computed once: the rows that were counted are those that are broadcast
        single = F.broadcast(df.sparkSession.createDataFrame(few, single.schema))
    return df.join(single, "metadata_table", "left")


def _consensus() -> Column:
    members = F.split(f"{CHOICE}.combo", "-")
    first, second = _value_of(members[0]), _value_of(members[1])
    return F.when(first == second, first)


def _fallback() -> Column:
    return _value_of(F.col(f"{CHOICE}.fallback"))


def set_consensus(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Reset the valid id, then set it where the two columns of the table's pair agree."""
    joined = _with_choices(reset_column(df, VALID_UUID), chosen)
    return _in_order(joined.withColumn(VALID_UUID, _consensus()), df)


def fill_remainder(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Set the valid id from the fallback column where it is still null."""
    filled = F.coalesce(F.col(VALID_UUID), _fallback())
    return _in_order(_with_choices(df, chosen).withColumn(VALID_UUID, filled), df)


def set_valid_uuid(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Reset, consensus and fallback in one step."""
    valid = F.coalesce(_consensus(), _fallback())
    return _in_order(_with_choices(df, chosen).withColumn(VALID_UUID, valid), df)


def _in_order(result: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` in their order and case, the valid id last if it is new."""
    added = [] if has_column(df, VALID_UUID) else [VALID_UUID]
    return result.select(*[F.col(f"`{c}`").alias(c) for c in df.columns], *added)
