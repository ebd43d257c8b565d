"""Mixing sources to target weights by pivotal dependent rounding.

Each row of a source gets the same fractional number of copies, target words over source words. Whole copies are
certain; the fractional rests are rounded in pairs: words move at random from one row to the other, with no
change on average, until one of the two is integral, and the other goes on to the next pair. Each group of
rows leaves one rest at most; the rests of many groups meet on the next level of a tree until one is left per
source. So the words taken of a source differ from its target by less than the size of one row.

Defined results: null text has size 0, and rows of size 0 take no words; null is a source, ordered last; repeated
rows count as rows; all draws come from hashes of the rows, so a rerun and a lost task give the same result, and
fully equal rows may swap theirs. No rows give no rows. Other columns than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from uidloom.sources.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
GROUP_ROWS = 1024
FAN_IN = 64
_WORK = (
    "doc_id bigint, size bigint, source_rank bigint, source_size bigint, target double, whole bigint, "
    "key bigint, bucket bigint, rest double"
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """Per source its rank, size, rows and target words; the targets add up to all sizes.

    Water filling: with the sources ordered by cap over weight, one is full when the level that fills it needs
    no more words than there are. The windows without partition see one row per source.
    """
    by_code_point = Window.orderBy(F.col("source").isNull(), "source")
    rank = F.row_number().over(by_code_point) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    totals = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
        .withColumn("source_rank", rank.cast("bigint"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("level", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy()
    lower = Window.orderBy("level", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        totals.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("lower_cap", F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
        .withColumn("lower_weight", F.coalesce(F.sum("weight").over(lower), F.lit(0.0)))
        .withColumn(
            "full",
            F.col("lower_cap") + F.col("level") * (F.col("all_weight") - F.col("lower_weight")) <= F.col("all_words"),
        )
        .withColumn("full_cap", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
        .withColumn("full_weight", F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(everything))
    )
    share = (F.col("all_words") - F.col("full_cap")) * F.col("weight") / (F.col("all_weight") - F.col("full_weight"))
    return filled.select(
        "source",
        "source_rank",
        "source_size",
        "rows",
        F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), share)).alias("target"),
    )


def _unit(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 1 from 64-bit keys."""
    h = values.astype(np.uint64)
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def round_in_pairs(sizes: np.ndarray, rests: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Move words between rows until at most one rest is not 0 or 1; the sum of size times rest stays."""
    out = rests.copy()
    open_at = -1
    draws = _unit(keys ^ np.arange(1, len(keys) + 1, dtype=np.int64) * np.int64(0x9E3779B97F4A7C1))
    for i in range(len(out)):
        if not 0.0 < out[i] < 1.0:
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        a, b, x, y = float(sizes[j]), float(sizes[i]), out[j], out[i]
        to_i, to_j = min(a * x, b * (1 - y)), min(b * y, a * (1 - x))
        moved = to_i if draws[i] * (to_i + to_j) < to_j else -to_j
        for k, value in ((j, x - moved / a), (i, y + moved / b)):
            out[k] = 0.0 if value < 1e-9 else 1.0 if value > 1 - 1e-9 else value
        still = [k for k in (j, i) if 0.0 < out[k] < 1.0]
        open_at = still[0] if still else -1
    return out


def _round_group(group: pd.DataFrame) -> pd.DataFrame:
    # From large to small: rows of like size meet, and the rest that is left over sits on a small row.
    group = group.sort_values(["size", "key", "doc_id"], ascending=[False, True, True], kind="stable")
    group["rest"] = round_in_pairs(*(group[c].to_numpy() for c in ("size", "rest", "key")))
    group["bucket"] //= FAN_IN
    return group


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_COPIES,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Per row the copies the mix takes: doc_id, size, source_size, target, copies, taken, and the row's key."""
    sized = materialize(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column)).alias("size"),
            row_key(id_column, text_column, source_column).alias("key"),
        ),
        "sizes",
    )
    targets = materialize(source_targets(sized, weights, most), "targets")
    deepest = targets.agg(F.max("rows")).first()[0] or 0
    copies = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    whole = F.floor(copies + F.lit(1e-9))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / GROUP_ROWS))
    work = (
        sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
        .withColumn("whole", whole)
        .withColumn("rest", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), copies - whole)).otherwise(0.0))
        .withColumn("bucket", F.pmod(F.xxhash64("key"), buckets))
        .select("doc_id", "size", "source_rank", "source_size", "target", "whole", "key", "bucket", "rest")
    )
    levels, groups = [], -(-deepest // GROUP_ROWS)
    while True:
        done = materialize(work.groupBy("source_rank", "bucket").applyInPandas(_round_group, _WORK), "rounded")
        is_open = (F.col("rest") > 0) & (F.col("rest") < 1)
        if groups <= 1:
            last = F.pmod(F.xxhash64("key", "source_rank"), F.lit(1 << 30)) / float(1 << 30) < F.col("rest")
            levels.append(done.withColumn("rest", F.when(is_open, last.cast("double")).otherwise(F.col("rest"))))
            break
        levels.append(done.where(~is_open))
        work, groups = done.where(is_open), -(-groups // FAN_IN)
    result = levels[0]
    for level in levels[1:]:
        result = result.unionByName(level)
    taken = (F.col("whole") + F.round("rest")).cast("bigint")
    return result.select(
        "doc_id", "size", "source_size", "target", taken.alias("copies"), (taken * F.col("size")).alias("taken"), "key"
    )


def row_key(id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> Column:
    """A hash of the row that its draws come from."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return F.xxhash64(F.col(id_column).cast("bigint"), text, F.col(source_column).cast("string"))


def repeat_rows(docs: DataFrame, taken: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it.

    Rows of one key, which ``mix`` can't tell apart, pool their copies; these are dealt to the distinct rows in a fixed
    order, in proportion to how often each occurs and with no copy more or less in all.
    """
    per_key = taken.groupBy("doc_id", "key").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    per_key = per_key.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_copies", "_rows")
    rows = docs.select(*columns, row_key().alias("_row_key"))
    found = rows.join(
        per_key, rows["_row_key"].eqNullSafe(per_key["_key"]) & rows["doc_id"].cast("bigint").eqNullSafe(per_key["_id"])
    )
    single = found.where("_rows = 1").select(*columns, "_copies")
    pooled = found.where("_rows > 1").groupBy(*columns, "_key", "_id").agg(
        F.first("_copies").alias("_pool"), F.first("_rows").alias("_all"), F.count("*").alias("_here")
    )
    # A row takes what falls between its first and its last place among all rows of the key.
    order = Window.partitionBy("_id", "_key").orderBy(*[c for c in columns if c != "text"])
    before = F.sum("_here").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_here")
    dealt = pooled.withColumn("_first", before).select(
        *columns, (_share("_first + _here") - _share("_first")).cast("bigint").alias("_copies")
    )
    repeated = single.unionByName(dealt).where("_copies > 0")
    return repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(*columns)


def _share(places: str) -> Column:
    """How many of a pool's copies fall on its first places."""
    return F.expr(f"(_pool * ({places})) div _all")
