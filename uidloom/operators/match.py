"""Match rates between key columns, and the three-phase resolution of single records."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from uidloom.functions.values import percent
from uidloom.operators.resolve import master_names, measure_hot_keys
from uidloom.operators.skew import HotKeys, spread_join

KINDS = {1: "u", 2: "r", 3: "e"}
"""What marks the keys of each phase, so that all of them meet in one join."""
RECORD = ["metadata_table", "id", "user_id", "rid", "email"]


def match_rate(rows: DataFrame, column: str, others: DataFrame, other_column: str) -> DataFrame:
    """How many non-null values of a column have a match in a column of another frame.

    Both sides come down to one row per value before they meet, so no value is hot in the join.
    """
    values = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = others.select(F.col(other_column).alias("value"), F.lit(True).alias("known")).distinct()
    counts = values.join(known, "value", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_values"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("n_matched"),
    )
    return counts.withColumn("match_percent", percent(F.col("n_matched"), F.col("n_values")))


def match_rates(rows: DataFrame, known: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``match_rate`` of several text columns, each with its own frame and column, in one scan of the rows."""
    names = list(known)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names])
    values = rows.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    others = [
        frame.select(F.lit(c).alias("column_name"), F.col(other).cast("string").alias("value")).distinct()
        for c, (frame, other) in known.items()
    ]
    matched = values.join(reduce(DataFrame.unionByName, others).withColumn("known", F.lit(True)), ["column_name", "value"], "left")
    counts = matched.groupBy("column_name").agg(
        F.sum("n").alias("n_values"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("n_matched")
    )
    listed = rows.sparkSession.createDataFrame([(c,) for c in names], "column_name string")
    filled = listed.join(counts, "column_name", "left").fillna(0, ["n_values", "n_matched"])
    return filled.withColumn("match_percent", percent(F.col("n_matched"), F.col("n_values")))


def phase_lookup(masters: DataFrame, personas: DataFrame, watched: DataFrame, hot_watched: Mapping[str, int]) -> DataFrame:
    """(key, phase, uuid): what user ids, rids and emails lead to, keys marked by their kind; unique by key.

    Masters and personas come down to one row per id at once, and the watch log meets that row where it stands.
    """
    ids = (
        masters.where("uuid IS NOT NULL").select(F.col("uuid").alias("user_id"), F.lit(True).alias("is_master"), F.lit(None).cast("boolean").alias("is_persona"))
        .unionByName(personas.where("id IS NOT NULL").select(F.col("id").alias("user_id"), F.lit(None).cast("boolean").alias("is_master"), F.lit(True).alias("is_persona")))
        .groupBy("user_id").agg(F.max("is_master").alias("is_master"), F.max("is_persona").alias("is_persona"))
        .where("is_master")
    )
    pairs = watched.where("rid IS NOT NULL AND user_id IS NOT NULL").select("rid", "user_id")
    people = ids.where("is_persona").select("user_id", F.col("user_id").alias("uuid"))
    # Without hot users the ids stay where they were grouped, and only the log moves to them.
    met = spread_join(pairs, people, "user_id", hot_watched, "inner") if hot_watched else pairs.join(people, "user_id")
    by_rid = met.groupBy("rid").agg(F.min("uuid").alias("uuid"))

    def keyed(frame: DataFrame, phase: int, key: str, uuid: str) -> DataFrame:
        return frame.select(F.concat(F.lit(KINDS[phase]), F.col(key)).alias("key"), F.lit(phase).alias("phase"), F.col(uuid).alias("uuid"))

    return (
        keyed(ids, 1, "user_id", "user_id")
        .unionByName(keyed(by_rid, 2, "rid", "uuid"))
        .unionByName(keyed(master_names(masters), 3, "username", "uuid"))
    )


def three_phase(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The master id of each distinct record and the phase that found it (1, 2, 3 or null).

    Phase 1 takes the user id, phase 2 the rid through the watch log and the persona users, phase 3 the email. A
    record's three keys are its candidates and meet one lookup in one join; the smallest phase that found something
    decides, in the same grouping that makes records distinct.
    """
    hot = measure_hot_keys(rows, watched) if hot is None else hot
    columns = {1: "user_id", 2: "rid", 3: "email"}
    keys = F.array_compact(F.array(*[F.concat(F.lit(KINDS[p]), F.col(c)) for p, c in columns.items()]))
    # A record without any key stays as one candidate without a key.
    candidates = rows.select(*RECORD, F.explode_outer(keys).alias("key"))
    shares = {KINDS[p] + value: n for p, c in columns.items() for value, n in hot[c].items()}
    found = spread_join(candidates, phase_lookup(masters, personas, watched, hot["watched"]), "key", shares)
    best = found.groupBy(*RECORD).agg(F.min(F.when(F.col("phase").isNotNull(), F.struct("phase", "uuid"))).alias("best"))
    return best.select(*RECORD, "best.uuid", "best.phase")
