from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import brute
from uidloom.functions.fixed import UUID_COLUMNS
from uidloom.operators import resolve, skew
from uidloom.operators.valid_uuid import choices, set_valid_uuid
from uidloom.plans import bucketed
from uidloom.plans.resolution import resolve_valid

ALL = ["metadata_table", "id", "anonymous_id", "user_id", *UUID_COLUMNS, "valid_uuid"]


@pytest.fixture()
def on_files(spark, inputs, tmp_path):
    """Inputs whose rows are read from files, as a store needs them."""

    def build(seed, n_rows, hot=0.0, earlier=True):
        rows, *others = inputs(*brute.random_inputs(random.Random(seed), n_rows, hot=hot))
        if earlier:
            rows = rows.select("*", *[F.concat(F.lit("old-"), "id").alias(c) for c in UUID_COLUMNS])
        path = str(tmp_path / f"rows-{seed}")
        rows.write.parquet(path)
        return [spark.read.parquet(path), *others]

    return build


def values(df, columns=ALL):
    return Counter(map(tuple, df.select(*columns).collect()))


def settings(spark, **changed):
    names = {"adaptive": "spark.sql.adaptive.enabled", "broadcast": "spark.sql.autoBroadcastJoinThreshold"}
    before = {names[k]: spark.conf.get(names[k]) for k in changed}
    for key, value in changed.items():
        spark.conf.set(names[key], value)
    return before


@pytest.mark.parametrize("hot", [0.0, 0.6])
@pytest.mark.parametrize("earlier", [True, False])
def test_a_run_over_a_store_gives_the_rows_of_a_plain_run(spark, on_files, database, hot, earlier):
    rows, *others = on_files(3, 400, hot, earlier)
    assert bucketed.save_store(rows, f"{database}.first") == 400
    assert bucketed.rerun_store(spark, f"{database}.first", f"{database}.second", *others) == 400
    expected = values(resolve_valid(rows, *others))
    assert values(spark.table(f"{database}.second")) == expected
    if hot:
        shares = spark.table(f"{database}.first").where("user_id = '1'").agg(F.max("user_share")).first()[0]
        assert shares > 0


def test_runs_follow_each_other(spark, on_files, inputs, database):
    """What the second run clears and keeps is what a plain run on the rows of the first one does."""
    rows, *others = on_files(5, 300, 0.5)
    changed = inputs(*brute.random_inputs(random.Random(6), 300))[1:]
    bucketed.save_store(rows, f"{database}.s0", buckets=5)
    bucketed.rerun_store(spark, f"{database}.s0", f"{database}.s1", *others)
    bucketed.rerun_store(spark, f"{database}.s1", f"{database}.s2", *changed)
    bucketed.rerun_store(spark, f"{database}.s2", f"{database}.s3", *changed)
    plain = resolve_valid(spark.table(f"{database}.s1").drop("valid_uuid", "user_share"), *changed)
    assert values(spark.table(f"{database}.s2")) == values(plain)
    assert values(spark.table(f"{database}.s3")) == values(spark.table(f"{database}.s2"))  # again, the same
    assert bucketed.bucket_count(spark, f"{database}.s3") == 5


def above(plan, scan):
    """The operators above the first line that matches, from the tree of a plan."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if re.search(scan, line))
    depth, out = re.search(r"\w", lines[at]).start(), []
    for line in reversed(lines[:at]):
        start = re.search(r"\w", line)
        if start and start.start() < depth:
            depth = start.start()
            out.append(line[depth:])
    return out


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_wide_rows_are_read_once_and_not_shuffled(spark, on_files, database, hot):
    rows, *others = on_files(7, 400, hot)
    bucketed.save_store(rows, f"{database}.store", buckets=12)
    before = settings(spark, adaptive="false", broadcast="-1")
    try:
        stored = spark.table(f"{database}.store")
        users = resolve.user_map(stored, *others, hot=resolve.measure_hot_keys(rows, others[2]))
        users = bucketed.materialize(users, "user_map")
        written = set_valid_uuid(bucketed.rewritten(stored, users), choices(users, "n_rows"))
        plan = written._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(re.findall(r"FileScan.*anonymous_id", plan)) == 1
    path = above(plan, r"FileScan.*anonymous_id")
    assert any("SortMergeJoin" in line for line in path)
    assert not [line for line in path if line.startswith("Exchange")], plan


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_run_writes_one_file_for_each_bucket(spark, on_files, database, adaptive):
    rows, *others = on_files(8, 400, 0.6)
    bucketed.save_store(rows, f"{database}.store", buckets=6)
    before = settings(spark, adaptive=adaptive)
    try:
        bucketed.rerun_store(spark, f"{database}.store", f"{database}.again", *others)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for name in ("store", "again"):
        files = [r[0] for r in spark.table(f"{database}.{name}").select(F.input_file_name()).distinct().collect()]
        assert 1 < len(files) <= 6


def test_copies_of_one_row_spread_over_the_buckets(spark, tmp_path, database):
    copy = F.lit("x")
    rows = spark.range(0, 9000, 1, 4).select(
        F.lit("A").alias("metadata_table"), copy.alias("id"), copy.alias("anonymous_id"), F.lit("u").alias("user_id"),
        copy.alias("email"), copy.alias("rid"),
    )
    rows.write.parquet(str(tmp_path / "source"))
    rows = spark.read.parquet(str(tmp_path / "source"))
    bucketed.save_store(rows, f"{database}.copies", skew.hot_keys(rows, ["user_id"])["user_id"], buckets=8)
    per_file = spark.table(f"{database}.copies").groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in per_file) <= 3 * 9000 / 8
    kept = values(spark.table(f"{database}.copies"), ["id", "user_id"])
    assert kept == Counter({("x", "u"): 9000})


def test_empty_rows_null_users_and_other_tables(spark, on_files, inputs, database):
    rows, *others = on_files(9, 60)
    bucketed.save_store(rows.where("id = 'none'"), f"{database}.empty")
    assert bucketed.rerun_store(spark, f"{database}.empty", f"{database}.empty2", *others) == 0
    assert spark.table(f"{database}.empty2").columns[-1] == "valid_uuid"
    bucketed.save_store(rows.withColumn("user_id", F.lit(None).cast("string")), f"{database}.nobody")
    bucketed.rerun_store(spark, f"{database}.nobody", f"{database}.nobody2", *others)
    kept = spark.table(f"{database}.nobody2")
    assert kept.where("user_id_uuid = concat('old-', id) AND rid_uuid = concat('old-', id)").count() == 60
    rows.write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError):
        bucketed.rerun_store(spark, f"{database}.plain", f"{database}.out", *others)
    with pytest.raises(Exception, match="already exists"):
        bucketed.save_store(rows, f"{database}.plain")
