from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import brute
from uidloom.operators import resolve, screen


def passed(spark, keys, values, bits=screen.BITS):
    held = screen.key_filter(spark.createDataFrame([(k,) for k in keys], "k string"), "k", bits).scalar()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return {r["v"]: r["p"] for r in df.select("v", screen.may_hold(held, F.col("v"), bits).alias("p")).collect()}


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 18])
def test_a_key_always_passes(spark, bits):
    keys = [f"k{n}" for n in range(500)] + ["", "é", "a\u0000b", "x" * 10_000, "k1"]
    assert set(passed(spark, keys, keys, bits).values()) == {True}


def test_others_pass_as_rarely_as_the_size_says(spark):
    bits, n = 1 << 14, 1 << 11  # an eighth of the bits
    keys, others = [f"k{k}" for k in range(n)], [f"o{k}" for k in range(4000)]
    assert 0.01 < sum(passed(spark, keys, others, bits).values()) / 4000 < 0.06
    assert sum(passed(spark, keys, others).values()) == 0


def test_empty_lookups_and_nulls(spark):
    assert passed(spark, [None], ["a", "", None]) == {"a": False, "": False, None: None}
    assert passed(spark, [None, "a"], ["a", None]) == {"a": True, None: None}


@pytest.mark.parametrize("bits", [64, 1 << 16])
@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_the_map_does_not_depend_on_the_filter(spark, inputs, monkeypatch, bits, hot):
    """A filter of 64 bits lets nearly everything pass, the large one only keys."""
    monkeypatch.setattr(screen.key_filter, "__defaults__", (bits,))
    monkeypatch.setattr(screen.may_hold, "__defaults__", (bits,))
    frames = inputs(*brute.random_inputs(random.Random(bits), 300, n_users=40, hot=hot))
    plain, screened = (resolve.user_map(*frames, screened=flag).collect() for flag in (False, True))
    assert Counter(plain) == Counter(screened)
    none = resolve.user_map(frames[0], *[f.limit(0) for f in frames[1:]], screened=True)
    assert none.where("user_id_uuid IS NOT NULL OR username_uuid IS NOT NULL OR rid_hit").count() == 0
    assert none.count() == len(plain)


def test_rows_without_rid(spark, inputs):
    frames = list(inputs(*brute.random_inputs(random.Random(3), 100)))
    frames[0] = frames[0].drop("rid")
    plain, screened = (resolve.user_map(*frames, screened=flag).collect() for flag in (False, True))
    assert Counter(plain) == Counter(screened)


def test_only_possible_candidates_are_shuffled(spark, inputs):
    """Of 2,000 emails and rids a tenth is in the lookups; each filter is made once and read by the scan."""
    rows, masters, personas, watched = inputs(
        [("A", f"u{k}", f"n{k}", f"r{k}") for k in range(2000)],
        [(f"m{k}", f"n{k}") for k in range(0, 2000, 10)],
        watched=[(f"r{k}", "m0") for k in range(0, 2000, 10)],
    )
    every = resolve.user_entries(rows).groupBy((F.col("candidate") == resolve.ROW).alias("row")).count()
    assert {r["row"]: r["count"] for r in every.collect()} == {True: 2000, False: 4000}
    few = resolve.user_entries(rows, resolve.key_screens(masters, watched))
    counts = few.groupBy((F.col("candidate") == resolve.ROW).alias("row")).count()
    assert {r["row"]: r["count"] for r in counts.collect()} == {True: 2000, False: 400}
    few.collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    head = plan.split("+- == Initial Plan ==")[0]
    assert head.index("Exchange") < head.index("Generate")  # screened in the task that reads them, before the shuffle
