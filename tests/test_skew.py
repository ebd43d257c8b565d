from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from tests import brute
from uidloom.operators import resolve, skew


def hot_rows(spark, n=8000):
    """A third of the rows share a key, a sixth has none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 6 != 1, F.col("id").cast("string"))
    return spark.range(0, n, 1, 4).select(F.lit("A").alias("metadata_table"), F.col("id").cast("string"), key.alias("k"))


def test_hot_keys_are_found(spark):
    found = skew.hot_keys(hot_rows(spark), ["k", "metadata_table", "id"])
    assert set(found["k"]) == {"hot"} and set(found["metadata_table"]) == {"A"} and found["id"] == {}
    assert found["k"]["hot"] >= 8000 / 3 / 6667 * 8 * skew.SHARES_PER_PARTITION


def test_hot_keys_of_null_columns_and_empty_frames(spark):
    rows = hot_rows(spark).withColumn("none", F.lit(None).cast("string"))
    rows = rows.withColumn("some", F.when(F.spark_partition_id() == 2, F.col("k")))
    found = skew.hot_keys(rows, ["none", "some"])
    assert found["none"] == {} and set(found["some"]) == {"hot"}
    assert skew.hot_keys(rows.limit(0), ["k"]) == {"k": {}}


def test_repeats_of_lookup_rows_are_bounded():
    for partitions in (8, 1000, 100_000):
        for keys in (1, 3, 100, 499):
            shares = [skew.shares_for(1 / keys, partitions) for _ in range(keys)]
            assert sum(shares) <= 16 * partitions + 4 * keys
            assert min(shares) >= partitions * skew.SHARES_PER_PARTITION / keys


def lookup(spark):
    keys = spark.range(0, 8000, 2).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return keys.union(spark.createDataFrame([("hot", "v-hot")], "k string, v string"))


def test_any_list_of_hot_keys_gives_the_same_rows(spark):
    rows, values = hot_rows(spark), lookup(spark)
    plain = sorted(rows.join(values, "k", "left").select("id", "k", "v").collect(), key=lambda r: int(r.id))
    inner = [r for r in plain if r.v is not None]
    for hot in ({}, {"hot": 64}, {"hot": 4, "2": 16, "5": 4, "absent": 64}):
        spread = skew.spread_join(rows, values, "k", hot).select("id", "k", "v").collect()
        assert sorted(spread, key=lambda r: int(r.id)) == plain
        both = skew.spread_join(rows, values, "k", hot, "inner").select("id", "k", "v").collect()
        assert sorted(both, key=lambda r: int(r.id)) == inner
        split = skew.split_join(rows, values, ["k"], "k", hot).select("id", "k", "v").collect()
        assert sorted(split, key=lambda r: int(r.id)) == plain


def largest_part(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)


def without_adaptive(spark, function):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return function()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_partition_of_a_join_holds_the_hot_key(spark):
    rows, values = hot_rows(spark), lookup(spark)
    hot = skew.hot_keys(rows, ["k"])["k"]
    assert without_adaptive(spark, lambda: largest_part(rows.join(values, "k", "left"))) > 0.35
    assert without_adaptive(spark, lambda: largest_part(skew.spread_join(rows, values, "k", hot))) < 0.25
    assert without_adaptive(spark, lambda: largest_part(skew.split_join(rows, values, ["k"], "k", hot))) < 0.25


def test_copies_of_one_row_do_not_pile_up_in_the_write_back(spark):
    rows = spark.range(0, 9000, 1, 4).select(
        F.lit("A").alias("metadata_table"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("id"),
    )
    users = rows.select("metadata_table", "user_id", F.col("user_id").alias("user_id_uuid")).distinct()
    hot = skew.hot_keys(rows, ["user_id"])["user_id"]
    written = resolve.write_back(rows, users, hot)
    assert without_adaptive(spark, lambda: largest_part(written)) < 0.25
    assert written.count() == 9000 and written.where("user_id_uuid = user_id").count() == 9000


def test_hot_inputs_resolve_alike_with_and_without_measured_keys(inputs):
    frames = inputs(*brute.random_inputs(random.Random(11), 300, n_users=40, hot=0.35))
    none = {"user_id": {}, "email": {}, "rid": {}, "watched": {}}
    hot = resolve.measure_hot_keys(frames[0], frames[3])
    assert set(hot["user_id"]) == {"1"} and set(hot["watched"]) == {"4"}
    plain = Counter(map(tuple, resolve.resolve(*frames, none).collect()))
    assert Counter(map(tuple, resolve.resolve(*frames, hot).collect())) == plain


def test_rows_are_read_once_for_the_hot_keys_and_the_user_map(spark, inputs):
    rows, *others = inputs(*brute.random_inputs(random.Random(12), 200, n_users=40, hot=0.35))
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    users, hot = resolve.mapped_users(rows.mapInArrow(count, rows.schema), *others)
    found = Counter(map(tuple, users.collect()))
    assert runs.value == 200 and set(hot["user_id"]) == {"1"}
    none = {"user_id": {}, "email": {}, "rid": {}, "watched": {}}
    assert Counter(map(tuple, resolve.user_map(rows, *others, none).collect())) == found


def test_values_that_are_counted_already_are_taken_as_they_are(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 40), ("c", 5), (None, 75), *[(f"x{k}", 1) for k in range(40)]], "u string, n_rows bigint")
    found = skew.hot_keys(hot_rows(spark), ["k"], ("u", counts, 250))
    assert set(found["u"]) == {"a", "b"} and set(found["k"]) == {"hot"}
    assert skew.hot_keys(hot_rows(spark).limit(0), ["k"], ("u", counts.limit(0), 0)) == {"k": {}, "u": {}}
