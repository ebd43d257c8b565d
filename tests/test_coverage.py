from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests import brute
from uidloom.operators import coverage, resolve, valid_uuid

SCHEMA = "metadata_table string, user_id string, user_id_uuid string, username_uuid string, persona_uuid string, rid_uuid string"
N = None


def frame(spark, rows):
    return spark.createDataFrame([("A", *r) for r in rows], SCHEMA)


def test_counts(spark):
    df = frame(spark, [("1", "1", "1", "1", "2"), ("1", "1", "2", N, N), (N, N, N, N, N)])
    assert coverage.uuid_counts(df).first().asDict() == {
        "metadata_table": "A", "total": 3, "user_id_uuid": 2, "username_uuid": 2, "persona_uuid": 1, "rid_uuid": 1,
    }
    long = {r.name: r.n for r in coverage.uuid_counts_long(coverage.uuid_counts(df)).collect()}
    assert long == {"total": 3, "user_id_uuid": 2, "username_uuid": 2, "persona_uuid": 1, "rid_uuid": 1}


def test_all_equal_leaves_out_the_rid_and_takes_the_user_id(spark):
    df = frame(spark, [("1", "1", "1", "1", "2"), ("9", "1", "1", "1", "1"), ("1", "1", "1", N, "1")])
    row = coverage.all_equal_summary(df).first()
    assert (row.total_count, row.all_4_equal_count) == (3, 1)
    assert row.all_4_equal_percent == 100 / 3


def test_combos_of_columns_without_values_are_left_out(spark):
    df = frame(spark, [("1", "1", "2", N, N)])
    assert [tuple(r) for r in coverage.combo_counts(df).collect()] == [("A", "user_id_uuid-username_uuid", 0)]
    assert coverage.combo_counts(frame(spark, [("1", "1", N, N, N)])).isEmpty()


def test_a_frame_without_a_column_counts_it_as_empty(spark):
    df = frame(spark, [("1", "1", "1", N, N)]).drop("rid_uuid", "persona_uuid")
    assert coverage.uuid_counts(df).first().rid_uuid == 0
    assert [r.combo for r in coverage.combo_counts(df).collect()] == ["user_id_uuid-username_uuid"]


def test_combos_against_brute_force(inputs):
    given = brute.random_inputs(random.Random(7), 200)
    resolved = brute.resolve(*given)
    frames = inputs(*given)
    expected = {
        (table, "-".join(combo)): n
        for table in {r[0] for r in resolved}
        for combo, n in brute.combo_counts(resolved, table).items()
    }
    for found in (
        coverage.combo_counts(resolve.resolve(*frames)),
        coverage.combo_counts(resolve.user_map(*frames), "n_rows"),
    ):
        assert {(r.metadata_table, r.combo): r.n for r in found.collect()} == expected
    for (table, combo), n in expected.items():
        members = combo.split("-")
        pairs = [expected[table, f"{a}-{b}"] for i, a in enumerate(members) for b in members[i + 1 :]]
        assert all(n <= pair for pair in pairs)


def test_report(spark):
    counts = spark.createDataFrame([("A", "user_id_uuid-rid_uuid", 1234567)], "metadata_table string, combo string, n long")
    assert tuple(coverage.combo_report(counts).first()) == ("A@USER_ID_UUID-RID_UUID", "1,234,567")


def test_ties_go_to_the_first_name(spark):
    df = frame(spark, [("1", "1", "1", "1", N), ("2", N, N, N, N)])
    chosen = valid_uuid.choices(df).first()
    assert (chosen.combo, chosen.combo_n) == ("user_id_uuid-persona_uuid", 1)
    assert (chosen.fallback, chosen.fallback_n) == (None, None)


def test_no_agreeing_pair_leaves_only_the_fallback(spark):
    df = frame(spark, [("1", "1", "2", N, N), ("1", N, "2", N, N)])
    chosen = valid_uuid.choices(df)
    assert tuple(chosen.first()) == ("A", None, None, "username_uuid", 2)
    assert valid_uuid.best_combo(df).isEmpty()
    assert [r.valid_uuid for r in valid_uuid.set_valid_uuid(df, chosen).collect()] == ["2", "2"]


def test_reset_consensus_fill(spark):
    df = frame(spark, [("1", "1", "1", N, "7"), ("2", "2", "3", N, "7"), ("3", N, N, N, N)]).withColumn("valid_uuid", F.lit("old"))
    chosen = valid_uuid.choices_from(df, {"A": "USER_ID_UUID-USERNAME_UUID-RID_UUID"}, {"A": "RID_UUID"})
    agreed = valid_uuid.set_consensus(df, chosen)
    assert [r.valid_uuid for r in agreed.collect()] == ["1", None, None]
    filled = valid_uuid.fill_remainder(agreed, chosen)
    assert [r.valid_uuid for r in filled.collect()] == ["1", "7", None]
    assert filled.columns == df.columns
    again = valid_uuid.set_valid_uuid(filled, chosen)
    assert again.collect() == filled.collect()


def test_counts_of_valid_ids(spark):
    df = frame(spark, [("1", "1", "1", N, "7"), ("2", "2", "3", N, "7"), ("3", N, N, N, N)])
    chosen = valid_uuid.choices_from(df, {"A": "user_id_uuid-username_uuid"}, {})
    agreed = valid_uuid.set_valid_uuid(df, chosen)
    assert coverage.valid_uuid_counts(agreed).first().valid_uuid == 1
    assert coverage.null_valid_uuid_counts(agreed).first().unresolved == 2
    assert tuple(coverage.fillable_counts(agreed).first()) == ("A", 1, 1, 0, 1)


def test_a_table_without_choice_stays_without_valid_id(spark):
    df = frame(spark, [("1", "1", "1", N, N)])
    chosen = valid_uuid.choices_from(df, {"OTHER": "user_id_uuid-username_uuid"}, {})
    assert [r.valid_uuid for r in valid_uuid.set_valid_uuid(df, chosen).collect()] == [None]
