from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from uidloom.functions import fixed, frames, names, values


def column(spark, values_in, function, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values_in], schema)
    return [row[0] for row in df.select(function(F.col("v")).alias("out")).collect()]


NAMES = [
    ("SEGMENT__WEB_PROD__IDENTIFIES", "SEGMENT.WEB_PROD.IDENTIFIES"),
    ("APP_OPEN", "LOOKER_SOURCE.PUBLIC.APP_OPEN"),
]


def test_names_both_ways(spark):
    encoded, decoded = zip(*NAMES)
    assert column(spark, encoded, names.decode_table) == list(decoded)
    assert column(spark, decoded, names.encode_table) == list(encoded)


def test_encoding_is_not_invertible_everywhere(spark):
    assert column(spark, ["A.B", "A__B", "X.LOOKER_SOURCE.PUBLIC.Y"], names.encode_table) == ["A__B", "A__B", "X__Y"]


@settings(max_examples=10, deadline=None)
@given(parts=st.lists(st.from_regex(r"[A-Z]([A-Z0-9]|_(?!_))*[A-Z0-9]", fullmatch=True), min_size=1, max_size=8))
def test_decoding_an_encoded_name_gives_it_back(spark, parts):
    one_part = [f"LOOKER_SOURCE.PUBLIC.{p}" for p in parts]
    three_parts = [f"{a}.{b}.{c}" for a, b, c in zip(parts, reversed(parts), parts)]
    full = one_part + three_parts
    assert column(spark, full, lambda c: names.decode_table(names.encode_table(c))) == full


def test_query_names(spark):
    queries = ["user_id_query", "username_query", "persona_query", "rid_query"]
    columns = ["USER_ID_UUID", "USERNAME_UUID", "PERSONA_UUID", "RID_UUID"]
    assert column(spark, queries, names.uuid_column_of) == columns
    assert column(spark, columns, names.query_name_of) == queries
    assert [c.lower() for c in columns] == list(fixed.UUID_COLUMNS)


def test_contains_any_is_case_sensitive(spark):
    assert column(spark, ["a", "c", "cab", "A", None], lambda c: names.contains_any(c, ["a", "b"])) == [
        True, False, True, False, None,
    ]
    assert column(spark, ["a", "c"], lambda c: names.contains_none(c, ["a", "b"])) == [False, True]
    assert column(spark, ["a"], lambda c: names.contains_any(c, [])) == [False]


def test_labels(spark):
    df = spark.createDataFrame([("T", "user_id_uuid-rid_uuid")], "t string, c string")
    label = names.combo_label(F.col("t"), F.col("c"))
    other = names.column_label(F.col("t"), F.lit("valid_uuid"))
    row = df.select(
        label, names.label_table(label), names.label_columns(label),
        other, names.label_table(other), names.label_columns(other),
    ).first()
    assert list(row) == [
        "T@USER_ID_UUID-RID_UUID", "T", ["user_id_uuid", "rid_uuid"], "T @ VALID_UUID", "T", ["valid_uuid"],
    ]


@pytest.mark.parametrize(
    ("flag", "words"),
    [
        (True, ["yEs", "tRUE", "yES", "truE", *fixed.TRUE_WORDS]),
        (False, ["tt", "01", " yes", "true ", "ye", "tru", "11", "no", "-1", "on", "1.0", "yes!"]),
        (None, [None]),
    ],
)
def test_to_bool(spark, flag, words):
    assert column(spark, words, values.to_bool) == [flag] * len(words)


@settings(max_examples=10, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \t\n\x0b\f\rab", max_size=12), min_size=1, max_size=20))
def test_collapse_spaces(spark, texts):
    expected = [re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ") for t in texts]
    assert column(spark, texts, values.collapse_spaces) == expected


def test_percent(spark):
    df = spark.createDataFrame([(1, 4), (3, 0), (0, 5)], "a long, b long")
    assert [r[0] for r in df.select(values.percent(F.col("a"), F.col("b"))).collect()] == [25.0, 0.0, 0.0]


def test_thousands(spark):
    assert column(spark, [0, 999, 1234, 2452006], values.thousands, "v long") == ["0", "999", "1,234", "2,452,006"]


def test_column_lists(spark):
    lists = [["USER_ID", "EMAIL", "ID"], []]
    assert column(spark, lists, values.join_columns, "v array<string>") == ["EMAIL-ID-USER_ID", ""]
    assert column(spark, ["EMAIL-ID"], values.split_columns) == [["EMAIL", "ID"]]
    assert column(spark, [["A"]], lambda c: values.append_column(c, "B"), "v array<string>") == [["A", "B"]]
    assert column(spark, [["A"], [], None], values.is_empty_list, "v array<string>") == [False, True, True]


def test_all_equal_needs_values(spark):
    df = spark.createDataFrame([("x", "x", "x"), ("x", "x", "y"), ("x", None, "x"), (None, None, None)], "a string, b string, c string")
    found = df.select(F.coalesce(values.all_equal([F.col(c) for c in "abc"]), F.lit(False))).collect()
    assert [r[0] for r in found] == [True, False, False, False]


def test_frames(spark):
    df = spark.createDataFrame([("1", None), ("2", "x")], "ID string, email string")
    assert frames.add_string_column(df, "EMAIL") is df
    added = frames.add_string_column(df, "valid_uuid")
    assert added.schema["valid_uuid"].dataType.simpleString() == "string"
    assert [r.valid_uuid for r in added.collect()] == [None, None]
    assert [r.email for r in frames.reset_column(df, "email").collect()] == [None, None]
    assert frames.select_tracked(df, fixed.TRACKED_COLUMNS).columns == ["ID", "EMAIL"]
    assert [r.ID for r in frames.complete_rows(df, ["ID", "EMAIL", "RID"]).collect()] == ["2"]
    assert [r.ID for r in frames.rows_with(df, "email").collect()] == ["2"]
    assert [r.ID for r in frames.rows_without(df, "email").collect()] == ["1"]
    assert [r.record.ID for r in frames.as_records(df).collect()] == ["1", "2"]
    assert frames.frame_length(df) == 2 and frames.frame_length(None) == 0
    assert frames.is_empty(None) and frames.is_empty(df.limit(0)) and not frames.is_empty(df)
    stamped = frames.stamp(df, "at", "2024-02-01 00:00:00").select(F.date_format("at", "yyyy-MM-dd").alias("d"))
    assert {r.d for r in stamped.collect()} == {"2024-02-01"}
