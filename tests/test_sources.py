from __future__ import annotations

from datetime import UTC, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from uidloom.operators import sets
from uidloom.sources import session, snapshots, tables

AT = datetime(2024, 2, 1, 12, 30, tzinfo=UTC)
LATER = datetime(2024, 2, 1, 12, 30, 0, 1, tzinfo=UTC)


@pytest.fixture()
def frame(spark):
    rows = [("x", "1", "a,b"), ('q"uote', "2", None), ("", "3", "two\nlines"), ("back\\slash", "4", " padded "), ("\\N", "5", "\r\ncr\r")]
    return spark.createDataFrame(rows, "name string, ID string, note string")


@pytest.mark.parametrize("file_format", [snapshots.CSV, snapshots.PARQUET])
def test_round_trip(spark, frame, tmp_path, file_format):
    path = snapshots.save_snapshot(frame, str(tmp_path), "base", file_format, AT)
    assert path.endswith(f"run_ts=20240201T123000000000Z.{file_format}")
    schema = "ID string, name string, note string" if file_format == snapshots.CSV else None
    loaded = snapshots.load_snapshot(spark, path, schema)
    assert loaded.columns == (["ID", "name", "note"] if schema else frame.columns)
    assert sets.same_rows(frame, loaded.select(*frame.columns))


def test_default_format_is_csv_and_needs_a_schema(spark, frame, tmp_path):
    path = snapshots.save_snapshot(frame, str(tmp_path), "base", at=AT)
    with pytest.raises(ValueError, match="schema"):
        snapshots.load_snapshot(spark, path)
    with pytest.raises(ValueError, match="format"):
        snapshots.save_snapshot(frame, str(tmp_path), "base", "orc", AT)


def test_latest_is_the_newest_complete_run(spark, frame, tmp_path):
    root = str(tmp_path)
    assert snapshots.latest_snapshot(spark, root, "base") is None
    assert snapshots.load_latest(spark, root, "base") is None
    snapshots.save_snapshot(frame, root, "base", snapshots.PARQUET, LATER)
    snapshots.save_snapshot(frame.limit(1), root, "base", snapshots.PARQUET, AT)
    snapshots.save_snapshot(frame.limit(1), root, "base_2", snapshots.PARQUET)
    (tmp_path / "base" / "run_ts=20250101T000000000000Z.parquet").mkdir()
    path, loaded = snapshots.load_latest(spark, root, "base")
    assert path.endswith("run_ts=20240201T123000000001Z.parquet") and loaded.count() == 5


def test_a_snapshot_is_never_overwritten(frame, tmp_path):
    snapshots.save_snapshot(frame, str(tmp_path), "base", snapshots.PARQUET, AT)
    with pytest.raises(Exception, match="exists"):
        snapshots.save_snapshot(frame, str(tmp_path), "base", snapshots.PARQUET, AT)


def test_load_or_compute(spark, frame, tmp_path):
    root, calls = str(tmp_path), []

    def compute():
        calls.append(1)
        return frame

    first, _ = snapshots.load_or_compute(spark, root, "base", compute)
    second, loaded = snapshots.load_or_compute(spark, root, "base", compute)
    assert Path(first).name == Path(second).name and len(calls) == 1 and sets.same_rows(frame, loaded)
    snapshots.load_or_compute(spark, root, "base", compute, use_latest=False)
    assert len(calls) == 2
    snapshots.save_snapshot(frame.limit(0), root, "base", snapshots.PARQUET)
    snapshots.load_or_compute(spark, root, "base", compute)
    assert len(calls) == 3


def test_save_and_verify(spark, frame, tmp_path):
    path, loaded = snapshots.save_and_verify(frame, str(tmp_path), "base", LATER)
    assert sets.same_rows(frame, loaded)
    with pytest.raises(RuntimeError, match="latest"):
        snapshots.save_and_verify(frame, str(tmp_path), "base", AT)


def test_differing_rows_counts_copies_and_nulls(spark):
    left = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    right = spark.createDataFrame([("a", None), ("c", "x")], "k string, v string")
    assert {tuple(r) for r in sets.differing_rows(left, right).collect()} == {("a", None, 1), ("b", "x", 1), ("c", "x", -1)}
    assert not sets.same_rows(left, right) and sets.same_rows(left, left)


def test_clone_checks_counts_and_never_replaces(spark, database):
    source, target = f"{database}.source", f"{database}.A__IDENTIFIES"
    spark.createDataFrame([("1", "u")], "id string, user_id string").write.saveAsTable(source)
    assert not tables.clone_table(spark, source, target, preview=True)
    assert not tables.metadata_table_exists(spark, "A__IDENTIFIES", database)
    assert tables.clone_table(spark, source, target)
    assert not tables.clone_table(spark, source, target)
    assert sets.same_rows(spark.table(source), spark.table(target))
    assert tables.metadata_table_exists(spark, "A__IDENTIFIES", database)
    assert [n.upper() for n in tables.existing_metadata_tables(spark, database)] == ["A__IDENTIFIES"]
    assert tables.existing_metadata_tables(spark, "no_such_database") == []


def test_describe_and_add_column(spark, database):
    name = f"{database}.T__IDENTIFIES"
    assert tables.describe_table(spark, name) is None and tables.table_column_names(spark, name) is None
    spark.createDataFrame([("1",)], "id string").write.saveAsTable(name)
    assert tables.add_column_if_absent(spark, name, "VALID_UUID")
    assert not tables.add_column_if_absent(spark, name, "valid_uuid")
    assert [tuple(r) for r in tables.describe_table(spark, name).collect()] == [
        ("id", "string", True), ("VALID_UUID", "string", True),
    ]
    assert [tuple(r) for r in spark.table(name).collect()] == [("1", None)]


def test_many_tables_as_one_frame(spark, database):
    spark.createDataFrame([("1", "r")], "ID string, RID string").write.saveAsTable(f"{database}.a")
    spark.createDataFrame([("2", "u")], "id string, user_id string").write.saveAsTable(f"{database}.b")
    rows = tables.read_identifies(spark, [("A", f"{database}.a"), ("B", f"{database}.b")])
    found = {(r.metadata_table, r.id, r.user_id, r.rid, r.sent_at) for r in rows.collect()}
    assert found == {("A", "1", None, "r", None), ("B", "2", "u", None, None)}


def test_a_missing_column_takes_the_type_of_the_others(spark):
    a = spark.createDataFrame([("1",)], "ID string")
    b = spark.sql("SELECT '2' AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS SENT_AT")
    rows = sets.union_tables({"A": a, "B": b}, ["ID", "SENT_AT", "RID"])
    assert [f.dataType.simpleString() for f in rows.schema.fields] == ["string", "string", "timestamp_ntz", "string"]
    assert {(r.id, r.sent_at is None) for r in rows.collect()} == {("1", True), ("2", False)}


def test_sets(spark):
    df = spark.createDataFrame([("b", None), ("a", "1"), ("b", None)], "k string, v string")
    assert sets.distinct_rows(df).count() == 2
    assert [r.k for r in sets.first_n(df, 2, ["k", "v"]).collect()] == ["a", "b"]
    counts = {r.k: tuple(r)[1:] for r in sets.reconcile_counts(df, df.where("k = 'a'"), "k").collect()}
    assert counts == {"a": (1, 1, True), "b": (2, 0, False)}


def test_materialize_writes_to_the_shared_folder(spark, frame):
    written = session.materialize(frame, "frame")
    assert sets.same_rows(frame, written)
    assert all(session.shared_folder(spark) in name for name in written.inputFiles())
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get(session.CHECKPOINT_SETTING)


class Settings(dict):
    def set(self, name, value):
        self[name] = value


def fake_session(master, **settings):
    context = SimpleNamespace(master=master, getConf=lambda: Settings(settings))
    return SimpleNamespace(conf=Settings(settings), sparkContext=context)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake_session("yarn"))
    named = fake_session("yarn", **{session.CHECKPOINT_SETTING: "hdfs://x/shared/"})
    assert session.shared_folder(named) == "hdfs://x/shared"
    local = fake_session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_a_large_csv_file_is_read_in_many_tasks(spark, tmp_path):
    texts = ["a\nb", "a\r\nb", "\\n", "\\", "\\s\\z", "\0", "\\\0", '"', '",\n"', "", None, " x ", " ", "\x85"]
    rows = [(k, texts[k % len(texts)]) for k in range(4000)]
    df = spark.createDataFrame(rows, "k long, v string").coalesce(1)
    path = snapshots.save_snapshot(df, str(tmp_path), "csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        loaded = snapshots.load_snapshot(spark, path, df.schema)
        assert loaded.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, loaded.collect()), key=lambda r: r[0]) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_changed_cell_with_equal_counts_is_found(spark, database):
    rows = [("1", "u", 1.5), ("2", "v", None), ("3", None, 2.5)]
    df = spark.createDataFrame(rows, "id string, user_id string, x double")
    expected = df.agg(*[c.alias(n) for n, c in tables.content_sums(df).items()]).first().asDict()
    assert tables.matches_content(df.repartition(3), expected)
    for changed in ([("1", "u", 1.5), ("2", "v", None), ("3", "", 2.5)], [("1", "v", 1.5), ("2", "u", None), ("3", None, 2.5)]):
        assert not tables.matches_content(spark.createDataFrame(changed, df.schema), expected)
