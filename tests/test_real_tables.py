"""Runs over tables of a Spark catalog, and inputs that are not as clean as the fixtures."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from uidloom.operators import coverage, match, resolve, sets, skew, valid_uuid
from uidloom.plans import resolution
from uidloom.sources import catalog, session, snapshots, tables

AT = datetime(2024, 2, 1, tzinfo=UTC)
LATER = datetime(2024, 2, 2, tzinfo=UTC)


@pytest.fixture()
def apps(spark, database):
    """Three tables to resolve, one without rows, one without a rid, and two to leave out."""
    web = "ID string, ANONYMOUS_ID string, USER_ID string, EMAIL string, RID string, PAGE string, PERSONA_UUID string"
    rows = [("i1", "a1", "1", "ann", "r1", "/x", "old"), ("i2", "a2", "2", "cid", None, "/y", "old"), ("i3", "a3", None, "ann", None, "/z", "old")]
    spark.createDataFrame(rows, web).write.saveAsTable(f"{database}.SEGMENT__WEB__IDENTIFIES")
    app = "ID string, ANONYMOUS_ID string, USER_ID bigint, EMAIL string"
    spark.createDataFrame([("i1", "a1", 1, None)], app).write.saveAsTable(f"{database}.SEGMENT__APP__IDENTIFIES")
    spark.createDataFrame([], web).write.saveAsTable(f"{database}.SEGMENT__NEW__IDENTIFIES")
    spark.createDataFrame([("i1",)], "ID string").write.saveAsTable(f"{database}.SEGMENT__OLD__IDENTIFIES")
    spark.createDataFrame(rows, web).write.saveAsTable(f"{database}.SEGMENT__DEV__IDENTIFIES")
    spark.createDataFrame(rows, web).createOrReplaceTempView("SEGMENT__VIEW__IDENTIFIES")
    yield database
    spark.catalog.dropTempView("SEGMENT__VIEW__IDENTIFIES")


@pytest.fixture()
def others(inputs):
    return inputs([], [("1", "ann"), ("2", "bob")], ["1"], [("r1", "2")])[1:]


WEB, APP, NEW = (f"SEGMENT__{x}__IDENTIFIES" for x in ("WEB", "APP", "NEW"))


def test_discovery_on_a_catalog_finds_and_reads_its_tables(spark, apps, tmp_path):
    found = resolution.discover(spark, apps, str(tmp_path), AT)
    assert {r.metadata_table for r in found.collect()} == {WEB, APP, NEW}
    rows = resolution.read_discovered(spark, found)
    assert rows.count() == 4 and dict(rows.dtypes)["user_id"] == "string"
    given = catalog.column_catalog(spark, apps).drop("source_name").where("table_name <> 'SEGMENT__APP__IDENTIFIES'")
    again = resolution.discover(spark, given, str(tmp_path), LATER)
    assert {r.segment_table for r in again.collect()} == {"SEGMENT.WEB.IDENTIFIES", "SEGMENT.NEW.IDENTIFIES"}
    assert resolution.read_discovered(spark, again, lambda segment, metadata: f"{apps}.{metadata}").count() == 3


def test_no_tables_give_frames_without_rows(spark, database, tmp_path, others):
    found = resolution.discover(spark, database, str(tmp_path), AT)
    assert found.columns == ["segment_table", "metadata_table", "columns", "source_name"] and found.isEmpty()
    rows = resolution.read_discovered(spark, found)
    assert rows.isEmpty() and rows.columns[0] == "metadata_table"
    run = resolution.run_tables(spark, found, *others, str(tmp_path), AT)
    assert run.counts.isEmpty()


def test_run_keeps_all_columns_and_earlier_values(spark, apps, tmp_path, others):
    root = str(tmp_path)
    run = resolution.run_tables(spark, resolution.discover(spark, apps, root, AT), *others, root, AT)
    web = resolution.resolved_table(spark, run, WEB)
    assert web.columns[:6] == ["ID", "ANONYMOUS_ID", "USER_ID", "EMAIL", "RID", "PAGE"]
    got = {r.ID: (r.PAGE, r.user_id_uuid, r.username_uuid, r.persona_uuid, r.rid_uuid, r.valid_uuid) for r in web.collect()}
    assert got == {
        "i1": ("/x", "1", "1", "1", "2", "1"),
        "i2": ("/y", "2", None, "old", None, "old"),  # the persona column fills most of the rows that are left
        "i3": ("/z", None, None, "old", None, "old"),
    }
    assert web.select(F.unix_timestamp(resolution.RESOLVED_AT)).distinct().collect() == [(int(AT.timestamp()),)]
    app = resolution.resolved_table(spark, run, APP)
    assert dict(app.dtypes)["USER_ID"] == "bigint" and app.first().user_id_uuid == "1"
    assert resolution.resolved_table(spark, run, NEW).isEmpty()
    counts = {r.metadata_table: tuple(r)[1:] for r in run.counts.collect()}
    assert counts == {WEB: (3, 2, 1, 3, 1), APP: (1, 1, 0, 1, None), NEW: (0, 0, 0, 0, 0)}


def test_intermediate_frames_of_a_run_are_removed(spark, apps, tmp_path, others):
    from pathlib import Path

    shared = Path(session.shared_folder(spark).removeprefix("file://")) / "uidloom"
    before = set(shared.iterdir()) if shared.exists() else set()
    resolution.run_tables(spark, resolution.discover(spark, apps, str(tmp_path), AT), *others, str(tmp_path), AT)
    assert not {p.name for p in set(shared.iterdir()) - before if p.name.startswith("run-")}


def test_saved_rows_are_partitioned_by_table(spark, inputs, tmp_path):
    frames = inputs([("A", "1", "ann", None), ("B", "2", None, None)], [("1", "ann")], [], [])
    run = resolution.run(*frames, str(tmp_path), AT)
    read = spark.read.parquet(run.rows_path).where("metadata_table = 'A'")
    assert read.count() == 1 and "PartitionFilters: [isnotnull(metadata_table" in read._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_read_once_without_hot_users(spark, inputs, tmp_path):
    rows, masters, personas, watched = inputs([("A", str(k % 7), "ann", f"r{k}") for k in range(50)], [("1", "ann")], ["1"], [("r1", "1")])
    previous = rows.withColumn("persona_uuid", F.lit("old")).withColumn("rid_uuid", F.lit("old"))
    for k, frame in enumerate((rows, previous)):
        path = str(tmp_path / f"rows{k}")
        frame.write.parquet(path)
        none = {"user_id": {}, "email": {}, "rid": {}, "watched": {}}
        found = resolution.resolve_valid(spark.read.parquet(path), masters, personas, watched, none)
        text = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in text.splitlines() if "ReadSchema" in line and "anonymous_id" in line.split("ReadSchema")[1]]
        assert len(scans) == 1 and found.count() == 50


def test_a_rerun_writes_no_wide_rows_in_between(spark, inputs, monkeypatch):
    frames = inputs([("A", "1", "ann", "r1"), ("A", None, "ann", None)], [("1", "ann")], ["1"], [("r1", "1")])
    first = resolution.resolve_valid(*frames)
    written = []
    monkeypatch.setattr(resolution, "materialize", lambda df, name, *rest: written.append(df.columns) or session.materialize(df, name, *rest))
    again = resolution.resolve_valid(first, *frames[1:])
    assert sets.same_rows(first, again.select(*first.columns))
    assert written and not any("anonymous_id" in columns for columns in written)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_csv_keeps_microseconds_and_odd_cells(spark, tmp_path, kind):
    cells = ["\x00", "\\\x00", "\\", "", None, "a\x00b", "\\\\\x00", ' "q" ', "\n"]
    rows = [(str(k), cell, "2024-02-01 10:00:00.123456") for k, cell in enumerate(cells)]
    frame = spark.createDataFrame(rows, "ID string, name string, at string").withColumn("at", F.col("at").cast(kind))
    path = snapshots.save_snapshot(frame, str(tmp_path), "base", snapshots.CSV, AT)
    loaded = snapshots.load_snapshot(spark, path, frame.schema)
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, frame.collect()), key=lambda r: r[0])


def test_save_and_verify_computes_its_input_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    frame = spark.range(10).mapInArrow(count, "id bigint")
    assert snapshots.save_and_verify(frame, str(tmp_path), "base", AT)[1].count() == 10
    assert runs.value == 10


def test_a_snapshot_that_differs_is_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "load_snapshot", lambda spark, path, schema=None: spark.read.parquet(path).limit(3))
    with pytest.raises(RuntimeError, match="differs"):
        snapshots.save_and_verify(spark.range(10), str(tmp_path), "base", AT)


def test_union_of_tables_with_other_types(spark):
    numbers = spark.createDataFrame([(1, "x")], "USER_ID bigint, ID string")
    texts = spark.createDataFrame([("abc", "y")], "user_id string, id string")
    united = sets.union_tables({"N": numbers, "T": texts}, ["ID", "USER_ID", "RID"], {"user_id": "string"})
    assert {tuple(r) for r in united.collect()} == {("N", "x", "1", None), ("T", "y", "abc", None)}
    assert sets.union_tables({}, ["ID"], {"id": "string"}).dtypes == [("metadata_table", "string"), ("id", "string")]
    many = sets.union_tables({f"T{k}": texts for k in range(7)}, ["ID"])
    assert many.count() == 7


def test_upper_case_valid_id_and_repeated_choices(spark):
    rows = spark.createDataFrame([("A", "1", "1", None, "2", "x")], "metadata_table string, user_id_uuid string, username_uuid string, persona_uuid string, rid_uuid string, VALID_UUID string")
    chosen = spark.createDataFrame([("A", "user_id_uuid-username_uuid", None), ("A", None, "rid_uuid")], "metadata_table string, combo string, fallback string")
    found = valid_uuid.set_valid_uuid(rows, chosen)
    assert found.columns == rows.columns and found.count() == 1
    one = chosen.where("combo IS NOT NULL")
    for df in (valid_uuid.set_valid_uuid(rows, one), valid_uuid.set_consensus(rows, one)):
        assert df.columns == rows.columns and df.first().VALID_UUID == "1"
    assert valid_uuid.fill_remainder(rows, chosen.where("fallback IS NOT NULL")).first().VALID_UUID == "x"


def test_rows_without_a_rid_column(spark, inputs):
    rows, masters, personas, watched = inputs([("A", "1", "ann", "r1")], [("1", "ann")], ["1"], [("r1", "1")])
    found = resolve.resolve(rows.drop("rid"), masters, personas, watched).first()
    assert (found.user_id_uuid, found.username_uuid, found.persona_uuid, found.rid_uuid) == ("1", "1", "1", None)


def test_added_columns_have_quoted_names_and_defaults(spark, database):
    spark.createDataFrame([("1",)], "id string").write.saveAsTable(f"{database}.t")
    assert tables.add_column_if_absent(spark, f"{database}.t", "odd name`s")
    assert tables.add_column_if_absent(spark, f"{database}.t", "kind", default="'new'")
    assert not tables.add_column_if_absent(spark, f"{database}.t", "KIND")
    assert tuple(spark.table(f"{database}.t").first()) == ("1", None, "new")


def test_match_rates_equal_single_rates(spark, inputs):
    rows, masters, _, watched = inputs([("A", str(k), "ann" if k % 2 else None, f"r{k}") for k in range(9)], [("1", "ann"), ("2", "x")], [], [("r1", "1"), ("r1", "2")])
    known = {"user_id": (masters, "uuid"), "email": (masters, "username"), "rid": (watched, "rid")}
    together = {r.column_name: tuple(r)[1:] for r in match.match_rates(rows, known).collect()}
    assert together == {c: tuple(match.match_rate(rows, c, *other).first()) for c, other in known.items()}
    assert {tuple(r) for r in match.match_rates(rows.limit(0), known).collect()} == {(c, 0, 0, 0.0) for c in known}


def test_reports_fill_tables_without_rows(spark):
    described = spark.createDataFrame([("A", ["RID"]), ("B", ["ID"]), ("C", ["RID"])], "metadata_table string, columns array<string>")
    report = spark.createDataFrame([("A", 3, 1.5, 2), ("B", 1, 0.5, 0)], "metadata_table string, total bigint, share double, rid_uuid bigint")
    found = {tuple(r) for r in coverage.for_tables(report, described).collect()}
    assert found == {("A", 3, 1.5, 2), ("B", 1, 0.5, None), ("C", 0, 0.0, 0)}


def test_hot_keys_are_bounded_by_the_partitions(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert list(skew.hot_keys(rows, ["k"])["k"]) == ["hot"]
    assert re.match(r"\d+$", str(skew.MAX_HOT_KEYS))


def many_tables(spark, database, n):
    """Tables of three schemas, one row each."""
    kinds = ["id string, anonymous_id string, user_id string, email string", "id string, anonymous_id string, user_id bigint, email string, rid string"]
    kinds.append("id string, anonymous_id string, user_id string, email string, `own column` double")
    names = []
    for k in range(n):
        name = f"{database}.T{k}_APP__IDENTIFIES"
        spark.sql(f"CREATE TABLE {name} ({kinds[k % 3]}) USING parquet")
        spark.sql(f"INSERT INTO {name} (id, anonymous_id, user_id, email) VALUES ('i{k}', 'a', {k if k % 3 == 1 else repr(str(k))}, 'x@y')")
        names.append((f"T{k}", name))
    return names


def test_tables_of_one_schema_are_one_scan(spark, database):
    names = many_tables(spark, database, 12)
    rows = tables.read_identifies(spark, names)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    assert sorted((r["metadata_table"], r["id"], r["user_id"]) for r in rows.collect()) == sorted(
        (key, f"i{k}", str(k)) for k, (key, _) in enumerate(names)
    )


def test_a_table_with_a_default_a_view_and_partitions_are_read_on_their_own(spark, database):
    names = many_tables(spark, database, 4)
    tables.add_column_if_absent(spark, names[0][1], "rid", default="'old rows'")
    spark.sql(f"CREATE VIEW {database}.V AS SELECT * FROM {names[1][1]}")
    spark.sql(f"CREATE TABLE {database}.C (id char(4), anonymous_id varchar(9), user_id string, email string) USING parquet")
    spark.sql(f"INSERT INTO {database}.C VALUES ('i', 'a', '1', 'x@y')")
    assert tables.read_identifies(spark, [*names, ("C", f"{database}.C")]).where("metadata_table = 'C'").first()["id"] == "i   "
    spark.sql(f"CREATE TABLE {database}.P PARTITIONED BY (email) AS SELECT * FROM {names[2][1]}")
    rows = tables.read_identifies(spark, [*names, ("V", f"{database}.V"), ("P", f"{database}.P")]).collect()
    found = {r["metadata_table"]: (r["id"], r["email"], r["rid"]) for r in rows}
    assert found["T0"] == ("i0", "x@y", "old rows") and found["V"] == ("i1", "x@y", None) and found["P"] == ("i2", "x@y", None)
    assert len(rows) == 6


def test_a_run_is_found_as_a_whole_or_not_at_all(spark, database, tmp_path, inputs, monkeypatch):
    names, root = many_tables(spark, database, 6), str(tmp_path / "runs")
    spark.sql(f"CREATE TABLE {database}.NONE_APP__IDENTIFIES (id string, anonymous_id string, user_id string, email string) USING parquet")
    others = inputs(masters=[("1", "x@y"), ("2", "b")], personas=["2"], watched=[])[1:]
    found = resolution.discover(spark, database, root, AT)
    run = resolution.run_tables(spark, found, *others, root, AT)
    path, rows = snapshots.load_latest(spark, root, resolution.RESOLVED)
    assert path.rstrip("/").endswith(run.rows_path.rsplit("/", 1)[-1])
    assert rows.count() == 6 and dict(rows.dtypes)["user_id"] == "string" and "own column" in rows.columns
    assert {r["username_uuid"] for r in rows.collect()} == {"1"}
    assert dict(resolution.resolved_table(spark, run, "T1_APP__IDENTIFIES").dtypes)["user_id"] == "bigint"
    assert resolution.resolved_table(spark, run, "NONE_APP__IDENTIFIES").isEmpty()

    written = resolution._write_group
    done = []

    def breaks(rows, path, n):
        if len(done) == 2:
            raise OSError("lost")
        done.append(written(rows, path, n))
        return done[-1]

    monkeypatch.setattr(resolution, "_write_group", breaks)
    monkeypatch.setattr(resolution, "WRITERS", 1)
    with pytest.raises(OSError):
        resolution.run_tables(spark, found, *others, root, AT + timedelta(days=1))
    assert len(done) == 2
    assert snapshots.load_latest(spark, root, resolution.RESOLVED)[0] == path


def test_the_catalog_is_listed_like_table_by_table(spark, database):
    many_tables(spark, database, 3)
    spark.sql(f"CREATE TABLE {database}.odd (a decimal(10,2) NOT NULL, b varchar(5), c array<struct<x: int>>, `d e` timestamp_ntz) USING parquet")
    spark.sql(f"CREATE VIEW {database}.seen AS SELECT a, 1 AS one FROM {database}.odd")
    listed = sorted(map(tuple, catalog.column_catalog(spark, database).collect()))
    assert listed == sorted(catalog._columns_one_by_one(spark, database)) and len(listed) > 15
