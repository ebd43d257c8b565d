"""One Spark query per operator, over the whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from uidloom.functions import fixed, frames, names, values
from uidloom.operators import coverage, match, resolve, sets, skew, valid_uuid
from uidloom.plans import bucketed, resolution
from uidloom.sources import catalog, session, snapshots, tables
from workload import views
from workload.oracle import BASE_TABLES

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["metadata_table", "id", "user_id"]
TEXT_COLUMNS = ["metadata_table", "id", "anonymous_id", "user_id", "email", "rid"]
RUN_AT = datetime(2024, 2, 1, tzinfo=UTC)
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.user_map(*views.identity_inputs(spark, sf))


def _hot_users(rows: DataFrame) -> dict[str, int]:
    return skew.hot_keys(rows, ["user_id"])["user_id"]


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{session.shared_folder(spark)}/uidloom/{name}-{uuid.uuid4().hex}"


# joins and resolution


@query
def resolve_user_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select(*KEYS)
    users = resolve.user_id_path(rows, views.masters(spark, sf))
    return resolve.write_back(rows, users, _hot_users(rows))


@query
def resolve_username(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    hot = skew.hot_keys(rows, ["user_id", "email"])
    users = resolve.username_path(rows, views.masters(spark, sf), hot)
    return resolve.write_back(rows.select(*KEYS), users, hot["user_id"])


@query
def resolve_persona(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select(*KEYS)
    users = resolve.persona_path(rows, views.personas(spark, sf), views.masters(spark, sf))
    return resolve.write_back(rows, users, _hot_users(rows))


@query
def resolve_rid(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, _, watched = views.identity_inputs(spark, sf)
    hot = resolve.measure_hot_keys(rows, watched)
    users = resolve.rid_path(rows, watched, masters, hot)
    return resolve.write_back(rows.select(*KEYS), users, hot["user_id"])


@query
def resolve_all(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve(*views.identity_inputs(spark, sf)).select(*TEXT_COLUMNS, *fixed.UUID_COLUMNS)


@query
def user_map(spark: SparkSession, sf: str) -> DataFrame:
    return _users(spark, sf).drop(*resolve.HITS.values())


@query
def resolve_rerun_keep_clear(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, personas, watched = views.identity_inputs(spark, sf)
    old = F.concat(F.lit("old-"), F.col("id"))
    previous = rows.select("*", *[old.alias(c) for c in fixed.UUID_COLUMNS])
    return resolve.resolve(previous, masters, personas, watched).select(*KEYS, *fixed.UUID_COLUMNS)


@query
def user_map_screened(spark: SparkSession, sf: str) -> DataFrame:
    """The map of users from the candidates that a filter of the lookup keys lets through."""
    return resolve.user_map(*views.identity_inputs(spark, sf), screened=True).drop(*resolve.HITS.values())


@query
def rerun_of_store(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with values of an earlier run, put into buckets of their users and resolved again where they lie."""
    rows, *others = views.identity_inputs(spark, sf)
    old = F.concat(F.lit("old-"), F.col("id"))
    database = f"uidloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        store, again = f"{database}.store", f"{database}.again"
        bucketed.save_store(rows.select("*", *[old.alias(c) for c in fixed.UUID_COLUMNS]), store)
        path = _new_folder(spark, "store")
        bucketed.rerun_store(spark, store, again, *others, path=path)
        schema = spark.table(again).schema
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(schema).parquet(path).select(*KEYS, *fixed.UUID_COLUMNS)


@query
def resolve_three_phase(spark: SparkSession, sf: str) -> DataFrame:
    return match.three_phase(*views.identity_inputs(spark, sf))


@query
def match_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, _, watched = views.identity_inputs(spark, sf)

    known = {"user_id": (masters, "uuid"), "email": (masters, "username"), "rid": (watched, "rid")}
    return match.match_rates(rows, known)


@query
def match_rate_of_emails(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, _, _ = views.identity_inputs(spark, sf)
    return match.match_rate(rows, "email", masters, "username")


# aggregations


@query
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.row_count(views.identifies(spark, sf))


@query
def non_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.non_null_counts(views.identifies(spark, sf), ["user_id", "email", "rid"])


@query
def uuid_counts_user_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    users = resolve.user_keys(rows)
    found = resolve.user_id_path(users, views.masters(spark, sf))
    counted = users.join(found, resolve.USER, "left")
    return coverage.uuid_counts(counted, "n_rows").select("metadata_table", "total", "user_id_uuid")


@query
def uuid_counts(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.uuid_counts(_users(spark, sf), "n_rows")


@query
def uuid_counts_long(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.uuid_counts_long(coverage.uuid_counts(_users(spark, sf), "n_rows"))


@query
def all_equal_summary(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.all_equal_summary(_users(spark, sf), "n_rows")


@query
def combo_counts(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.combo_counts(_users(spark, sf), "n_rows")


@query
def combo_report(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.combo_report(coverage.combo_counts(_users(spark, sf), "n_rows"))


@query
def report_labels(spark: SparkSession, sf: str) -> DataFrame:
    counts = coverage.combo_counts(_users(spark, sf), "n_rows")
    label = names.combo_label(F.col("metadata_table"), F.col("combo"))
    columns = names.label_columns(label)
    return counts.select(
        label.alias("label"),
        names.label_table(label).alias("table_part"),
        columns[0].alias("first_column"),
        columns[1].alias("second_column"),
        names.column_label(F.col("metadata_table"), columns[0]).alias("column_label"),
    )


# valid id


@query
def best_combo(spark: SparkSession, sf: str) -> DataFrame:
    return valid_uuid.best_combo(_users(spark, sf), "n_rows")


@query
def fallback_column(spark: SparkSession, sf: str) -> DataFrame:
    return valid_uuid.fallback_column(_users(spark, sf), "n_rows")


@query
def valid_uuid_consensus(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, personas, watched = views.identity_inputs(spark, sf)
    users, hot = resolve.mapped_users(rows, masters, personas, watched)
    users = session.materialize(users, "user_map")
    agreed = valid_uuid.set_consensus(users, valid_uuid.choices(users, "n_rows"))
    return resolve.write_back(rows.select(*KEYS), agreed, hot["user_id"]).select(*KEYS, "valid_uuid")


@query
def fill_remainder(spark: SparkSession, sf: str) -> DataFrame:
    """The valid id in two steps: the pairs that agree, then the rows that are still open."""
    rows, masters, personas, watched = views.identity_inputs(spark, sf)
    users, hot = resolve.mapped_users(rows, masters, personas, watched)
    users = session.materialize(users, "user_map")
    chosen = valid_uuid.choices(users, "n_rows")
    filled = valid_uuid.fill_remainder(valid_uuid.set_consensus(users, chosen), chosen)
    return resolve.write_back(rows.select(*KEYS), filled, hot["user_id"]).select(*KEYS, "valid_uuid")


@query
def valid_uuid_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = resolution.resolve_valid(*views.identity_inputs(spark, sf))
    return found.select(*KEYS, *fixed.UUID_COLUMNS, "valid_uuid")


@query
def valid_uuid_given_choice(spark: SparkSession, sf: str) -> DataFrame:
    rows, masters, personas, watched = views.identity_inputs(spark, sf)
    found = APPS
    chosen = valid_uuid.choices_from(
        rows,
        {name: "USER_ID_UUID-PERSONA_UUID" for name in found},
        {name: "RID_UUID" if "CLICK" in name else "USERNAME_UUID" for name in found},
    )
    resolved = resolution.resolve_valid(rows, masters, personas, watched, chosen=chosen)
    return resolved.select("metadata_table", "id", "valid_uuid")


@query
def valid_uuid_reset(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).withColumn("valid_uuid", F.col("user_id"))
    return frames.reset_column(rows, "valid_uuid").select("metadata_table", "id", "valid_uuid")


def _valid_users(spark: SparkSession, sf: str) -> DataFrame:
    return resolution.valid_users(_users(spark, sf))


@query
def valid_uuid_counts(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.valid_uuid_counts(_valid_users(spark, sf), "n_rows")


@query
def null_valid_uuid_counts(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.null_valid_uuid_counts(_valid_users(spark, sf), "n_rows")


@query
def fillable_counts(spark: SparkSession, sf: str) -> DataFrame:
    users = session.materialize(_users(spark, sf), "user_map")
    agreed = valid_uuid.set_consensus(users, valid_uuid.choices(users, "n_rows"))
    return coverage.fillable_counts(agreed, "n_rows")


# catalog and names


@query
def column_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog of all given tables, with the rows that each of them has."""
    database = f"uidloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        counted = []
        for name in BASE_TABLES:
            spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf}/{name}.parquet'")
            rows = views.table(spark, sf, name)
            counted.append(rows.agg(F.lit(name.upper()).alias("table_name"), F.count("*").alias("n_rows")))
        listed = catalog.column_catalog(spark, database).select("table_name", "column_name")
        return listed.join(reduce(DataFrame.unionByName, counted), "table_name")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def encode_names(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.with_segment_table(views.column_catalog(spark, sf))
    name = F.col("segment_table")
    return found.select(name, names.encode_table(name).alias("metadata_table")).distinct()


@query
def decode_names(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.with_segment_table(views.column_catalog(spark, sf)).select("table_name", "segment_table").distinct()


@query
def name_filter(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.wanted_tables(views.column_catalog(spark, sf)).select("segment_table").distinct()


@query
def tracked_columns(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tracked_columns(views.column_catalog(spark, sf)).select("table_name", "column_name")


@query
def table_columns(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.table_columns(views.column_catalog(spark, sf), "SEGMENT.NATION_8_PROD.IDENTIFIES")


@query
def identifies_tables(spark: SparkSession, sf: str) -> DataFrame:
    listed = views.column_catalog(spark, sf).select("table_name").distinct()
    return listed.where(F.endswith(F.col("table_name"), F.lit(fixed.TABLE_NAME_PARTS[0])))


def _descriptors(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.discover_tables(views.column_catalog(spark, sf))


@query
def discover_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.dashed(_descriptors(spark, sf))


@query
def descriptor_of(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.descriptor_of(catalog.dashed(_descriptors(spark, sf)), "SEGMENT.NATION_8_PROD.IDENTIFIES")


@query
def column_list_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    columns = values.split_columns(F.col("columns"))
    return catalog.dashed(_descriptors(spark, sf)).select(
        "metadata_table",
        F.size(columns).cast("long").alias("n_columns"),
        columns[0].alias("first_column"),
        F.element_at(columns, -1).alias("last_column"),
    )


@query
def planned_paths(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.planned_paths(_descriptors(spark, sf)).select(
        "metadata_table",
        "name",
        "new_uuid",
        names.uuid_column_of(F.col("name")).alias("uuid_column"),
        F.array_join("columns", "-").alias("columns"),
    )


@query
def preview_counts(spark: SparkSession, sf: str) -> DataFrame:
    return resolution.preview(_descriptors(spark, sf))


@query
def preview_combos(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.preview_combos(_descriptors(spark, sf))


# projections, filters, sets


@query
def tracked_projection(spark: SparkSession, sf: str) -> DataFrame:
    tracked = [c.lower() for c in (*fixed.KEY_COLUMNS, fixed.RID_COLUMN)]
    return frames.select_tracked(views.identifies(spark, sf), tracked)


@query
def complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    return frames.complete_rows(rows, (*fixed.KEY_COLUMNS, fixed.RID_COLUMN)).select(*TEXT_COLUMNS)


@query
def null_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)

    def part(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("part"), "metadata_table", "id")

    return part("with", frames.rows_with(rows, "user_id")).unionByName(
        part("without", frames.rows_without(rows, "user_id"))
    )


@query
def added_column(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select("id", "user_id")
    return frames.add_string_column(frames.add_string_column(rows, "valid_uuid"), "USER_ID")


@query
def resolution_time(spark: SparkSession, sf: str) -> DataFrame:
    stamped = frames.stamp(resolve_user_id(spark, sf), "at", "2024-02-01 00:00:00")
    at = F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("user_id_query_timestamp")
    return stamped.select("id", "user_id_uuid", at)


@query
def records(spark: SparkSession, sf: str) -> DataFrame:
    return frames.as_records(views.identifies(spark, sf)).select(
        F.col("record.id").alias("record_id"), F.col("record.user_id").alias("record_user_id")
    )


@query
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sets.distinct_rows(views.identifies(spark, sf).select("metadata_table", "user_id", "email"))


@query
def first_n(spark: SparkSession, sf: str) -> DataFrame:
    return sets.first_n(views.identifies(spark, sf).select(*KEYS), 10, ["metadata_table", "id"])


@query
def union_tables(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    kinds = {name.split("_")[2]: rows.where(F.col("metadata_table") == name).drop("metadata_table") for name in APPS}
    kinds["ERROR"] = kinds["ERROR"].drop("rid")
    kinds["CLICK"] = kinds["CLICK"].withColumn("USER_ID", F.col("user_id").cast("bigint"))
    return sets.union_tables(kinds, ["ID", "USER_ID", "RID"], {"user_id": "string"})


@query
def count_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    return sets.reconcile_counts(rows, session.materialize(rows, "copy"))


@query
def differing_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf)
    pairs = [rows, frames.rows_with(rows, "email")]
    found = sets.differing_rows(*[df.select("metadata_table", "user_id") for df in pairs])
    return found.withColumnRenamed(sets.DIFFERENCE, "n")


@query
def empty_lists(spark: SparkSession, sf: str) -> DataFrame:
    keys = F.array_compact(F.array("user_id", "email", "rid"))
    return views.identifies(spark, sf).select("id", values.is_empty_list(keys).alias("no_keys"))


# text


@query
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    documents = views.table(spark, sf, "documents")
    return documents.select("doc_id", values.collapse_spaces(F.col("text")).alias("text"))


@query
def to_bool(spark: SparkSession, sf: str) -> DataFrame:
    """Flags as texts of the given labels, some of them upper case or spelled out."""
    label, n = F.col("quality"), F.col("doc_id")
    word = F.when(n % 3 == 0, label.cast("string")).when(n % 3 == 1, (label == 1).cast("string"))
    word = F.coalesce(word, F.when(label == 1, F.lit("YES")).when(label == 0, F.lit("No")))
    found = views.table(spark, sf, "labels").select("doc_id", word.alias("word"))
    return found.withColumn("flag", values.to_bool(F.col("word")))


# snapshots and tables


def _times() -> list[Column]:
    """Both times, with microseconds that differ by row."""
    step = F.make_dt_interval(secs=(F.col("id").cast("bigint") % 1_000_000 / 1_000_000).cast("decimal(18,6)"))
    return [(F.col(c) + step).alias(c) for c in ("received_at", "sent_at")]


@query
def snapshot_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select(*TEXT_COLUMNS, *_times())
    return snapshots.save_and_verify(rows, _new_folder(spark, "snapshots"), "rows", RUN_AT)[1]


@query
def snapshot_round_trip_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select(*TEXT_COLUMNS, *_times())
    root = _new_folder(spark, "snapshots")
    path = snapshots.save_snapshot(rows, root, "rows", snapshots.CSV, RUN_AT)
    schema = rows.select("id", *[c for c in rows.columns if c != "id"]).schema
    return snapshots.load_snapshot(spark, path, schema)


@query
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.identifies(spark, sf).select("id", "user_id")
    root = _new_folder(spark, "snapshots")
    snapshots.save_snapshot(rows, root, "rows", snapshots.PARQUET, RUN_AT)
    later = RUN_AT.replace(microsecond=1)
    snapshots.save_snapshot(frames.rows_with(rows, "user_id"), root, "rows", snapshots.PARQUET, later)
    return snapshots.load_latest(spark, root, "rows")[1]


@query
def load_or_compute(spark: SparkSession, sf: str) -> DataFrame:
    root = _new_folder(spark, "snapshots")
    base = snapshots.DESCRIPTORS
    snapshots.load_or_compute(spark, root, base, lambda: _descriptors(spark, sf))
    loaded = snapshots.load_or_compute(spark, root, base, lambda: _descriptors(spark, sf).limit(0))[1]
    return catalog.dashed(loaded)


@query
def clone_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All app tables as copies that hold what their sources do, with two columns more."""
    with _app_tables(spark, sf) as (database, written):
        copies = {}
        for key in APPS:
            copies[key] = copy = f"{database}.COPY_OF_{key}"
            if not tables.clone_table(spark, written[key], copy):
                raise RuntimeError(f"the copy of {key} differs from its source")
            tables.add_column_if_absent(spark, copy, "user_id_uuid")
            tables.add_column_if_absent(spark, copy, "run name", default="'first'")
        columns = ["id", "anonymous_id", "user_id", "email", "rid", "page", "user_id_uuid", "run name"]
        wanted = sets.union_tables({key: spark.table(name) for key, name in copies.items()}, columns, {"user_id": "string"})
        return session.materialize(wanted.withColumnRenamed("run name", "run_name"), "copies")


@query
def latest_run_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the tables, of which one broke before its end; the latest complete one, read as one frame."""
    with _app_tables(spark, sf) as (database, _):
        root = _new_folder(spark, "run")
        found = resolution.discover(spark, database, root, RUN_AT)
        resolution.run_tables(spark, found, *views.identity_inputs(spark, sf)[1:], root, RUN_AT)
        broken = snapshots.snapshot_path(root, resolution.RESOLVED, snapshots.PARQUET, RUN_AT + timedelta(days=1))
        views.identifies(spark, sf).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
        _, rows = snapshots.load_latest(spark, root, resolution.RESOLVED)
        return rows.select("metadata_table", "id", "user_id", "page", *fixed.UUID_COLUMNS, "valid_uuid")


APPS = [f"SEGMENT__{kind}_APP__IDENTIFIES" for kind in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")]
NO_ROWS = "SEGMENT__EMPTY_APP__IDENTIFIES"


@contextmanager
def _app_tables(spark: SparkSession, sf: str, earlier: bool = False) -> Iterator[tuple[str, dict[str, str]]]:
    """The identifies rows as one catalog table per app, written at once, in a database that is dropped afterwards.

    One table lacks the rid, one keeps its user ids as numbers, one has no rows; all have an untracked column, and
    ``earlier`` adds UUID columns of an earlier run.
    """
    database, folder = f"uidloom_{uuid.uuid4().hex}", _new_folder(spark, "apps")
    rows = views.identifies(spark, sf).withColumn("page", F.concat(F.lit("/p/"), F.col("id")))
    if earlier:
        rows = rows.withColumns({c.upper(): F.concat(F.lit("old-"), F.col("id")) for c in fixed.UUID_COLUMNS})
    app = F.col("metadata_table")
    number = F.when(app == APPS[0], F.col("user_id")).cast("bigint")
    rows.withColumn("user_number", number).write.partitionBy("metadata_table").parquet(folder)
    empty = f"{folder}/metadata_table={NO_ROWS}"
    rows.drop("metadata_table").limit(0).write.parquet(empty)
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name in [*APPS, NO_ROWS]:
            own = [f for f in rows.schema.fields if f.name != "metadata_table" and not (f.name == "rid" and name == APPS[1])]
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
            place = f"USING parquet LOCATION '{folder}/metadata_table={name}'"
            if name == APPS[0]:  # the numbers, under the name of the key
                cells = ", ".join("user_number AS user_id" if f.name == "user_id" else f.name for f in own)
                spark.sql(f"CREATE TABLE {database}.numbers ({columns}, user_number bigint) {place}")
                spark.sql(f"CREATE VIEW {database}.{name} AS SELECT {cells} FROM {database}.numbers")
            else:
                spark.sql(f"CREATE TABLE {database}.{name} ({columns}) {place}")
        yield database, {name: f"{database}.{name}" for name in [*APPS, NO_ROWS]}
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _run(spark: SparkSession, sf: str, database: str) -> tuple[resolution.Run, DataFrame]:
    root = _new_folder(spark, "run")
    found = resolution.discover(spark, database, root, RUN_AT)
    return resolution.run_tables(spark, found, *views.identity_inputs(spark, sf)[1:], root, RUN_AT), found


def _saved(spark: SparkSession, run: resolution.Run) -> DataFrame:
    user = F.col("user_id").cast("string")
    columns = ["id", user.alias("user_id"), "page", *fixed.UUID_COLUMNS, "valid_uuid"]
    saved = [
        resolution.resolved_table(spark, run, name).select(F.lit(name).alias("metadata_table"), *columns)
        for name in [*APPS, NO_ROWS]
    ]
    return reduce(DataFrame.unionByName, saved)


@query
def run_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Discover the tables of a database, resolve them, and read what was saved."""
    with _app_tables(spark, sf) as (database, _):
        return _saved(spark, _run(spark, sf, database)[0])


@query
def resolution_times_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Per saved row the time of the run that resolved it."""
    with _app_tables(spark, sf) as (database, _):
        saved = snapshots.load_tables(spark, _run(spark, sf, database)[0].rows_path)
        at = F.date_format(resolution.RESOLVED_AT, "yyyy-MM-dd HH:mm:ss")
        return saved.select("metadata_table", "id", at.alias("resolved_at"))


@query
def rerun_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    with _app_tables(spark, sf, earlier=True) as (database, _):
        return _saved(spark, _run(spark, sf, database)[0]).drop("valid_uuid")


@query
def uuid_counts_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    with _app_tables(spark, sf) as (database, _):
        return _run(spark, sf, database)[0].counts


@query
def reports_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every report by table, with the table that has no rows."""
    with _app_tables(spark, sf) as (database, _):
        described = catalog.discover_tables(catalog.column_catalog(spark, database))
        users = _valid_users(spark, sf)
        reports = [
            coverage.row_count(users, "n_rows"),
            coverage.all_equal_summary(users, "n_rows"),
            coverage.valid_uuid_counts(users, "n_rows"),
            coverage.null_valid_uuid_counts(users, "n_rows"),
        ]
        filled = [coverage.for_tables(report, described) for report in reports]
        return reduce(lambda a, b: a.join(b, "metadata_table"), filled)


@query
def existing_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The listed tables that hold rows, and whether they were written and are found by name."""
    with _app_tables(spark, sf) as (database, written):
        listed = [name for name in tables.existing_metadata_tables(spark, database) if name.upper() != NO_ROWS]
        rows = [(n.upper(), tables.metadata_table_exists(spark, n, database), n.upper() in written) for n in listed]
        counted = [spark.table(f"{database}.{n}").agg(F.lit(n.upper()).alias("name"), F.count("*").alias("n_rows")) for n in listed]
        described = spark.createDataFrame(rows, "name string, found boolean, written boolean")
        return described.join(reduce(DataFrame.unionByName, counted), "name")


@query
def table_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """The columns and types of each table, beside the rows it has."""
    with _app_tables(spark, sf) as (_, written):
        described = [
            tables.describe_table(spark, name)
            .withColumn("table_name", F.lit(key))
            .crossJoin(F.broadcast(spark.table(name).agg(F.count("*").alias("n_rows"))))
            for key, name in written.items()
        ]
        found = reduce(DataFrame.unionByName, described)
        return found.select("table_name", F.col("name").alias("column_name"), "type", "nullable", "n_rows")


QUERIES["valid_uuid"] = QUERIES.pop("valid_uuid_rows")
