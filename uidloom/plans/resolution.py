"""The whole flow: discover the tables, resolve their users, choose a valid id, report, and save."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from uidloom.functions.fixed import UUID_COLUMNS, VALID_UUID
from uidloom.functions.frames import present, stamp
from uidloom.operators import coverage
from uidloom.operators.resolve import mapped_users, users_after, write_back
from uidloom.operators.skew import HotKeys
from uidloom.operators.valid_uuid import choices, set_valid_uuid
from uidloom.sources.catalog import column_catalog, discover_tables, preview_counts
from uidloom.sources.session import materialize, scratch
from uidloom.sources.snapshots import (
    DESCRIPTORS,
    PARQUET,
    commit_tables,
    load_table,
    save_and_verify,
    save_snapshot,
    snapshot_path,
)
from uidloom.sources.tables import SchemaGroup, read_identifies, schema_groups, tracked_rows

RESOLVED = "resolved_rows"
COUNTS = "uuid_counts"


def resolve_valid(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
    chosen: DataFrame | None = None,
) -> DataFrame:
    """The rows with their four UUID columns and one valid id.

    On a fresh run all of it is decided on one row per user, and the wide rows are joined once. Rows that
    carry values of an earlier run may differ within a user, so there the choice is made on one row for each
    user and set of earlier values. Either way the wide rows are read once, and written nowhere in between.
    """
    users, hot = mapped_users(rows, masters, personas, watched, hot)
    if chosen is not None and hot["user_id"]:
        users = materialize(users, "user_map")
    if present(rows, UUID_COLUMNS):
        if chosen is None:
            users = materialize(users, "user_map")
            chosen = materialize(choices(users_after(rows, users, hot["user_id"]), "n_rows"), "choices")
        return set_valid_uuid(write_back(rows, users, hot["user_id"]), chosen)
    return write_back(rows, valid_users(users, chosen), hot["user_id"])


def valid_users(users: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """The user map with a valid id per user; written once, as it is read for the choice and for the result."""
    if chosen is None:
        users = materialize(users, "user_map")
        chosen = choices(users, "n_rows")
    return set_valid_uuid(users, chosen)


@dataclass(frozen=True)
class Run:
    """What a run saved: paths of the resolved rows and of the counts, and the counts themselves."""

    rows_path: str
    counts_path: str
    counts: DataFrame


def run(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    root: str,
    at: datetime,
) -> Run:
    """Resolve, write the rows as a new snapshot, and count what was written."""
    resolved = resolve_valid(rows, masters, personas, watched)
    rows_path = save_snapshot(resolved, root, RESOLVED, PARQUET, at, by=["metadata_table"])
    written = rows.sparkSession.read.schema(resolved.schema).parquet(rows_path)
    counts_path = save_snapshot(coverage.uuid_counts(written), root, COUNTS, PARQUET, at)
    return Run(rows_path, counts_path, rows.sparkSession.read.parquet(counts_path))


def discover(spark: SparkSession, catalog: str | DataFrame, root: str, at: datetime | None = None) -> DataFrame:
    """Find the tables to resolve in a database or a given column catalog, save their descriptors, return them."""
    listed = column_catalog(spark, catalog) if isinstance(catalog, str) else catalog
    return save_and_verify(discover_tables(listed), root, DESCRIPTORS, at)[1]


def preview(descriptors: DataFrame) -> DataFrame:
    """The counts a run would fill, all null; nothing is written."""
    return preview_counts(descriptors)


Locate = Callable[[str, str], str]


def located(descriptors: DataFrame, locate: Locate | None = None) -> list[tuple[str, str]]:
    """(metadata table, name to read) of all descriptors; the driver holds one pair of names per table.

    ``locate`` turns (segment table, metadata table) into the name; without it the descriptors must say it.
    """
    name = F.col("source_name") if locate is None else F.lit(None)
    found = descriptors.select("segment_table", "metadata_table", name).orderBy("metadata_table").collect()
    return [(metadata, source if locate is None else locate(segment, metadata)) for segment, metadata, source in found]


def read_discovered(
    spark: SparkSession, descriptors: DataFrame, locate: Locate | None = None, extra: Collection[str] = ()
) -> DataFrame:
    """The rows of all discovered tables, each tagged with its metadata table; see ``read_identifies``."""
    return read_identifies(spark, located(descriptors, locate), extra)


def resolve_table(
    table: DataFrame, metadata_table: str, users: DataFrame, hot_users: Collection[str]
) -> DataFrame:
    """One source table with all of its own columns, whatever they are, and the values of the user map."""
    tagged = table.withColumn("metadata_table", F.lit(metadata_table))
    mine = users.where(F.col("metadata_table") == metadata_table)
    return _written_back(tagged, mine, hot_users).drop("metadata_table")


def _written_back(rows: DataFrame, users: DataFrame, hot_users: Collection[str]) -> DataFrame:
    """``write_back`` for rows whose user id may be of any type, which it keeps."""
    kinds = {f.name: f.dataType for f in rows.schema.fields if f.name.lower() == "user_id"}
    as_text = rows.withColumns({name: F.col(f"`{name}`").cast("string") for name in kinds})
    written = write_back(as_text, users, hot_users)
    return written.withColumns({name: F.col(f"`{name}`").cast(kind) for name, kind in kinds.items()})


RESOLVED_AT = "resolved_at"


def resolve_group(
    group: SchemaGroup, users: DataFrame, hot_users: Collection[str], chosen: DataFrame, at: datetime
) -> DataFrame:
    """The tables of one schema with all of their own columns, the values of the user map, the valid id, and the time."""
    return stamp(set_valid_uuid(_written_back(group.rows, users, hot_users), chosen), RESOLVED_AT, at)


WRITERS = 4
"""Groups that are written at a time; each is a job of its own, and the cluster shares its cores among them."""


def _write_group(rows: DataFrame, path: str, n_tables: int) -> int:
    """Write the tables of a group below a folder of their own, and return the number of rows.

    Jobs that write at the same time must not share a folder, as each clears its temporary files there.
    Where a group has several tables its rows are gathered by table, so that a task does not open a file of each;
    adaptive execution splits the large ones and joins the small ones.
    """
    written = Observation(f"rows_{uuid.uuid4().hex}")
    rows = rows.hint("rebalance", "metadata_table") if n_tables > 1 else rows
    rows.observe(written, F.count(F.lit(1)).alias("rows")).write.partitionBy("metadata_table").parquet(path)
    return written.get["rows"]


def run_tables(
    spark: SparkSession,
    descriptors: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    root: str,
    at: datetime,
    locate: Locate | None = None,
) -> Run:
    """Resolve all discovered tables and save each with all of its columns and its earlier values.

    Rows carry the time of the run as ``resolved_at``. Users and choices come from the narrow columns of all tables at once. Then tables of one schema are read by one
    scan, joined once and written together, ``WRITERS`` schemas at a time. The snapshot becomes visible as a whole:
    the manifest and the success marker come last, after the rows written are compared with the counts. A table
    without rows has its schema in the manifest. The counts come from the narrow columns and the descriptors.
    """
    groups = schema_groups(spark, located(descriptors, locate))
    narrow = tracked_rows(groups, UUID_COLUMNS)
    rows_path = snapshot_path(root, RESOLVED, PARQUET, at)
    with scratch(spark, "run") as folder:
        users, hot = mapped_users(narrow, masters, personas, watched)
        users = materialize(users, "user_map", folder)
        after = materialize(users_after(narrow, users, hot["user_id"]), "users_after", folder)
        chosen = materialize(choices(after, "n_rows"), "choices", folder)
        resolved = [resolve_group(group, users, hot["user_id"], chosen, at) for group in groups]
        with ThreadPoolExecutor(WRITERS) as writers:
            parts = [f"{rows_path}/part={k}" for k in range(len(groups))]
            jobs = [writers.submit(_write_group, rows, part, len(g.tables)) for g, rows, part in zip(groups, resolved, parts)]
            written = [job.result() for job in jobs]
        counts = coverage.for_tables(coverage.uuid_counts(after, "n_rows"), descriptors)
        counts_path = save_snapshot(counts, root, COUNTS, PARQUET, at)
    saved = spark.read.parquet(counts_path)
    totals = {r["metadata_table"]: r["total"] or 0 for r in saved.select("metadata_table", "total").collect()}
    for group, n in zip(groups, written):
        if n != sum(totals[key] for key, _ in group.tables):
            raise RuntimeError(f"{n} rows written of {[key for key, _ in group.tables]}, other than counted")
    commit_tables(spark, rows_path, [
        (key, StructType([f for f in rows.schema.fields if f.name != "metadata_table"]), part, totals[key])
        for group, rows, part in zip(groups, resolved, parts)
        for key, _ in group.tables
    ])
    return Run(rows_path, counts_path, saved)


def resolved_table(spark: SparkSession, run: Run, metadata_table: str) -> DataFrame:
    """What a run over tables saved of one of them."""
    return load_table(spark, run.rows_path, metadata_table)


def unresolved(resolved: DataFrame) -> DataFrame:
    """Per table: total rows, rows with a valid id, and rows without."""
    counts = resolved.groupBy("metadata_table").agg(
        F.count(F.lit(1)).alias("total"), F.count(VALID_UUID).alias("resolved")
    )
    return counts.withColumn("unresolved", F.col("total") - F.col("resolved"))
