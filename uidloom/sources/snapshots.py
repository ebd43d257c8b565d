"""Versioned snapshots: ``<root>/<base name>/run_ts=<UTC time>.<format>``.

A run never overwrites another one, so a table can be read while its next version is written. Only
complete runs, those with a success marker, can be the latest one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from uidloom.functions.frames import has_column, hashable

CSV = "csv"
PARQUET = "parquet"
RUN_PREFIX = "run_ts="
# Null is an empty cell, empty text a quoted one; all other text is kept as it is.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# What the reader makes of an empty cell before it becomes null; any other mark than "" keeps empty text.
EMPTY_CELL = "\u0000"
# Characters that never stand in a cell, so that each line is a row and the mark above is no text: each is written
# as a backslash and a letter. The backslash itself is one of them, and is written first and read last.
CODES = {"\\": "\\s", "\n": "\\n", "\r": "\\r", "\0": "\\z"}
MANIFEST = "_manifest"
INDEX_COLUMN = "ID"
DESCRIPTORS = "segment_tables"


def _stamp(at: datetime) -> str:
    return at.astimezone(UTC).strftime("%Y%m%dT%H%M%S%fZ")


def _texts(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]


def _coded(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Text columns with each first part of a pair replaced by the second, pair by pair."""
    cells = {c: F.col(f"`{c}`") for c in _texts(df)}
    for old, new in pairs:
        cells = {c: F.replace(v, F.lit(old), F.lit(new)) for c, v in cells.items()}
    return df.withColumns(cells)


def encoded_cells(df: DataFrame) -> DataFrame:
    return _coded(df, CODES.items())


def decoded_cells(df: DataFrame) -> DataFrame:
    return _coded(df, [(code, character) for character, code in reversed(CODES.items())])


def snapshot_path(root: str, base: str, file_format: str = CSV, at: datetime | None = None) -> str:
    if file_format not in (CSV, PARQUET):
        raise ValueError(f"unknown snapshot format: {file_format}")
    return f"{root}/{base}/{RUN_PREFIX}{_stamp(at or datetime.now(UTC))}.{file_format}"


def save_snapshot(
    df: DataFrame,
    root: str,
    base: str,
    file_format: str = CSV,
    at: datetime | None = None,
    by: Sequence[str] = (),
) -> str:
    """Write a new snapshot and return its path; in CSV a column named ID comes first.

    A Parquet snapshot may be partitioned ``by`` columns, so that readers of some values skip the others.
    """
    path = snapshot_path(root, base, file_format, at)
    if file_format == PARQUET:
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
    else:
        if has_column(df, INDEX_COLUMN):
            df = df.select(INDEX_COLUMN, *[c for c in df.columns if c.upper() != INDEX_COLUMN])
        encoded_cells(df).write.options(**CSV_OPTIONS).csv(path)
    return path


def load_snapshot(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read a snapshot by the format in its name; CSV needs a schema, as it carries no types.

    Each line of a CSV file is a row, so large files are split over tasks. A snapshot of many tables is read by its
    manifest, see ``load_tables``.
    """
    if path.endswith(f".{PARQUET}"):
        if schema is None and _exists(spark, f"{path}/{MANIFEST}"):
            return load_tables(spark, path)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if path.endswith(f".{CSV}"):
        if schema is None:
            raise ValueError("a CSV snapshot is read with an explicit schema")
        reader = spark.read.schema(schema).options(**CSV_OPTIONS, enforceSchema=False)
        return decoded_cells(reader.option("nullValue", EMPTY_CELL).csv(path))
    raise ValueError(f"unknown snapshot format: {path}")


def latest_snapshot(spark: SparkSession, root: str, base: str) -> str | None:
    """The path of the newest complete snapshot; lists folder names only, no data."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{base}")
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return None
    runs = [
        status.getPath()
        for status in files.listStatus(folder)
        if status.isDirectory() and status.getPath().getName().startswith(RUN_PREFIX)
    ]
    for run in sorted(runs, key=lambda path: path.getName(), reverse=True):
        if files.exists(jvm.org.apache.hadoop.fs.Path(run, "_SUCCESS")):
            return run.toString()
    return None


def _files(spark: SparkSession, path: str):
    """A path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, path: str) -> bool:
    at, files = _files(spark, path)
    return files.exists(at)


def table_folder(spark: SparkSession, path: str, metadata_table: str) -> str:
    """Where a snapshot of many tables keeps one of them; names are escaped as Spark does."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/metadata_table={escape(metadata_table)}"


MANIFEST_SCHEMA = "metadata_table string, schema string, folder string, n_rows bigint"


@dataclass(frozen=True)
class SavedTable:
    """A table of a snapshot of many: its columns, the folder that its part of the snapshot is in, and its rows."""

    schema: StructType
    folder: str
    n_rows: int


def commit_tables(spark: SparkSession, path: str, tables: Iterable[tuple[str, StructType, str, int]]) -> None:
    """Make a snapshot of many tables complete: first the manifest (table, schema, folder, rows), then the marker.

    Folders lie below the snapshot, and are kept relative to it.
    Up to the marker readers do not see the snapshot, so a run that breaks between two tables leaves nothing behind
    that could be taken for a result.
    """
    rows = [(name, schema.json(), folder.removeprefix(f"{path}/"), n) for name, schema, folder, n in tables]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.parquet(f"{path}/{MANIFEST}")
    at, files = _files(spark, f"{path}/_SUCCESS")
    files.create(at).close()


def manifest_of(spark: SparkSession, path: str) -> dict[str, SavedTable]:
    """What a snapshot of many tables holds; the driver gets one row per table."""
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}").collect()
    read = lambda r: SavedTable(StructType.fromJson(json.loads(r["schema"])), f"{path}/{r['folder']}", r["n_rows"])
    return {r["metadata_table"]: read(r) for r in rows}


def load_table(spark: SparkSession, path: str, metadata_table: str) -> DataFrame:
    """One table of a snapshot of many, with its own columns and types, also if it has no rows."""
    saved = manifest_of(spark, path)[metadata_table]
    if not saved.n_rows:
        return spark.createDataFrame([], saved.schema)
    return spark.read.schema(saved.schema).parquet(table_folder(spark, saved.folder, metadata_table))


def load_tables(spark: SparkSession, path: str) -> DataFrame:
    """All tables of a snapshot as one frame, with one scan per schema.

    A column has the type it has in all tables, or is text where they differ; what a table lacks is null.
    """
    groups: dict[tuple[str, str], tuple[StructType, list[str]]] = {}
    kinds: dict[str, set] = {}
    for name, saved in sorted(manifest_of(spark, path).items()):
        for field in saved.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
        if saved.n_rows:
            key = (saved.folder, saved.schema.json())
            groups.setdefault(key, (saved.schema, []))[1].append(table_folder(spark, saved.folder, name))
    types = {name: min(found, key=str) if len(found) == 1 else StringType() for name, found in kinds.items()}
    types = {"metadata_table": StringType()} | types
    whole = StructType([StructField(name, kind) for name, kind in types.items()])
    parts = [spark.createDataFrame([], whole)] if not groups else []
    for (folder, _), (schema, folders) in groups.items():
        keyed = StructType([*schema.fields, StructField("metadata_table", StringType())])
        rows = spark.read.schema(keyed).option("basePath", folder).parquet(*folders)
        own = set(rows.columns)
        parts.append(rows.select(*[(F.col(f"`{n}`") if n in own else F.lit(None)).cast(k).alias(n) for n, k in types.items()]))
    return reduce(DataFrame.unionByName, parts)


def load_latest(
    spark: SparkSession, root: str, base: str, schema: StructType | str | None = None
) -> tuple[str, DataFrame] | None:
    path = latest_snapshot(spark, root, base)
    return None if path is None else (path, load_snapshot(spark, path, schema))


def load_or_compute(
    spark: SparkSession, root: str, base: str, compute: Callable[[], DataFrame], use_latest: bool = True
) -> tuple[str, DataFrame]:
    """The latest snapshot if there is one with rows, else a new one."""
    found = load_latest(spark, root, base) if use_latest else None
    if found is not None and not found[1].isEmpty():
        return found
    path = save_snapshot(compute(), root, base, PARQUET)
    return path, load_snapshot(spark, path)


def save_and_verify(df: DataFrame, root: str, base: str, at: datetime | None = None) -> tuple[str, DataFrame]:
    """Save, load the latest snapshot again and compare both.

    What was written is observed while it is written, as a count and a sum of row hashes, so the frame is
    computed once.
    """
    sums = [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*hashable(df)).cast("decimal(38,0)")).alias("hashes")]
    written = Observation(f"saved_{uuid.uuid4().hex}")
    path = save_snapshot(df.observe(written, *sums), root, base, PARQUET, at)
    latest, loaded = load_latest(df.sparkSession, root, base)
    if latest.rsplit("/", 1)[-1] != path.rsplit("/", 1)[-1]:
        raise RuntimeError(f"latest snapshot is {latest}, not {path}")
    if loaded.agg(*sums).first().asDict() != written.get:
        raise RuntimeError(f"snapshot {path} differs from what was saved")
    return latest, loaded
