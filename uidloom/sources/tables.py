"""Catalog tables: list, describe, clone, add columns, read many as one frame."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from uidloom.functions.fixed import (
    KEY_COLUMNS,
    METADATA_SCHEMA,
    RID_COLUMN,
    TABLE_NAME_PARTS,
    TIMESTAMP_COLUMNS,
    TRACKED_COLUMNS,
    UUID_COLUMNS,
    VALID_UUID,
)
from uidloom.functions.frames import hashable
from uidloom.operators.sets import union_tables
from uidloom.sources.catalog import quoted, tables_of

FILE_FORMATS = ("parquet", "orc")
TYPES = {c.lower(): "string" for c in (*KEY_COLUMNS, RID_COLUMN, *UUID_COLUMNS, VALID_UUID)} | {
    c.lower(): "timestamp" for c in TIMESTAMP_COLUMNS
}


def metadata_name(metadata_table: str, schema: str = METADATA_SCHEMA) -> str:
    return f"{schema}.{metadata_table}"


def existing_metadata_tables(
    spark: SparkSession, schema: str = METADATA_SCHEMA, suffix: str = TABLE_NAME_PARTS[0]
) -> list[str]:
    """The tables of the metadata schema whose name ends in the suffix; catalogs may lower the case."""
    if not spark.catalog.databaseExists(schema):
        return []
    names = [table.name for table in spark.catalog.listTables(schema) if not table.isTemporary]
    return [name for name in names if name.upper().endswith(suffix.upper())]


def metadata_table_exists(spark: SparkSession, metadata_table: str, schema: str = METADATA_SCHEMA) -> bool:
    return spark.catalog.tableExists(metadata_name(metadata_table, schema))


def describe_table(spark: SparkSession, name: str) -> DataFrame | None:
    """One row per column (name, type, nullable); None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = [(c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean")


def table_column_names(spark: SparkSession, name: str) -> list[str] | None:
    return [c.name for c in spark.catalog.listColumns(name)] if spark.catalog.tableExists(name) else None


def content_sums(df: DataFrame) -> dict[str, Column]:
    """Expressions that tell two contents apart whatever the order of rows: their number, and a sum of hashes per column.

    A cell is hashed with the hash of its row, so cells that trade rows are seen as well.
    """
    row = F.xxhash64(*hashable(df))
    cells = {name: F.xxhash64(f"`{name}`", row) for name, kind in df.dtypes if f"`{name}`" in hashable(df)}
    return {"rows": F.count(F.lit(1))} | {f"c{k}": F.sum(h.cast("decimal(38,0)")) for k, h in enumerate(cells.values())}


def clone_table(spark: SparkSession, source: str, target: str, preview: bool = False) -> bool:
    """Copy a table unless the target exists; True only if it was created and holds what was read.

    The content is summed up while it is written, so the source is read once, and compared with the copy.
    """
    if preview or spark.catalog.tableExists(target):
        return False
    rows = spark.table(source)
    written = Observation(f"clone_{uuid.uuid4().hex}")
    rows.observe(written, *[c.alias(n) for n, c in content_sums(rows).items()]).write.format("parquet").saveAsTable(target)
    return matches_content(spark.table(target), written.get)


def matches_content(copy: DataFrame, expected: Mapping[str, object]) -> bool:
    found = copy.agg(*[c.alias(n) for n, c in content_sums(copy).items()]).first().asDict()
    return found == dict(expected)


def add_column_if_absent(
    spark: SparkSession, name: str, column: str, data_type: str = "string", default: str | None = None
) -> bool:
    """Add a nullable column to a table; False if the table has it already.

    ``default`` is an SQL expression without references to columns; rows written before get its value too.
    """
    if column.lower() in {c.lower() for c in table_column_names(spark, name) or []}:
        return False
    value = "" if default is None else f" DEFAULT {default}"
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({quoted(column)} {data_type}{value})")
    return True


@dataclass(frozen=True)
class SchemaGroup:
    """Tables that one scan can read: their schema, the rows with the table's key, and (key, name) of each."""

    schema: StructType
    rows: DataFrame
    tables: list[tuple[str, str]]


def _one_scan(spark: SparkSession, provider: str, schema: StructType, located: list[tuple[str, str]]) -> DataFrame:
    """All files of some tables as one source; the folder of a file tells its table.

    The names are one row per table, which the driver holds anyway, so they are broadcast.
    """
    rows = spark.read.format(provider).schema(schema).load([location for _, location in located])
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    names = spark.createDataFrame([(key, _folder_name(spark, location)) for key, location in located], "metadata_table string, _folder string")
    tagged = rows.select("*", F.regexp_replace(folder, "^file:/+", "file:/").alias("_folder"))
    return tagged.join(F.broadcast(names), "_folder").drop("_folder")


def _folder_name(spark: SparkSession, location: str) -> str:
    uri = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(location)).toUri().toString()
    return re.sub("^file:/+", "file:/", uri.rstrip("/"))


def schema_groups(spark: SparkSession, descriptors: Iterable[tuple[str, str]]) -> list[SchemaGroup]:
    """Tables of one schema and file format as one scan each; others, such as views, as scans of their own.

    Takes (metadata table, name to read) pairs. The rows carry all columns of the tables, and ``metadata_table``.
    """
    pairs = list(descriptors)
    known = tables_of(spark, [name for _, name in pairs])
    together: dict[tuple[str, str], list[tuple[str, str]]] = {}
    alone: list[tuple[str, str]] = []
    for key, name in pairs:
        entry = known.get(name)
        whole = entry and not entry.is_view and not entry.is_split and not entry.is_padded
        plain = whole and entry.provider in FILE_FORMATS and entry.location
        # A default of an added column stands in the catalog only; brackets and stars in a path are patterns.
        if plain and not any(f.metadata for f in entry.schema.fields) and not re.search(r"[\[\]{}*?\\]", entry.location):
            together.setdefault((entry.provider, entry.schema.json()), []).append((key, name))
        else:
            alone.append((key, name))
    groups = []
    for (provider, _), members in together.items():
        if len(members) == 1:
            alone += members
            continue
        schema = known[members[0][1]].schema
        located = [(key, known[name].location) for key, name in members]
        groups.append(SchemaGroup(schema, _one_scan(spark, provider, schema, located), members))
    for key, name in alone:
        rows = spark.table(name)
        groups.append(SchemaGroup(rows.schema, rows.withColumn("metadata_table", F.lit(key)), [(key, name)]))
    return groups


def read_identifies(
    spark: SparkSession, descriptors: Iterable[tuple[str, str]], extra: Iterable[str] = ()
) -> DataFrame:
    """All discovered tables as one frame of the tracked columns, and of ``extra`` columns as text.

    Takes (metadata table, name to read) pairs: one scan per schema in one plan, so later steps run once over
    all tables and not once per table. Keys are text in every table, so that tables that keep them as numbers
    meet those that do not.
    """
    return tracked_rows(schema_groups(spark, descriptors), extra)


def tracked_rows(groups: Iterable[SchemaGroup], extra: Iterable[str] = ()) -> DataFrame:
    """The tracked and ``extra`` columns of all groups, with the key of each table."""
    return union_tables({k: g.rows for k, g in enumerate(groups)}, [*TRACKED_COLUMNS, *extra], TYPES, keyed=True)
