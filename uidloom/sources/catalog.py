"""The column catalog: scan it, find the tables to resolve, look into single tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from uidloom.functions.fixed import (
    IGNORED_NAME_PARTS,
    KEY_COLUMNS,
    RID_COLUMN,
    TABLE_NAME_PARTS,
    TRACKED_COLUMNS,
    UUID_COLUMNS,
)
from uidloom.functions.frames import has_column
from uidloom.functions.names import contains_any, contains_none, decode_table, encode_table, query_name_of
from uidloom.functions.values import append_column, join_columns
from uidloom.operators.coverage import COMBOS, combo_name

CATALOG_SCHEMA = "table_name string, column_name string, data_type string, is_nullable string, source_name string"
SOURCE = "source_name"
SESSION_CATALOG = "spark_catalog"


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass(frozen=True)
class CatalogTable:
    """What the session catalog knows of a table or view."""

    name: str
    is_view: bool
    provider: str | None
    location: str | None
    schema: StructType
    is_split: bool  # partitioned or bucketed
    is_padded: bool  # has texts of fixed length, which Spark fills up when it reads the table by its name


def _as_read(kind):
    """A type in JSON form as readers see it: texts with a length are strings to them."""
    if isinstance(kind, str):
        return "string" if re.fullmatch(r"(var)?char\(\d+\)", kind) else kind
    parts = {key: _as_read(kind[key]) for key in ("type", "elementType", "keyType", "valueType") if key in kind}
    fields = {"fields": [_as_read(field) for field in kind["fields"]]} if "fields" in kind else {}
    return kind | parts | fields


def _catalog_table(found) -> CatalogTable:
    storage, provider = found.storage().locationUri(), found.provider()
    schema = json.loads(found.schema().json())
    read = _as_read(schema)
    return CatalogTable(
        found.identifier().table(),
        found.tableType().name() == "VIEW",
        provider.get().lower() if provider.isDefined() else None,
        storage.get().toString() if storage.isDefined() else None,
        StructType.fromJson(read),
        found.partitionColumnNames().nonEmpty() or found.bucketSpec().isDefined(),
        re.search(r'"char\(\d+\)"', json.dumps(schema)) is not None,
    )


def _each(sequence) -> Iterator:
    items = sequence.iterator()
    while items.hasNext():
        yield items.next()


def tables_of(spark: SparkSession, names: Iterable[str]) -> dict[str, CatalogTable]:
    """The session catalog's entries of tables given by their quoted names; one call to the metastore per database.

    Names that are not tables or views of the session catalog are left out.
    """
    state, wanted = spark._jsparkSession.sessionState(), {}
    for name in names:
        try:
            at = state.catalog().qualifyIdentifier(state.sqlParser().parseTableIdentifier(name))
        except Py4JJavaError:  # a name of another catalog has more parts
            continue
        wanted[(at.database().get().lower(), at.table().lower())] = (name, at)
    by_database: dict[str, list] = {}
    for (database, _), (_, at) in wanted.items():
        by_database.setdefault(database, []).append(at)
    found = {}
    for database, identifiers in by_database.items():
        for entry in _each(state.catalog().getTablesByName(_scala_list(spark, identifiers))):
            name, _ = wanted[(database, entry.identifier().table().lower())]
            found[name] = _catalog_table(entry)
    return found


def _scala_list(spark: SparkSession, items: list):
    return spark._jvm.org.apache.spark.api.python.PythonUtils.toSeq(items)


def _listed(spark: SparkSession, database: str) -> list[CatalogTable]:
    """All tables and views of a database of the session catalog: one listing, and one call for all entries."""
    catalog = spark._jsparkSession.sessionState().catalog()
    names = catalog.listTables(database, "*", False)
    return [_catalog_table(entry) for entry in _each(catalog.getTablesByName(names))]


def _columns_one_by_one(spark: SparkSession, database: str) -> list[tuple]:
    """For catalogs that have no call for several tables."""
    return [
        (table.name.upper(), column.name.upper(), column.dataType, "YES" if column.nullable else "NO", name)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
        for name in [quoted(database, table.name)]
        for column in spark.catalog.listColumns(name)
    ]


def column_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """One row per column of each table and view of a database; temporary views of the session are left out.

    A Spark catalog may lower the case of names, and the rules on names are written for upper case. So names
    are turned to upper case here, and ``source_name`` is the quoted name to read. Only the metastore is
    asked, for all tables of the database at once: the driver holds names and types, and no data is read.
    """
    database = database or spark.catalog.currentDatabase()
    if spark.catalog.currentCatalog() != SESSION_CATALOG:
        return spark.createDataFrame(_columns_one_by_one(spark, database), CATALOG_SCHEMA)
    found = [
        (
            table.name.upper(),
            field.name.upper(),
            field.dataType.simpleString(),
            "YES" if field.nullable else "NO",
            quoted(database, table.name),
        )
        for table in _listed(spark, database)
        for field in table.schema.fields
    ]
    return spark.createDataFrame(found, CATALOG_SCHEMA)


def table_columns(catalog: DataFrame, segment_table: str) -> DataFrame:
    """The distinct column names of one table."""
    name = encode_table(F.lit(segment_table))
    return catalog.where(F.col("table_name") == name).select("column_name").distinct()


def with_segment_table(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("segment_table", decode_table(F.col("table_name")))


def wanted_tables(catalog: DataFrame) -> DataFrame:
    """Catalog rows of tables whose name has a wanted part and no ignored one."""
    name = F.col("segment_table")
    return with_segment_table(catalog).where(
        contains_any(name, TABLE_NAME_PARTS) & contains_none(name, IGNORED_NAME_PARTS)
    )


def tracked_columns(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("column_name").isin(*TRACKED_COLUMNS))


def discover_tables(catalog: DataFrame) -> DataFrame:
    """Descriptors of the wanted tables that have all key columns.

    ``columns`` lists the tracked columns of the table, sorted; at most eight per table, so the set built
    per group is bounded. A catalog that says which name to read passes it on as ``source_name``.
    """
    source = [F.min(SOURCE).alias(SOURCE)] if has_column(catalog, SOURCE) else []
    sets = (
        tracked_columns(wanted_tables(catalog))
        .groupBy("segment_table")
        .agg(F.array_sort(F.collect_set("column_name")).alias("columns"), *source)
    )
    required = F.array(*[F.lit(c) for c in KEY_COLUMNS])
    return sets.where(F.size(F.array_except(required, "columns")) == 0).select(
        "segment_table",
        encode_table(F.col("segment_table")).alias("metadata_table"),
        "columns",
        *([SOURCE] if source else []),
    )


def dashed(descriptors: DataFrame) -> DataFrame:
    """Descriptors with the column list as text, ``a-b-c``."""
    return descriptors.withColumn("columns", join_columns(F.col("columns")))


def descriptor_of(descriptors: DataFrame, segment_table: str) -> DataFrame:
    return descriptors.where(F.col("segment_table") == segment_table)


def planned_paths(descriptors: DataFrame) -> DataFrame:
    """One row per table and path that will run: the query name, the new column, and the columns after it.

    The rid path runs only where the table has a rid.
    """
    paths = F.explode(F.array(*[F.lit(c) for c in UUID_COLUMNS])).alias("new_uuid")
    planned = descriptors.select("metadata_table", "columns", paths).where(
        (F.col("new_uuid") != UUID_COLUMNS[-1]) | F.array_contains("columns", RID_COLUMN)
    )
    return planned.select(
        "metadata_table",
        query_name_of(F.col("new_uuid")).alias("name"),
        "new_uuid",
        append_column(F.col("columns"), F.upper("new_uuid")).alias("columns"),
    )


def preview_counts(descriptors: DataFrame) -> DataFrame:
    """What a preview reports per table: the counts that a run would fill, all null."""
    empty = [F.lit(None).cast("long").alias(c) for c in ("total", *UUID_COLUMNS)]
    return descriptors.select("metadata_table", *empty)


def preview_combos(descriptors: DataFrame) -> DataFrame:
    """The combinations a preview lists: by the columns a table will have, with null counts."""
    entries = [
        F.when(
            F.lit(UUID_COLUMNS[-1] not in combo) | F.array_contains("columns", RID_COLUMN),
            F.lit(combo_name(combo)),
        )
        for combo in COMBOS
    ]
    return descriptors.select(
        "metadata_table",
        F.explode(F.array_compact(F.array(*entries))).alias("combo"),
        F.lit(None).cast("long").alias("n"),
    )
