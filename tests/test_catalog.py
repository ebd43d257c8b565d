from __future__ import annotations

from uidloom.sources import catalog

SCHEMA = "table_name string, column_name string, data_type string"
KEYS = ["ID", "ANONYMOUS_ID", "USER_ID", "EMAIL"]


def columns_of(spark, tables):
    rows = [(table, column, "TEXT") for table, columns in tables.items() for column in columns]
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return {r.segment_table: (r.metadata_table, r.columns) for r in df.collect()}


def test_discovery_keeps_tables_that_have_all_keys(spark):
    cat = columns_of(
        spark,
        {
            "SEGMENT__WEB__IDENTIFIES": [*KEYS, "RID", "SENT_AT", "CONTEXT_IP", "ID"],
            "SEGMENT__APP__IDENTIFIES": ["ID", "USER_ID", "EMAIL", "RID"],
            "SEGMENT__WEB__TRACKS": KEYS,
            "IDENTIFIES": KEYS,
        },
    )
    assert found(catalog.discover_tables(cat)) == {
        "SEGMENT.WEB.IDENTIFIES": (
            "SEGMENT__WEB__IDENTIFIES", ["ANONYMOUS_ID", "EMAIL", "ID", "RID", "SENT_AT", "USER_ID"],
        ),
        "LOOKER_SOURCE.PUBLIC.IDENTIFIES": ("IDENTIFIES", sorted(KEYS)),
    }


def test_discovery_matches_names_by_substring_and_case(spark):
    cat = columns_of(
        spark,
        {
            "SEGMENT__DEVICE__IDENTIFIES": KEYS,
            "SEGMENT__APP_STAGING__IDENTIFIES": KEYS,
            "IDENTIFIES_METADATA__X__IDENTIFIES": KEYS,
            "SEGMENT__A__IDENTIFIES_OLD": KEYS,
            "segment__a__identifies": KEYS,
        },
    )
    assert set(found(catalog.discover_tables(cat))) == {"SEGMENT.A.IDENTIFIES_OLD"}


def test_equal_names_of_two_schemas_merge(spark):
    cat = columns_of(spark, {"A__IDENTIFIES": KEYS[:2]}).union(columns_of(spark, {"A__IDENTIFIES": KEYS[2:]}))
    assert found(catalog.discover_tables(cat)) == {"A.IDENTIFIES": ("A__IDENTIFIES", sorted(KEYS))}


def test_dashed_columns_and_lookup(spark):
    descriptors = catalog.dashed(catalog.discover_tables(columns_of(spark, {"A__IDENTIFIES": KEYS})))
    assert descriptors.first().columns == "ANONYMOUS_ID-EMAIL-ID-USER_ID"
    assert catalog.descriptor_of(descriptors, "A.IDENTIFIES").count() == 1
    assert catalog.descriptor_of(descriptors, "B.IDENTIFIES").isEmpty()


def test_columns_of_one_table(spark):
    cat = columns_of(spark, {"A__IDENTIFIES": ["ID", "ID", "X"], "IDENTIFIES": ["Y"]})
    assert {r[0] for r in catalog.table_columns(cat, "A.IDENTIFIES").collect()} == {"ID", "X"}
    assert {r[0] for r in catalog.table_columns(cat, "LOOKER_SOURCE.PUBLIC.IDENTIFIES").collect()} == {"Y"}


def test_plan_runs_the_rid_path_only_with_a_rid(spark):
    descriptors = catalog.discover_tables(columns_of(spark, {"A__IDENTIFIES": KEYS, "B__IDENTIFIES": [*KEYS, "RID"]}))
    planned = {(r.metadata_table, r.name): r for r in catalog.planned_paths(descriptors).collect()}
    assert {name for table, name in planned if table == "A__IDENTIFIES"} == {"user_id_query", "username_query", "persona_query"}
    last = planned["B__IDENTIFIES", "rid_query"]
    assert last.new_uuid == "rid_uuid" and last.columns == [*sorted([*KEYS, "RID"]), "RID_UUID"]


def test_preview_has_null_counts_only(spark):
    descriptors = catalog.discover_tables(columns_of(spark, {"A__IDENTIFIES": KEYS, "B__IDENTIFIES": [*KEYS, "RID"]}))
    counts = catalog.preview_counts(descriptors).collect()
    assert {tuple(r)[1:] for r in counts} == {(None,) * 5} and len(counts) == 2
    combos = catalog.preview_combos(descriptors).collect()
    assert sum(r.metadata_table == "A__IDENTIFIES" for r in combos) == 4
    assert sum(r.metadata_table == "B__IDENTIFIES" for r in combos) == 11
    assert {r.n for r in combos} == {None}


def test_scan_of_a_real_catalog(spark, database):
    spark.sql(f"CREATE TABLE {database}.A__IDENTIFIES (ID string, USER_ID string) USING parquet")
    rows = [tuple(r) for r in catalog.column_catalog(spark, database).where("table_name ILIKE 'a__identifies'").collect()]
    assert sorted((c.lower(), t, n) for _, c, t, n, _ in rows) == [("id", "string", "YES"), ("user_id", "string", "YES")]
