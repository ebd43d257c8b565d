"""Identity-resolution inputs derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CATALOG_COLUMNS = [
    ("ID", 0), ("ANONYMOUS_ID", 10), ("USER_ID", 20), ("EMAIL", 31), ("RECEIVED_AT", 2),
    ("SENT_AT", 3), ("TIMESTAMP", 4), ("RID", 6), ("CONTEXT_IP", 7),
]


SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table; a known schema saves the job that would read it from a file."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def identifies(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    other = (user % 6 == 0) | (user % 10 == 3) | ((user % 6 == 2) & (event % 13 == 0))
    email_user = F.when(other, user + 1).otherwise(user)
    email = F.concat(F.lit("Customer#"), F.lpad(_text(email_user), 9, "0"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("SEGMENT__"), F.upper("event_type"), F.lit("_APP__IDENTIFIES")).alias("metadata_table"),
        _text(event).alias("id"),
        F.concat(F.lit("anon-"), _text(event % 997)).alias("anonymous_id"),
        F.when(event % 11 != 0, _text(user)).alias("user_id"),
        F.when(~((event % 7 == 0) | (user % 8 == 5)), email).alias("email"),
        F.when(~((F.col("event_type") == "error") | (event % 5 == 0)), _text(event)).alias("rid"),
        F.col("ts").alias("received_at"),
        (F.col("ts") - F.expr("INTERVAL '2' SECOND")).alias("sent_at"),
    )


def masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 3)
    return customer.select(_text(F.col("c_custkey")).alias("uuid"), F.col("c_name").alias("username"))


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0)
    return customer.select(_text(F.col("c_custkey")).alias("id"))


def watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    first = events.where(event % 3 != 0).select(
        _text(event).alias("rid"), _text(F.when(user % 4 == 0, user + 1).otherwise(user)).alias("user_id")
    )
    second = events.where(event % 18 == 1).select(_text(event).alias("rid"), _text(user).alias("user_id"))
    return first.unionByName(second)


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("ord")) for c, n in CATALOG_COLUMNS])
    region, name = F.col("n_regionkey"), F.upper("n_name")
    table_name = (
        F.when(region == 0, F.concat(F.lit("SEGMENT__"), name, F.lit("_DEV__IDENTIFIES")))
        .when(region == 1, F.concat(F.lit("IDENTIFIES_"), name))
        .when(region == 2, F.concat(F.lit("SEGMENT__"), name, F.lit("__TRACKS")))
        .otherwise(F.concat(F.lit("SEGMENT__"), name, F.lit("_PROD__IDENTIFIES")))
    )
    listed = table(spark, sf_dir, "nation").select("n_nationkey", table_name.alias("table_name"), F.inline(entries))
    return listed.where((F.col("n_nationkey") + F.col("ord")) % 5 != 0).select(
        "table_name", "column_name", F.lit("TEXT").alias("data_type")
    )


def identity_inputs(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows, masters, personas and watch log."""
    return (
        identifies(spark, sf_dir),
        masters(spark, sf_dir),
        personas(spark, sf_dir),
        watched(spark, sf_dir),
    )
