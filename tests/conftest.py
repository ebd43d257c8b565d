from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

from uidloom.sources.session import configure

ROWS = "metadata_table string, id string, anonymous_id string, user_id string, email string, rid string"
MASTERS = "uuid string, username string"
PERSONAS = "id string"
WATCHED = "rid string, user_id string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
    )
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def database(spark, tmp_path):
    """A new database in its own folder."""
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    return name


@pytest.fixture(scope="session")
def inputs(spark):
    """Builds rows, masters, personas and watch log from short tuples."""

    def build(rows=(), masters=(), personas=(), watched=()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        full = [(t, str(i), f"a{i}", user, email, rid) for i, (t, user, email, rid) in enumerate(rows)]
        return (
            spark.createDataFrame(full, ROWS),
            spark.createDataFrame(list(masters), MASTERS),
            spark.createDataFrame([(p,) for p in personas], PERSONAS),
            spark.createDataFrame(list(watched), WATCHED),
        )

    return build
