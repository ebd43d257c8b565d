from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload import oracle
from workload.queries import QUERIES as OWN

SMALL = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
OWN_SQL = oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert set(OWN) == set(OWN_SQL)


def test_all_own_queries_are_registered_and_sql_belongs_to_queries():
    assert set(OWN) <= set(QUERIES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_gives_the_rows_of_its_sql(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(map(tuple, df.collect()), df.columns) == canonical(result.fetchall(), columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1000
