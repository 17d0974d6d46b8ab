"""Every registered query against its SQL in a second engine, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallyloom.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.QUERIES
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def second():
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, second, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    expected = second.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    wanted = [tuple(row[i] for i in order) for row in expected.fetchall()]
    got = [tuple(row) for row in df.select(*columns).collect()]
    assert got, "a query without rows checks nothing"
    assert _sorted(got) == _sorted(wanted)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
