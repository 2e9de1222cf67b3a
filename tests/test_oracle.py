"""Every registered query against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from tests.conftest import SMALL

QUERIES, STATEMENTS = registered.product_queries(), registered.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    return con


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    return sorted(rows, key=lambda row: [(x is not None, str(x)) for x in row])


@pytest.mark.parametrize("name", QUERIES)
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(STATEMENTS[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = comparable(df.collect(), df.columns), comparable(result.fetchall(), columns)
    assert got == want
    assert got


def test_entry(spark):
    assert registered.entry(spark).count() > 0
