"""Every named query against DuckDB on the whole sf0.01 tables."""

import datetime
import math
import os

import duckdb
import pytest

from clicktrail.plans import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.9g}" if math.isfinite(value) else str(value))
    if isinstance(value, datetime.datetime):
        return (1, value.replace(tzinfo=None).isoformat())
    return (1, f"{type(value).__name__}:{value}")


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = rows_by_name(result.columns, result.collect())
    want = rows_by_name(columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want

