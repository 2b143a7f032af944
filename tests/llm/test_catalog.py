"""Queries with SQL against DuckDB on the whole sf0.01 tables, and the registration."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from clicktrail.llm import catalog
from tests.llm.helpers import SF_DIR, by_id


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    expected = duck.execute(catalog.oracle_sql()[name])
    columns = sorted(column[0] for column in expected.description)
    found = catalog.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    order = [[column[0] for column in expected.description].index(name) for name in columns]
    rows = [tuple(row[k] for k in order) for row in expected.fetchall()]
    assert by_id(found.select(*columns).collect()) == by_id(rows)


def test_every_operator_is_registered():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert set(catalog.oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())
