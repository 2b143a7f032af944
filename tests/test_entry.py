"""What the entry module lists when the optional parts can't be imported."""

import sys

import pytest

import __spark_entry__ as contract
from clicktrail.plans import catalog, oracle


@pytest.mark.parametrize("missing", ["zstandard", "clicktrail.llm", "corpus_pipeline"])
def test_plain_queries_stay_without_the_optional_parts(monkeypatch, missing, capsys):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.split(".")[:2] == ["clicktrail", "llm"]]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # an import of it fails
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(catalog.queries()) <= set(queries) and set(oracle.oracle_sql()) <= set(sql)
    assert "pipeline" not in queries
    assert "without corpus_pipeline" in capsys.readouterr().err


def test_every_query_is_a_function(spark):
    assert all(map(callable, contract.queries().values()))
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["user_id", "session_id"]
