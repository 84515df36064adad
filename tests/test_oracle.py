"""Every registered query against its DuckDB oracle (rows, columns, types, values)."""

from __future__ import annotations

import pytest

from stockledger.checks import oracle
from stockledger.checks.compare import compare, duckdb_connection
from stockledger.plans.queries import registry

NAMES = sorted(registry())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = registry()[name](spark, sf_dir)
    r = compare(name, df, oracle.queries()[name], con)
    assert r.columns_match, r.detail
    assert "type differences" not in r.detail, r.detail
    assert r.spark_rows == r.oracle_rows, r.detail
    assert r.hash_match, r.detail


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())
