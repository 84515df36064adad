"""The registered queries over the test tables: against SQL where it can say them, else by their contracts."""

from __future__ import annotations

import pytest

from stockledger.checks.compare import compare, duckdb_connection
from stockledger.llm.common import read
from stockledger.llm.queries import oracle_sql, registry

from .test_packing import check, tokenizer  # noqa: F401


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    r = compare(name, registry()[name](spark, sf_dir), oracle_sql()[name], duckdb_connection(sf_dir))
    assert r.columns_match and r.spark_rows == r.oracle_rows and r.hash_match, r.detail


def test_packing_of_all_documents(spark, sf_dir, tokenizer):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    check(rows, registry()["op8_packing"](spark, sf_dir).collect(), tokenizer, 2048)


def test_no_long_passage_stays_in_two_documents(spark, sf_dir):
    out = registry()["op3_substring_dedup"](spark, sf_dir).collect()
    seen: dict[tuple, int] = {}
    for r in out:
        w = (r.text or "").lower().split()
        for i in range(len(w) - 50):
            g = tuple(w[i : i + 51])
            assert seen.setdefault(g, r.doc_id) == r.doc_id
    assert len(out) == read(spark, sf_dir, "documents").count() and any(r.n_removed for r in out)
