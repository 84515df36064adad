from __future__ import annotations

from collections import Counter

import pytest

from stockledger.llm.sharding import _number, fill_table, place

from .edge import ROWS, empty, frame


def by_definition(shards, m):
    """Every shard's whole preference list, turns taken one by one."""
    prefer = {s: [(_number(f"offset:{s}") % m + j * (_number(f"step:{s}") % (m - 1) + 1)) % m for j in range(m)] for s in shards}
    table: dict[int, str] = {}
    while len(table) < m:
        for s in shards:
            if len(table) < m:
                table[next(x for x in prefer[s] if x not in table)] = s
    return [table[i] for i in range(m)]


@pytest.mark.parametrize("n, m", [(1, 7), (3, 13), (7, 101), (13, 13)])
def test_table_matches_the_definition(n, m):
    shards = [f"s{i}" for i in range(n)]
    assert [shards[o] for o in fill_table(shards, m)] == by_definition(shards, m)


def test_loads_are_even_and_follow_weights():
    loads = Counter(fill_table([f"s{i}" for i in range(10)], 10_007))
    assert max(loads.values()) - min(loads.values()) <= 1
    loads = Counter(fill_table(["a", "b", "c"], 10_007, [1, 2, 0]))
    assert 2 not in loads and abs(loads[1] - 2 * loads[0]) <= 3


def test_a_lost_shard_moves_few_other_keys():
    shards = [f"s{i}" for i in range(10)]
    a = [shards[o] for o in fill_table(shards, 10_007)]
    b = [shards[:9][o] for o in fill_table(shards[:9], 10_007)]
    assert sum(x != y for x, y in zip(a, b) if x != "s9") < 0.2 * len(a)


@pytest.mark.parametrize("bad", [dict(shards=[]), dict(shards=["a", "a"]), dict(shards=["a"], table_size=12), dict(shards=["a", "b", "c"], table_size=2), dict(shards=["a"], table_size=7, weights=[0])])
def test_bad_parameters_are_refused(bad):
    with pytest.raises(ValueError):
        fill_table(**bad)


def test_placement_of_odd_rows(spark):
    shards = ["a", "b", "c"]
    out = place(frame(spark), "doc_id", shards, 101).collect()
    table = fill_table(shards, 101)
    assert len(out) == len(ROWS)
    for r in out:
        assert r.slot == _number("" if r.doc_id is None else str(r.doc_id)) % 101 and r.shard == shards[table[r.slot]]
        assert r.n == r.key == "mine"
    assert place(empty(spark), "doc_id", shards, 101).count() == 0
    clash = spark.createDataFrame([("k",)], "slot string")
    assert place(clash, "slot", shards, 101, slot_col="s").columns == ["slot", "s", "shard"]
