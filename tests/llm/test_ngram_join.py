from __future__ import annotations

import random

import numpy as np
import pytest

from stockledger.llm import ngram_join as N
from stockledger.llm.common import Shared

from .edge import empty, frame


def brute(rows, percent=75, k=5):
    sets: dict[int, list[set]] = {}
    for d, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.setdefault(d, []).append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    ids = [d for d in sets if d is not None]
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return sets, {d: root(d) for d in ids}


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for _ in range(30):
        rows.append([rng.choice(words) for _ in range(rng.randint(1, 90))])
    base = [rng.choice(words) for _ in range(80)]
    for _ in range(25):  # near copies: edits scatter them around the threshold
        c = list(base)
        for _ in range(rng.randint(0, 5)):
            c[rng.randrange(len(c))] = rng.choice(words)
        rows.append(c)
    for _ in range(20):  # a chain: each a little further from the first
        base = base[rng.randint(1, 6) :] + [rng.choice(words) for _ in range(3)]
        rows.append(base)
    rows += [passage + [rng.choice(words) for _ in range(rng.randint(0, 30))] for _ in range(70)]  # a common passage
    rows += [rows[3], rows[40], [w.upper() for w in rows[40]]]
    rng.shuffle(rows)
    return [(1000 + 7 * i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = corpus(seed)
    sets, want = brute(rows)
    got = N.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "doc_id", "text", Shared(spark, "n")).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id][0]) for r in got)
    assert len(set(want.values())) < len(rows) - 40


def test_odd_rows(spark):
    df = frame(spark)
    out = N.join(df, "doc_id", "text", Shared(spark, "n")).collect()
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    _, want = brute(rows)
    assert len(out) == len(rows) and all(r.component_id == want.get(r.doc_id) for r in out)
    by = {r.doc_id: r for r in out}
    assert [by[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and [by[i].component_id for i in (1, 2, 3)] == [1, 2, 3]
    assert by[6].component_id == 5 and by[5].n_shingles == 1
    assert N.join(empty(spark), "doc_id", "text", Shared(spark, "n")).count() == 0


def test_bit_counts_bound_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n, m = rng.integers(1, 900, 2)
        c = int(rng.integers(0, min(n, m) + 1))
        base = rng.integers(0, 2**63, n + m, dtype=np.uint64)
        a, b = np.unique(base[:n]), np.unique(np.concatenate([base[:c], base[n : n + m - c]]))
        assert N.overlap_bound(N.bitmap(a), len(a), N.bitmap(b), len(b)) >= len(np.intersect1d(a, b))


def test_linked_sets_share_a_prefix_under_any_order():
    rng = np.random.default_rng(1)
    for _ in range(500):
        a = set(rng.permutation(60)[: rng.integers(1, 50)].tolist())
        b = set(a) - set(list(a)[: rng.integers(0, 8)]) | {100 + i for i in range(rng.integers(0, 8))}
        if b and 100 * len(a & b) >= 75 * len(a | b):
            order = rng.permutation(200)
            first = [set(sorted(s, key=lambda x: order[x])[: int(N.prefix_length(np.array([len(s)]), 75)[0])]) for s in (a, b)]
            assert first[0] & first[1]


def test_tiles_of_a_long_list_hold_two_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64))
    sets = {k: np.unique(np.concatenate([base, rng.integers(0, 2**63, 4 if k % 10 < 2 else 40, dtype=np.uint64)])) for k in range(200)}
    size = 16
    whole = N._compare

    def bounded(t, percent):
        assert t.num_rows <= 4 * size, t.num_rows
        return whole(t, percent)

    monkeypatch.setattr(N, "TILE_MEMBERS", size)
    monkeypatch.setattr(N, "_compare", bounded)
    spans = spark.createDataFrame([(7, k, len(s), 0, k) for k, s in sets.items()], "list long, key long, n int, pos int, component long")
    signatures = spark.createDataFrame([(k, len(s), bytearray(N.bitmap(s))) for k, s in sets.items()], "key long, n long, bits binary")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in N.across(spans, signatures, 75, Shared(spark, "n")).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and N.links(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 75)}
    assert want <= got and len(want) == 40 * 39 // 2
