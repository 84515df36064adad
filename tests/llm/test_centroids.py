from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockledger.llm.centroids import Simplex, assign, choose_pivots, cluster, squared, whole
from stockledger.llm.common import Shared, read


def by_definition(rows, dims, k=8, rounds=10, seed=3):
    """Plain integers, every vector against every centroid: sorted (id, cluster, distance, cluster inertia, inertia, digest)."""
    v = [(i, [math.floor(1024 * float(x)) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    v.sort(key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [e for _, e in v[:k]]

    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        to = [nearest(e)[1] for _, e in v]
        for c in range(len(cents)):
            own = [e for (_, e), t in zip(v, to) if t == c]
            if own:
                cents[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [(i, *nearest(e)) for i, e in v]
    per = {c: sum(d for _, d, t in last if t == c) for c in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    most = (1 << 63) - 1
    return sorted(((str(i), t, min(d, most), min(per[t], most), min(sum(per.values()), most), sha[t]) for i, d, t in last))


def run(spark, rows, dims, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = cluster(df, "vec_id", "embedding", Shared(spark, "t"), dims=dims, **kw).collect()
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out), out


def test_clusters_of_odd_rows_equal_plain_integers(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(0, 2, (5, 6))
    rows = [(i, (centres[i % 5] + rnd.normal(0, 0.2, 6)).tolist()) for i in range(300)]
    rows += [(1000, [0.5] * 6)] * 150 + [(2000 + i, [0.25] * 6) for i in range(40)]  # copies of one row, and of one vector
    rows += [(None, [1.0] * 6), (3, None), (4, []), (5, [1.0] * 5), (6, [1.0] * 7), (7, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (8, [math.nan] * 6), (9, [math.inf] * 6)]
    rows += [(10, [9e4, 0.0, 0.0, 0.0, 0.0, 1.0]), (11, [-0.0001] * 6)]
    got, out = run(spark, rows, 6)
    assert got == by_definition(rows, 6)
    assert sum(r.n_compared for r in out) < 0.6 * 8 * len(out)  # the bounds hold most centroids off


def test_few_large_and_no_vectors(spark):
    for rows in ([(1, [1.0, 2.0])], [(i, [float(i), 0.0]) for i in range(4)], [(i, [1.0, 1.0]) for i in range(20)], [(i, [i * 1e8, -3e7 * i]) for i in range(12)]):
        assert run(spark, rows, 2)[0] == by_definition(rows, 2)
    got, _ = run(spark, [(i, [i * 1e300, 1.0]) for i in range(1, 12)], 2)
    assert len(got) == 11 and max(g[2] for g in got) <= (1 << 63) - 1
    assert run(spark, [], 2)[0] == [] and run(spark, [(1, None)], 2)[0] == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], "mine") for i in range(20)], "embedding_id long, apex array<double>, cluster string")
    out = cluster(df, "embedding_id", "apex", Shared(spark, "t"), dims=2, k=3)
    assert out.columns[0] == "embedding_id" and out.count() == 20


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 9), st.sampled_from([1.0, 1e-3, 300.0]))
def test_bounds_hold_for_random_vectors(seed, dims, spread):
    rnd = np.random.default_rng(seed)
    v = whole(rnd.normal(0, spread, (80, dims)) + rnd.integers(0, 2, (80, 1)) * 5 * spread)
    v[10:20] = v[0]
    simplex = Simplex(choose_pivots(v))
    a, c = simplex.apexes(v), simplex.apexes(v[:7])
    to, d, _ = assign(v, a, v[:7], c)
    plain = np.stack([squared(v, np.broadcast_to(x, v.shape)) for x in v[:7]], axis=1)
    assert (d == plain.min(axis=1)).all() and (to == plain.argmin(axis=1)).all()
    near = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    true, slack = np.sqrt(plain), 1e-5 * np.sqrt(plain.max() + 1)
    assert np.all(np.sqrt(near + (a[:, None, -1] - c[None, :, -1]) ** 2) <= true + slack)
    assert np.all(np.sqrt(near + (a[:, None, -1] + c[None, :, -1]) ** 2) >= true - slack)


@pytest.mark.parametrize("k", [8])
def test_the_table_against_plain_integers(spark, sf_dir, k):
    df = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out = cluster(df, "vec_id", "embedding", Shared(spark, "t"), k=k).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out) == by_definition(rows, 64, k)
