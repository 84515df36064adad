from __future__ import annotations

import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockledger.llm import common
from stockledger.llm.common import Shared, Words, components, fold, sub_batches, utf8

from .edge import ROWS


def test_words_match_python_split():
    texts = [t for _, t in ROWS] + ["a  b\tC\x0bD\x0cE\rF", "é É Ä"]
    w = Words(*utf8(pa.array(texts)))
    for r, t in enumerate(texts):
        got = [w.low[w.start[i] : w.end[i]].tobytes() for i in range(w.first[r], w.first[r + 1])]
        assert got == [x.lower() for x in (t or "").encode().split()]


def test_hashes_tell_words_and_shingles_apart():
    texts = ["a b c d e f", "a b c d e", "a b c", "c b a", "A B C", "a b c d e f a b c d e f"]
    w = Words(*utf8(pa.array(texts)))
    values, rows = w.shingles(5)
    sets = [set(values[rows == r].tolist()) for r in range(len(texts))]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 6]
    assert sets[1] < sets[0] < sets[5] and sets[2] == sets[4] != sets[3]
    words = [f"w{i}" for i in range(20_000)]
    assert len(set(Words(*utf8(pa.array([" ".join(words)]))).hash.tolist())) == len(words)


def test_sub_batches_cover_all_rows():
    texts = ["x" * n for n in (0, 10, 3000, 5, 0, 0, 999, 1)] + [None]
    seen = []
    for lo, hi, raw, off in sub_batches(pa.array(texts).slice(1), 1000):
        seen += [raw[off[i] : off[i + 1]].tobytes().decode() for i in range(hi - lo)]
    assert seen == [t or "" for t in texts[1:]]
    assert list(sub_batches(pa.array([], pa.string()))) == []


def test_fold_is_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 17, 12345, -3)], "doc_id long")
    for r in df.select("doc_id", fold("doc_id", 4).alias("f")).collect():
        assert r.f == zlib.crc32(str(r.doc_id).encode()) % 4


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a path
    edges += [(2000, 2001 + i) for i in range(60)] + [(5, 5), (2000, 2001)]  # a star, a loop, a repeat
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = dict(map(tuple, components(df, Shared(spark, "test")).collect()))
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: root(v) for v in linked}
    if seed == 1:
        assert components(df.where("a < 0"), Shared(spark, "test")).count() == 0


def _tasks(spark, run):
    """What ``run`` returns, and how many tasks its jobs had."""
    tracker, group = spark.sparkContext.statusTracker(), f"test-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return out, sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)))


@pytest.mark.parametrize("edges_a_task", [200_000, 16])
def test_rounds_of_components_take_tasks_by_their_edges(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(common, "EDGES_A_TASK", edges_a_task)
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 99) if i % 20 != 19] + [(3, 2)] * 5, "a long, b long").repartition(4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got, n = _tasks(spark, lambda: components(edges, Shared(spark, "test")).collect())
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    assert sorted(map(tuple, got)) == [(i, i // 20 * 20) for i in range(100)]
    assert n < 120 or edges_a_task == 16, n


def test_batches_of_wide_rows_are_bounded_by_bytes(spark):
    Shared(spark, "test_batches")
    wide = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 50_000).alias("t"))

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    seen = wide.mapInArrow(size, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 400
    assert max(r["bytes"] for r in seen) < 5_000_000
