from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockledger.llm.common import Shared, number
from stockledger.llm.mixing import mix

from .edge import empty, frame


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def by_definition(rows, weights=(3, 1, 2), budget=1.5, most=2.0):
    """[(id, source, size, target, taken)] of rows (id, text, source), one by one."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += words(text)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        free = [s for s in order if s not in full]
        rest = budget * sum(size.values()) - most * sum(size[s] for s in full)
        target = {s: most * size[s] if s in full else rest / sum(w[x] for x in free) * w[s] for s in order}
        over = [s for s in free if target[s] > most * size[s]]
        if not over:
            break
        full |= set(over)
    out = []
    for s in order:
        own = [(int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16), words(t), i) for i, t, x in rows if x == s]
        left = min(int(target[s] + 0.5), int(most) * size[s])
        rounds = left // size[s] if size[s] else 0
        left -= rounds * size[s]
        for _, z, i in sorted(own, key=lambda x: x[:2]):
            out.append((i, s, z, target[s], rounds * z + min(z, left)))
            left -= min(z, left)
    return out


def rounded(rows):
    return sorted([(str(i), str(s), z, round(t, 6), k) for i, s, z, t, k in rows])


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return [(r.doc_id, r.source, r.size, r.target, r.taken) for r in mix(df, "doc_id", "text", "source", Shared(spark, "t"), **kw).collect()]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.sampled_from(["", " ", "a", "a b", "a b c " * 7])), st.sampled_from([None, "", "x", "ä", "Z", "\U0001f600", "￮"])), min_size=1, max_size=30))
def test_mix_equals_its_definition(spark, rows):
    assert rounded(run(spark, rows)) == rounded(by_definition(rows))


def test_hot_source_copies_and_other_shares(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 60), rnd.choice(["hot", "hot", "b", "c", None])) for i in range(1500)] + [(7, "the same row", "b")] * 400
    for kw in ({}, dict(weights=(1, 5), budget=0.4, most=1.0)):
        got = run(spark, rows, **kw)
        assert rounded(got) == rounded(by_definition(rows, **kw))
        taken, target = defaultdict(int), {}
        for _, s, z, t, k in got:
            assert k <= kw.get("most", 2) * z
            taken[s] += k
            target[s] = t
        assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)


def test_a_larger_budget_keeps_what_a_smaller_one_takes(spark):
    rows = [(i, "w " * (i % 50), "s") for i in range(400)]
    small, large = ({r[0]: r[4] for r in run(spark, rows, budget=b)} for b in (0.3, 1.2))
    assert all(large[i] >= k for i, k in small.items())


def test_odd_rows(spark):
    out = mix(frame(spark), "doc_id", "text", "source", Shared(spark, "t"))
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert out.count() == frame(spark).count()
    assert mix(empty(spark), "doc_id", "text", "source", Shared(spark, "t")).count() == 0
    with pytest.raises(ValueError):
        mix(frame(spark), "doc_id", "text", "source", Shared(spark, "t"), weights=())


def test_numbers_have_no_gaps_however_the_rows_are_dealt(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("hot"), F.col("id").alias("x"))
    got = sorted((r.n, r.hot, r.x) for r in number(df, [F.col("hot"), F.col("x")], Shared(spark, "t"), "x", 90).collect())
    assert [g[0] for g in got] == list(range(1000)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
