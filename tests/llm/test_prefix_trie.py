from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stockledger.llm import prefix_trie
from stockledger.llm.common import Shared
from stockledger.llm.prefix_trie import rank, running, trie


def by_definition(rows):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, sha)} of rows (conv, turn, role, text), by plain dictionaries."""
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn, role or "", hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    for v in said.values():
        v.sort(key=lambda r: (r[0], r[1] or 0, *r[2:]))
    built = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple((r[2], r[4]) for r in said.get(base, [])[:h] + said[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in sorted(built.items()):
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
        ends[t].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = own + sum(saved[x] for x in children[p])
    return {
        (members[p][0], len(p)): (members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p in members
    }


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = trie(df, "conv_id", "turn", "role", "text", Shared(spark, "t")).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out}
    assert len(got) == len(out)
    return got


@pytest.fixture(params=["one block", "many"])
def sizes(request, monkeypatch):
    """Blocks, lists and spans so small that every round of the contraction and every carry runs."""
    if request.param == "many":
        for name, value in dict(BLOCK=40, RUN=4, CHOSEN=4, BASE=12, SPAN_BITS=4, PIECE_BITS=2).items():
            monkeypatch.setattr(prefix_trie, name, value)


def odd_rows():
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(["a", "bb", "", None, "\U0001f600"])) for c in range(90, 330) if c not in (200, 250) for t in range(rnd.randint(1, 9))]
    rows += [(1000, t, "user", f"long {t}") for t in range(400)]  # one conversation holds a large part of all rows
    rows += [(c, t, "user", f"copy {t}") for c in range(1100, 1180) for t in range(7)]  # copies
    rows += [(5, 0, "user", "short"), (100_000_007, 0, "u", "x"), (-150, 1, "u", "y"), (-100, 1, "u", "z"), (-100, 2, "u", "z")]
    rows += [(7, None, "u", "null first"), (7, 1, "u", "b"), (7, 1, "u", "b"), (7, 1, "u", "a"), (7, 2, None, None), (None, 1, "u", "nobody")]
    rows += [(8, 1, "ab", "c"), (9, 1, "a", "bc")]
    return rows


def test_trie_equals_its_definition(spark, sizes):
    rows = odd_rows()
    assert run(spark, rows) == by_definition(rows)


def test_empty_and_turnless(spark):
    assert run(spark, []) == {} and run(spark, [(None, 1, "a", "b")]) == {}
    # conversation 301 has fewer turns than it skips, and its group has no first conversation
    c = next(c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6 > 2)
    assert run(spark, [(c, 1, "a", "b")]) == by_definition([(c, 1, "a", "b")]) == {(c, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, 0, "r", f"t{i}", "mine", "mine") for i in range(5)], "turn long, conv_id long, x string, text string, n string, Depth string")
    assert trie(df, "turn", "conv_id", "x", "text", Shared(spark, "t")).count() > 1


@pytest.mark.parametrize("n", [1, 13, 700])
def test_rank_of_shuffled_lists(spark, sizes, n):
    names = [(random.Random(i).randint(0, 5), i) for i in range(n)]
    random.Random(n).shuffle(names)
    links = [(*a, *b, 1) for a, b in zip(names, names[1:])] + [(*names[-1], -1, -1, 0)]
    out = rank(spark.createDataFrame(links, "c long, k long, nc long, nk long, hops long"), Shared(spark, "t")).collect()
    assert {(r.c, r.k): r.after for r in out} == {a: n - 1 - i for i, a in enumerate(names)}


def test_running_sums_over_spans(spark, sizes):
    rows = [(i, 0 if i < 90 else i // 7, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "n long, g long, v long").repartition(5)
    out = running(df, "n", ["g"], {"s": F.col("v")}, F.sum, Shared(spark, "t"), "s").collect()
    assert all(r.s == sum(v for n, g, v in rows if g == r.g and n <= r.n) for r in out) and len(out) == 200
