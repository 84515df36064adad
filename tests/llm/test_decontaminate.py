from __future__ import annotations

import hashlib
import random
import re

from stockledger.llm import decontaminate as D
from stockledger.llm.common import Shared

from .edge import ROWS, empty, frame

_W = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return _W.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=10):
    wins: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[a : a + k]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if x := wins.get(tuple(w[a : a + k])):
                    hit |= set(range(a, a + k))
                    found |= x
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(set(out), key=str)


def run(spark, docs, items):
    found, hits = D.find(docs, "doc_id", "text", items, "item_id", "text", Shared(spark, "d"))
    return [tuple(r) for r in D.report(found, "doc_id", hits).drop("doc").collect()]


def test_hits_match_brute_force(spark):
    rng = random.Random(8)
    voc = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    items = [(i, text(rng.randint(10, 40))) for i in range(30)] + [(30, text(1) + "zq"), (31, text(4)), (32, text(9)), (33, None), (34, "!!"), (None, text(12)), (2, text(11))]
    docs = list(ROWS)
    for i in range(100, 180):
        w = text(rng.randint(0, 120)).split(" ")
        for _ in range(rng.randint(0, 3)):  # whole items, or parts around the window's length
            s = words(rng.choice(items)[1])
            a = rng.randrange(len(s) + 1)
            w[rng.randrange(len(w) + 1) : 0] = s[a : a + rng.randint(7, 14)] if rng.random() < 0.6 else s
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if rng.random() < 0.3 else " ".join(w)))
    got = run(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(set(got), key=str) == brute(docs, items)
    assert sum(r[5] for r in got) > 20


def test_odd_frames(spark):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert run(spark, empty(spark), items) == []
    none = run(spark, frame(spark), items.where("item_id > 1"))
    assert not any(r[5] for r in none) and len(none) == len(set(ROWS))
    hit = run(spark, frame(spark), items)
    assert {r[0] for r in hit if r[5]} == {5, 6}
