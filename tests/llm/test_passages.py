from __future__ import annotations

import random

import pytest

from stockledger.llm import passages as P
from stockledger.llm.common import Shared

from .edge import ROWS, empty, frame


def words(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_planted_passages_are_cut_and_clean_texts_left(spark):
    rng = random.Random(4)
    passage, line, heading = words(rng, 55), words(rng, 70), words(rng, 12)
    near = list(line)
    near[30] = "changed"
    rows = [(i, " ".join(words(rng, rng.randint(30, 200)))) for i in range(20)]
    for i in range(20, 40):  # in the middle of a paragraph
        rows.append((i, " ".join(words(rng, rng.randint(5, 60)) + passage + words(rng, rng.randint(5, 60)))))
    rows += [(40, "\n".join(map(" ".join, (words(rng, 20), line, words(rng, 20))))), (41, "\n".join(map(" ".join, (words(rng, 9), near, words(rng, 9)))))]
    rows += [(i, "\n".join(map(" ".join, (heading, words(rng, 60))))) for i in range(50, 60)]
    rows += [(70, rows[5][1]), (71, "\n".join([" ".join(passage[:54])] * 2))]
    out = {r.doc_id: r for r in P.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text", Shared(spark, "p")).collect()}
    before = dict(rows)
    assert len(out) == len(rows)
    text = " ".join(passage)
    assert text in out[20].text and out[20].n_removed == 0
    for i in range(21, 40):
        a, b = before[i].split(text)
        assert out[i].text == a + b.lstrip() and out[i].n_removed == 55 and len(out[i].spans) == 1, i
    assert out[40].n_removed == 0 and out[41].n_removed == 70  # similar, not equal
    assert all(out[i].text == before[i] for i in [*range(20), *range(50, 60)])
    assert out[70].text == "" and out[71].text.strip() == ""
    held = [i for i in out if text in (out[i].text or "")]
    assert held == [20]


def test_odd_rows(spark):
    df = frame(spark)
    out = P.deduplicate(df, "doc_id", "text", Shared(spark, "p"), min_words=10).collect()
    assert len(out) == len(ROWS) and {c for c in out[0].asDict()} == set(df.columns) | {"n_removed"}
    by = {r.doc_id: r for r in out}
    assert by[1].text is None and by[2].text == "" and by[3].text == ROWS[2][1] and by[10].text == ROWS[-2][1]
    assert all(r.n_removed == 0 for r in out if r.doc_id == 7)  # equal rows are one text
    assert by[4].key == "mine" and by[8].text == ROWS[8][1]
    assert P.deduplicate(empty(spark), "doc_id", "text", Shared(spark, "p")).count() == 0
    same = spark.createDataFrame([(3, ROWS[6][1]), (3, ROWS[6][1] + " and more"), (None, ROWS[6][1]), (9, ROWS[6][1])], "doc_id long, text string")
    out = P.deduplicate(same, "doc_id", "text", Shared(spark, "p"), min_words=10).collect()
    assert {r.doc_id: r.n_removed for r in out if r.doc_id != 3} == {None: 0, 9: 14}
    assert sorted(r.n_removed > 0 for r in out if r.doc_id == 3) == [False, True]


def test_band_values_are_the_minima_of_each_span():
    import numpy as np

    h = np.random.default_rng(4).integers(0, 2**63, 400).astype(np.uint64)
    first, end = np.array([0, 60, 60, 200, 390, 399]), np.array([60, 200, 63, 390, 400, 400])
    out = P.band_values(h, first, end)
    assert out.shape == (6, P.BANDS) and P.band_values(h, first[:0], end[:0]).shape == (0, P.BANDS)
    factor = [int(P._STEP) ** (r + 1) % 2**64 for r in range(P.ROWS)]
    for i, (a, b) in enumerate(zip(first, end, strict=True)):
        least = ((P.shingle_hashes(h[a:b])[:, None] ^ P._SEED) * P._STEP).min(axis=0).tolist()
        sums = [sum(x * f for x, f in zip(least[j : j + P.ROWS], factor, strict=True)) % 2**64 for j in range(0, len(least), P.ROWS)]
        assert (out[i] == P.mix(np.array(sums, np.uint64))).all()


def test_blocks_lie_alike_in_a_shared_passage():
    import numpy as np
    import pyarrow as pa

    from stockledger.llm.common import Words, utf8

    rng, missed = random.Random(3), 0
    for _ in range(200):
        shared = words(rng, 51)
        w = Words(*utf8(pa.array([" ".join(words(rng, rng.randint(5, 80)) + shared + words(rng, rng.randint(5, 80))) for _ in range(2)])))
        begin = P.blocks(w)
        h = P._sequence_hashes(w.hash, begin, begin + P.BLOCK)
        row = w.row[begin]
        missed += not set(h[row == 0].tolist()) & set(h[row == 1].tolist())
        assert (begin + P.BLOCK <= w.first[row + 1]).all() and len(P.gaps(w, begin)) == len(begin)
    assert missed <= 2
    again = Words(*utf8(pa.array(["Of " * 200, "x Of " + "Of " * 150, "a b", "", None])))
    assert (np.diff(P.blocks(again)[:4]) > 0).all()


def test_near_copies_among_lines_with_a_common_part(spark):
    rng = random.Random(8)
    opening, ending = words(rng, 35), words(rng, 35)
    texts = []
    for _ in range(60):  # unlike lines have a similarity of about 0.56, the copies one of about 0.9
        own = words(rng, 20)
        texts.append(opening + own + ending)
        texts.append(opening + own[:10] + ["changed"] + own[11:] + ending)
    sets = [{tuple(t[i : i + P.SHINGLE]) for i in range(len(t) - P.SHINGLE + 1)} for t in texts]
    alike = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if 100 * len(sets[a] & sets[b]) >= P.PERCENT * len(sets[a] | sets[b])}
    assert alike == {(a, a + 1) for a in range(0, len(texts), 2)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    out = {r.doc_id: r.n_removed for r in P.deduplicate(df, "doc_id", "text", Shared(spark, "p")).collect()}
    assert all(out[a] == 0 for a, _ in alike)
    assert [b for _, b in alike if out[b] != len(texts[b])] == []


def near_copies(rng, n, words, change):
    """``n`` texts of ``words`` words that differ from the first in ``change`` words each."""
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(words)]
    out = [base]
    for _ in range(n - 1):
        own = list(base)
        for _ in range(change):
            own[rng.randrange(words)] = f"x{rng.randint(0, 10**9)}"
        out.append(own)
    return out


def wrapped(words, width):
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


@pytest.mark.parametrize("width", [15, 7, 1000])
def test_near_copies_over_several_lines_are_cut(spark, width):
    rng = random.Random(3)
    copies = near_copies(rng, 40, 60, 1)
    other = lambda: " ".join(f"o{rng.randint(0, 10**9)}" for _ in range(20))
    rows = [(i, f"{other()}\n\n{wrapped(c, width)}\n\n{other()}") for i, c in enumerate(copies)]
    rows += [(100 + i, wrapped([f"c{rng.randint(0, 10**9)}" for _ in range(90)], width)) for i in range(20)]
    out = {r.doc_id: r for r in P.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", Shared(spark, "p")).collect()}
    assert out[0].n_removed == 0 and all(out[i].n_removed == 60 for i in range(1, 40))
    assert all(out[100 + i].n_removed == 0 and out[100 + i].text == rows[40 + i][1] for i in range(20))


def test_recall_over_paragraphs_against_all_pairs(spark):
    """Templated paragraphs whose similarities lie all about the limit: each that all-pairs Jaccard removes, or nearly."""
    rng = random.Random(8)
    base = [f"t{i}" for i in range(80)]
    texts = []
    for _ in range(120):
        own = list(base) if rng.random() < 0.7 else [f"u{rng.randint(0, 10**9)}" for _ in range(80)]
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(80)] = f"x{rng.randint(0, 10**9)}"
        texts.append(own)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {i for i in range(len(texts)) if find(i) != i}
    rows = [(i, wrapped(t, 1000 if i % 2 else 16)) for i, t in enumerate(texts)]
    out = P.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", Shared(spark, "p"), min_words=80).collect()
    got = {r.doc_id for r in out if r.n_removed == 80}
    assert len(want) > 20 and not got - want and len(got) >= 0.9 * len(want)
