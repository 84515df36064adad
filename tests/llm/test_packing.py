from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockledger.llm import packing as K
from stockledger.llm.common import Shared
from stockledger.llm.queries import tokeniser

from .edge import ROWS, empty, frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokeniser()["path"])


def test_ids_equal_the_tokenizer_s(tokenizer, monkeypatch):
    rng = random.Random(0)
    texts = ["", " ", "a  b", "\n a", "a \n b\n\nc", "it's we 'll  don't", "<|endoftext|> x <|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c\n<|endoftext|>", "<|endof text|>", "x\t y", "  a  b \x1c c", "a" * 300 + " b" * 50]
    texts += ["".join(rng.choice(" \n\tab'1.é  ") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [t.as_py() for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text")]
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for ranks in (None, tokeniser()["ranks"]):
        encoder = K.Encoder(tokeniser()["path"], ranks)
        assert encoder.encode(texts) == want and encoder.encode(texts) == want
    monkeypatch.setattr(K, "_CACHE_WORDS", 50)  # memory is renewed all the time
    encoder = K.Encoder(**tokeniser())
    assert [ids for t in texts for ids in encoder.encode([t])] == want


def check(rows, pieces, tokenizer, window):
    """Every id of every row in one piece; sequences full but for the last, gapless, numbered from 0."""
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    by, seq = {}, {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by) == set(ids)
    for d, copies in ids.items():
        want = sum(len(c) for c in copies)
        assert sum(x[1] for x in by[d]) == want
        for s, n, crc, total in by[d]:
            assert any(len(c) == total and zlib.crc32(np.array(c[s : s + n], "<u4").tobytes()) == crc for c in copies)
        if len(copies) == 1:
            at = 0
            for s, n, _, _ in sorted(by[d]):
                assert s == at
                at += n
    assert sorted(seq) == list(range(len(seq)))
    for q, parts in seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == window or (at < window and q == len(seq) - 1)


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces_hold_every_id_once(spark, tokenizer, window):
    rng = random.Random(window)
    rows = [(i, " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) for _ in range(rng.choice([3, 20, 20, 60, 700])))) for i in range(150)]
    rows += [*ROWS, *[(500 + i, "the same short text") for i in range(120)]]  # one length is common
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = K.pack(K.tokenise(df, "doc_id", "text", **tokeniser(), window=window), "doc_id", Shared(spark, "k"), window).collect()
    check(rows, pieces, tokenizer, window)


def test_odd_frames(spark):
    for df, n in ((empty(spark), 0), (frame(spark).where("doc_id = 1"), 1)):
        assert K.pack(K.tokenise(df, "doc_id", "text", **tokeniser()), "doc_id", Shared(spark, "k")).count() == n
    assert frame(spark).where(F.col("key") == "mine").count() == len(ROWS)


def test_repeat_counts_solve_the_least_squares():
    rng = np.random.default_rng(2)
    combos = K.combinations(48)
    assert (combos.sum(1) == 48).all() and (combos[:, 1:] > 0).all()
    h = np.bincount(rng.integers(1, 48, 4000), minlength=48)
    x = K.repeat_counts(h, combos, 3000)
    used = np.zeros(48)
    for c, n in zip(combos, x):
        for length in c[c > 0]:
            used[length] += n
    assert (x >= 0).all() and np.abs(used - h).sum() < 0.08 * h.sum()
    slots, sequences = K.plan(h, 48)
    spent = np.zeros(48, int)
    for length, lo, hi, _, _ in slots:
        assert lo == spent[length]  # ranks of a length are dealt without gaps
        spent[length] = hi
    assert (spent <= h).all() and (spent * np.arange(48)).sum() == 48 * sequences and spent.sum() > 0.85 * h.sum()
    assert K.plan(np.zeros(48, int), 48) == ([], 0)
