"""Language identification: sparse multinomial logistic regression on hashed TF-IDF character n-grams.

Text is lower-cased, every run of characters that are no letters counts as one
space, and n-grams of 1 to 3 characters are hashed into ``BUCKETS`` buckets. A
text's vector is (1 + ln tf) * idf, of length one; idf comes from all documents.
Weights are learned by follow-the-regularised-leader with elastic-net penalties,
one example at a time, on a bounded sample that holds rows of every labelled
language; a temperature fitted on the part of the sample that learning did not
see calibrates the probabilities.

Texts are scored whole, in two scans of the documents (idf, then scores).
Only fixed-size state reaches the driver: the bucket counts, the sample's
sparse vectors and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sample_key, sub_batches

BUCKETS = 1 << 14
NO_LANGUAGE = "und"
#: Rows of the learning sample over all languages, the first by a hash of the id; and the first rows of each language, which are in it too.
SAMPLE_ROWS, LANGUAGE_ROWS = 3000, 100
_CODE_POINTS = 0x110000
_FOLD: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """code point -> its lower-case code point, or 32 for what is no letter."""
    global _FOLD
    if _FOLD is None:
        table = np.full(_CODE_POINTS, 32, np.uint32)
        for c in range(_CODE_POINTS):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD = table
    return _FOLD


def letters(text: str) -> np.ndarray:
    """Folded code points with single spaces between runs of letters; empty if there is no letter."""
    folded = _fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = folded == 32
    if gap.all():
        return folded[:0]
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    return folded[keep]


def buckets(points: np.ndarray) -> np.ndarray:
    """Bucket of every 1-, 2- and 3-gram of the padded sequence."""
    c = np.concatenate([[32], points, [32]]).astype(np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return np.concatenate([one, two, three]) >> np.uint32(18)


def counts(text: str | None) -> np.ndarray | None:
    """Counts by bucket; None for null or for text without a letter."""
    points = letters(text) if text else None
    if points is None or not len(points):
        return None
    return np.bincount(buckets(points), minlength=BUCKETS)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, str]]:
    for lo, hi, raw, off in sub_batches(batch.column(name)):
        data = raw.tobytes()
        for i in range(hi - lo):
            yield lo + i, data[off[i] : off[i + 1]].decode("utf-8", "replace")


def document_frequencies(df: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(documents with each bucket, documents with a letter) over all rows of ``df``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for _, t in _texts(b, "t"):
                c = counts(t)
                if c is not None:
                    total += c > 0
                    n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(BUCKETS + 1)), "n": pa.array(np.append(total, n))})

    rows = df.select(F.col(text).alias("t")).mapInArrow(part, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out[:BUCKETS], int(out[BUCKETS])


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x langs
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def vector(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _vector(c, self.idf)

    def probabilities(self, c: np.ndarray) -> np.ndarray:
        at, x = self.vector(c)
        return _softmax((x @ self.weights[at] + self.bias) / self.temperature)


def _vector(c: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(c)
    x = (1 + np.log(c[at])) * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias): per-coordinate follow-the-regularised-leader with L1 and L2; the bias is not penalised."""
    z, n = np.zeros((BUCKETS + 1, n_langs)), np.zeros((BUCKETS + 1, n_langs))

    def leader(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(z[at]) <= l1] = 0
        if at[-1] == BUCKETS:
            w[-1] = -z[BUCKETS] / ((beta + np.sqrt(n[BUCKETS])) / alpha)
        return w

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, x, y = examples[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = leader(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = leader(np.arange(BUCKETS + 1))
    return w[:BUCKETS], w[BUCKETS]


def held_back(langs: list[int]) -> np.ndarray:
    """Whether each example is for the temperature: every fifth of its language, so no language is all held back."""
    seen: dict[int, int] = {}
    out = np.zeros(len(langs), bool)
    for i, y in enumerate(langs):
        seen[y] = seen.get(y, 0) + 1
        out[i] = seen[y] % 5 == 0
    return out


def fit(df: DataFrame, text: str, lang: str, key: str, learn: Column, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn from the rows where ``learn`` holds and ``lang`` is not null; None if there is none with a letter.

    idf covers all rows of ``df``. The sample is the first ``sample_rows`` rows
    over all languages and the first ``LANGUAGE_ROWS`` of each one. A fifth of
    each language's rows, rounded down, is only for the temperature.
    """
    freq, n_docs = document_frequencies(df, text)
    idf = np.log((1 + n_docs) / (1 + freq)) + 1
    known = df.where(learn & F.col(lang).isNotNull())
    # the ids are chosen without their texts, so the ordering moves small rows only
    ids = known.select(F.col(key).alias("__chosen"), F.col(lang).cast("string").alias("__lang"), sample_key(key).alias("__order"))
    first = ids.orderBy("__order", "__chosen").limit(sample_rows).select("__chosen")
    # Spark keeps a partition's first rows of each language before it shuffles, so a common language is not gathered
    each = ids.withColumn("__n", F.row_number().over(Window.partitionBy("__lang").orderBy("__order", "__chosen"))).where(F.col("__n") <= LANGUAGE_ROWS).select("__chosen")
    chosen = first.union(each).distinct()
    rows = known.join(F.broadcast(chosen), F.col(key) == F.col("__chosen")).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("l").to_pylist()
            for i, t in _texts(b, "t"):
                c = counts(t)
                if c is not None:
                    at, x = _vector(c, idf)
                    yield pa.RecordBatch.from_pydict({"l": [langs[i]], "at": [at.astype(np.uint16).tobytes()], "x": [x.astype(np.float32).tobytes()]})

    found = rows.mapInArrow(part, "l string, at binary, x binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (bytes(r.at), bytes(r.x), r.l))
    langs = sorted({r.l for r in found})
    examples = [(np.frombuffer(r.at, np.uint16).astype(np.int64), np.frombuffer(r.x, np.float32).astype(float), langs.index(r.l)) for r in found]
    aside = held_back([e[2] for e in examples]) if len(examples) >= 50 else np.zeros(len(examples), bool)
    held = [e for e, out in zip(examples, aside, strict=True) if out] or examples
    weights, bias = ftrl([e for e, out in zip(examples, aside, strict=True) if not out], len(langs))
    logits = np.array([x @ weights[at] + bias for at, x, _ in held])
    y = np.array([e[2] for e in held])
    scale = np.exp(np.linspace(-2.5, 1.5, 81))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in scale]
    return Model(langs, weights.astype(np.float32), bias, idf, float(scale[int(np.argmin(loss))]))


def predict(df: DataFrame, model: Model | None, key: str, text: str) -> DataFrame:
    """(``key``, lang_pred, score): the likeliest language and its probability, one row per row of ``df``.

    Null text, text without a letter, or no model: ``und`` with score 0. Ties
    go to the language that sorts first. Other columns are not read; repeated
    rows stay.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = [NO_LANGUAGE] * b.num_rows, [0.0] * b.num_rows
            for i, t in _texts(b, "t") if model else ():
                c = counts(t)
                if c is not None:
                    p = model.probabilities(c)
                    pred[i], score[i] = model.langs[int(p.argmax())], float(p.max())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["key", "lang_pred", "score"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(part, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
