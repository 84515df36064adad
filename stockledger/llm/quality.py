"""Quality scores learned from preference pairs (Bradley-Terry).

A document is described by style features that no language or source sets.
Every pair of a good and a bad labelled document states a preference; the
scores are the linear function of the features for which

    P(good preferred to bad) = sigmoid(w . (x_good - x_bad))

is likeliest (logistic loss on feature differences, with an L2 penalty). A
document passes if its score is above the quantile of the learning rows'
scores that leaves as many of them as are labelled good; the published score
puts that quantile at 0.3.

One scan of the documents computes the features of whole texts, which are
stored (a few numbers a document). The fit uses all labelled rows and all their
pairs: by bins of the score, a Newton step needs only the sums of the rows of each
bin, which Spark aggregates. The quantile is exact, and a linear expression scores every row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, Words, sub_batches

FEATURES = ("log_words", "few_words", "word_len", "long_word", "upper", "digit", "symbol", "other_mark", "bang", "marked_end", "repeated_words", "run_words", "top_word", "repeated_lines", "repeated_pairs", "short_lines", "no_letter")
CUT = 0.3
#: The penalty of the fit, the width of the score's bins over which it sums pairs, and bins a class at most (FAR: the last bin's number).
L2, BIN, MAX_BINS, FAR = 1e-3, 1 / 64, 4096, 1 << 15

_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower or not ASCII, 3 digit, 4 symbol, 5 '!' or '?', 6 other mark, 0 space or control
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(97, 123), *range(128, 256)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[i for i in range(33, 127) if not chr(i).isalnum()]] = 6
_KIND[[ord(c) for c in "#*$%&|<>"]] = 4
_KIND[[ord(c) for c in "!?"]] = 5


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; a text without words is all zero but ``few_words`` and ``no_letter``."""
    w = Words(raw, off)
    n_rows = len(off) - 1
    out = np.zeros((n_rows, len(FEATURES)))
    kind = _KIND[raw]
    h, length = w.hash, w.end - w.start
    ends_marked = (kind[w.end - 1] == 4) | (kind[w.end - 1] == 5) if len(w.start) else np.zeros(0, bool)
    for r in range(n_rows):
        a, b = w.first[r], w.first[r + 1]
        n = b - a
        if not n:
            out[r, 1] = out[r, 16] = 1
            continue
        by_kind = np.bincount(kind[off[r] : off[r + 1]], minlength=7)
        shown = max(1, by_kind[1:].sum())
        cased = max(1, by_kind[1] + by_kind[2])
        words = h[a:b]
        _, times = np.unique(words, return_counts=True)
        pairs = len(np.unique(words[1:] * np.uint64(3) + words[:-1])) if n > 1 else 0
        text = raw[off[r] : off[r + 1]].tobytes()
        lines = [x for x in text.split(b"\n") if x.strip()]
        expected = n ** 0.85  # distinct words grow slower than the text
        out[r] = (
            math.log(n) / 8,
            1.0 if n < 20 else 0.0,
            length[a:b].mean() / 10,
            (length[a:b] > 25).mean(),
            by_kind[1] / cased,
            by_kind[3] / shown,
            by_kind[4] / shown,
            by_kind[6] / shown,
            by_kind[5] / shown,
            ends_marked[a:b].mean(),
            max(0.0, 1 - len(times) / expected),
            (words[1:] == words[:-1]).mean() if n > 1 else 0.0,
            times.max() / n if n >= 20 else 0.0,
            1 - len(set(lines)) / len(lines),
            1 - pairs / (n - 1) if n > 1 else 0.0,
            min(1.0, len(lines) / n * 4),
            1.0 if not by_kind[1] + by_kind[2] else 0.0,
        )
    return out


def with_features(df: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, one column per feature) for every row; null text is empty text, repeated rows stay."""
    kind = df.schema[key].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in sub_batches(b.column("t")):
                x = features(raw, off)
                yield pa.RecordBatch.from_arrays([b.column("key").slice(lo, hi - lo), *(pa.array(x[:, i]) for i in range(x.shape[1]))], ["key", *FEATURES])

    return df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(part, f"key {kind}, " + ", ".join(f"{f} double" for f in FEATURES)).withColumnRenamed("key", key)


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float  # the score at which a document passes
    slope: float  # of the published score

    def score(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def pair_weights(good: np.ndarray, bad: np.ndarray, n_good: np.ndarray, n_bad: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all pairs of a good and a bad row, whose scores and counts are given by bins: the sums of
    P(other order) and of its variance over each good bin's and each bad bin's pairs, and the variances by pair of bins."""
    other = 1 / (1 + np.exp(np.clip(good[:, None] - bad[None, :], -40, 40)))
    spread = other * (1 - other)
    return other @ n_bad, n_good @ other, spread @ n_bad, n_good @ spread, spread


def newton(n: int, binned: Callable, curved: Callable, l2: float) -> np.ndarray:
    """The weights of ``n`` features for which the preferences of all pairs are likeliest.

    ``binned(w)``: for good and for bad rows, by bins of the score, (score, count, sums of
    features); ``curved(w, good, of good, bad, of bad)``: the rows' sum of weight x x^T, the weight
    being interpolated between scores. Both read every row; the pairs are summed by bins of BIN, whose
    rows count with their mean score.
    """
    w = np.zeros(n)
    for _ in range(30):
        (g, n_g, x_g), (b, n_b, x_b) = binned(w)
        pairs = n_g.sum() * n_b.sum()
        of_good, of_bad, curve_good, curve_bad, spread = pair_weights(g, b, n_g, n_b)
        gradient = (of_bad @ x_b - of_good @ x_g) / pairs + l2 * w
        cross = x_g.T @ spread @ x_b
        curve = (curved(w, g, curve_good, b, curve_bad) - cross - cross.T) / pairs + l2 * np.eye(n)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-4:  # bins move by about 1e-5 a step
            break
    return w


def _merged(at: np.ndarray, count: np.ndarray, scores: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean score, count, sums) by bin in order; neighbouring bins are joined until there are at most MAX_BINS."""
    while len(np.unique(at)) > MAX_BINS:
        at = at // 2
    _, place = np.unique(at, return_inverse=True)
    n = np.bincount(place, count)
    x = np.zeros((len(n), sums.shape[1]))
    np.add.at(x, place, sums)
    return np.bincount(place, scores) / n, n, x


def _curve(x: np.ndarray, good: np.ndarray, w: np.ndarray, g: np.ndarray, of_g: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    s = x @ w
    return (x * np.where(good, np.interp(s, g, of_g), np.interp(s, b, of_b))[:, None]).T @ x


def bradley_terry(x: np.ndarray, good: np.ndarray, l2: float = L2) -> np.ndarray:
    """Weights from all pairs of a good and a bad row of a matrix (:func:`fit` does the same over a table)."""

    def binned(w: np.ndarray) -> list:
        s = x @ w
        return [_merged(np.floor(s[k] / BIN).astype(np.int64), np.ones(k.sum()), s[k], x[k]) for k in (good, ~good)]

    return newton(x.shape[1], binned, lambda w, *of: _curve(x, good, w, *of), l2)


def order_statistics(values: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """The values of the given ranks (from 0) of a column without nulls, exactly.

    Each pass counts the values of a range by 1,024 bins and goes on in the bin that holds
    the rank, until that bin's values are all alike.
    """
    out = []
    for rank in ranks:
        lo, hi = values.agg(F.min(column), F.max(column)).first()
        while lo < hi:
            inside = values.where(F.col(column).between(lo, hi))
            at = F.least(F.lit(1023), F.floor((F.col(column) - F.lit(lo)) / F.lit(hi - lo) * 1024))
            for n, lo, hi in sorted((r[1:] for r in inside.groupBy(at.alias("at")).agg(F.count("*"), F.min(column), F.max(column)).collect()), key=lambda r: r[1]):
                if rank < n:
                    break
                rank -= n
        out.append(float(lo))
    return out


def fit(rows: DataFrame, label: str, key: str) -> Model | None:
    """Fit on all feature rows whose ``label`` is 0 or 1 (others are left out); None unless both occur.

    The labelled rows are stored once. Means, the sums of each Newton step (a row a
    class and bin of the score) and the quantiles are aggregates over all of them.
    """
    spark = rows.sparkSession
    found = Shared(spark, "quality-fit").save(rows.where(F.col(label).isin(0, 1)).select((F.col(label) == 1).alias("y"), *FEATURES), "labelled")
    of = found.agg(F.count("*"), F.count_if("y"), *[F.avg(f) for f in FEATURES], *[F.stddev_pop(f) for f in FEATURES]).first()
    n, n_good = of[:2]
    if not n or n_good in (0, n):
        return None
    k = len(FEATURES)
    mean, scale = np.array(of[2 : 2 + k]), np.maximum(np.array(of[2 + k :]), 1e-6)
    x = found.select("y", *[((F.col(f) - F.lit(float(m))) / F.lit(float(s))).alias(f) for f, m, s in zip(FEATURES, mean, scale, strict=True)])

    def scored(w: np.ndarray) -> DataFrame:
        return x.withColumn("s", reduce(Column.__add__, [F.col(f) * F.lit(float(v)) for f, v in zip(FEATURES, w, strict=True)]))

    def binned(w: np.ndarray) -> list:
        at = F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.floor(F.col("s") / BIN)))
        got = np.array([tuple(map(float, r)) for r in scored(w).groupBy("y", at.alias("at")).agg(F.count("*"), F.sum("s"), *[F.sum(f) for f in FEATURES]).collect()])
        return [_merged(c[:, 1].astype(np.int64), c[:, 2], c[:, 3], c[:, 4:]) for c in (got[got[:, 0] == 1], got[got[:, 0] == 0])]

    def curved(w: np.ndarray, *of: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k))
            for b in batches:
                total += _curve(np.column_stack([b.column(f).to_numpy() for f in FEATURES]), b.column("y").to_numpy(zero_copy_only=False), w, *of)
            yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["at", "v"])

        got = x.mapInArrow(part, "at int, v double").groupBy("at").agg(F.sum("v")).collect()
        return np.array([v for _, v in sorted(map(tuple, got))]).reshape(k, k)

    weights = newton(k, binned, curved, L2)
    s = scored(weights).select("s")
    cut = float(np.mean(order_statistics(s, "s", [n - n_good - 1, n - n_good])))
    spread = float(np.mean(order_statistics(s.select(F.abs(F.col("s") - F.lit(cut)).alias("d")), "d", [(n - 1) // 2, n // 2]))) or 1.0
    return Model(weights, mean, scale, cut, 2.0 / spread)


def score(rows: DataFrame, model: Model | None, label_rate: float = 0.5) -> Column:
    """The published score of a feature row: 0 to 1, 0.3 at the cut. Without a model every row gets ``label_rate``."""
    if model is None:
        return F.lit(float(label_rate))
    raw = F.lit(float(-(model.mean / model.scale) @ model.weights))
    for f, w, s in zip(FEATURES, model.weights, model.scale, strict=True):
        raw = raw + F.col(f) * F.lit(float(w / s))
    z = (raw - F.lit(model.cut)) * F.lit(model.slope) + F.lit(math.log(CUT / (1 - CUT)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_labels(features_of: DataFrame, labels: DataFrame, key: str, label: str, learn: Column) -> Model | None:
    """Join feature rows with one label per key (the greatest, if several) where ``learn`` holds, and fit."""
    one = labels.where(F.col(label).isNotNull() & learn).groupBy(key).agg(F.max(label).alias("__label"))
    return fit(features_of.join(one, key), "__label", key)
