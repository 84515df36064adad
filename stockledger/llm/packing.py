"""Packing of tokenised documents into windows, planned by non-negative least squares.

A document of n tokens gives ``n // window`` full windows and a tail. Shallow
combinations of tail lengths that fill a window exactly (pairs, and triples
over a spread of second lengths) are enumerated; non-negative least squares
chooses how often to use each so that the lengths used match the histogram of
tails; the counts are rounded to what the histogram holds. Tails are then
ranked within their length and dealt to the slots of the combinations. What
is left over is packed greedily end to end and cut at window ends, so that
only the very last sequence can need padding.

The histogram, the combinations and the slot table have a size set by the
window alone. Ranks and running sums are taken within hashed groups of rows
and completed from group totals, so no window function sees all rows and no
common length gathers in one task.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, sub_batches

WINDOW = 2048
#: Rows in a hashed group of the running sums, about.
GROUP_ROWS = 20_000
#: Second lengths tried for each first length of a triple.
TRIPLE_SPREAD = 24
#: Words remembered in a generation.
_CACHE_WORDS = 250_000
#: A word without white space, perhaps behind one line end.
_VISIBLE = re.compile(r"\n?[^\s\x1c-\x1f\x85]+").fullmatch
#: White space that a word between single spaces may not hold (a line end can only be its first character).
_ODD_SPACE = re.compile(r"[^\S\n]|[\x1c-\x1f\x85]").search


class Encoder:
    """Token ids of texts, as bytes of little-endian uint16, remembering the ids of words.

    Byte-level pre-tokenisation never joins what stands on both sides of a
    single space between two visible characters, nor of a single line end
    between two; a text may be encoded word by word there. Texts with any
    other white space, and those that hold an added token of the vocabulary
    (which has an id of its own wherever it stands), are encoded whole. New words are encoded many at a time, joined by line
    ends, whose id no word's ids contain. The memory is two generations of
    words, so that common ones stay when it is renewed.

    ``ranks`` (a file of the same vocabulary as ranks, and its split pattern)
    lets new words be encoded by the rank-merging library, which gives the
    same ids in a quarter of the time; a few words are compared at the start.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids over 65,535 are not supported")
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        if len(line_end) != 1:
            raise ValueError("the vocabulary has no id for a line end")
        self.line_end = line_end[0]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.merger = None
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            few = ["The", "naïve", "don't", "x1y22", "!!...", "ﬁ漢字", "aeiouaeiou" * 9]
            want = [self._words(few, lead) for lead in (" ", "")]
            self.merger = tiktoken.Encoding(ranks[0], pat_str=ranks[1], mergeable_ranks=table, special_tokens={})
            if want != [self._words(few, lead) for lead in (" ", "")]:
                raise ValueError("the ranks are of another vocabulary")

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of each word with ``lead`` ahead of it; words have no white space and are not empty."""
        out: list[bytes] = []
        joined = ["\n" + "\n".join([lead + w for w in words[i : i + 1000]]) for i in range(0, len(words), 1000)]
        for raw in self._whole(joined) if self.merger is None else (np.array(self.merger.encode_ordinary(t), "<u2").tobytes() for t in joined):
            cut = 2 * np.flatnonzero(np.frombuffer(raw, "<u2") == self.line_end)
            ends = [*cut[1:].tolist(), len(raw)]
            out += [raw[i + 2 : j] for i, j in zip(cut.tolist(), ends, strict=True)]
        return out

    def _learn(self, missing: set[str]) -> None:
        if len(self.known) > _CACHE_WORDS:
            self.known, self.old = {}, self.known
        new = []
        for p in missing:
            ids = self.old.get(p)
            if ids is None:
                new.append(p)
            else:
                self.known[p] = ids
        plain = [p for p in new if p[0] != "\n"]
        self.known.update(zip(plain, self._words(plain, " "), strict=True))
        lines = [p for p in new if p[0] == "\n"]
        first = np.array([self.line_end], "<u2").tobytes()
        self.known.update((p, first + ids) for p, ids in zip(lines, self._words([p[1:] for p in lines], ""), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        get = self.known.get
        plain: list[tuple[list[str], list[bytes | None], list[int]] | None] = []
        heads, odd, missing = [], [], set()
        for t in texts:
            if any(a in t for a in self.added):
                odd.append(t)
                plain.append(None)
                continue
            parts = t.replace("\n", " \n").split(" ")
            head = parts.pop(0)
            got = list(map(get, parts))
            unknown = list(map(not_, got))
            at, lost = list(compress(range(len(got)), unknown)), list(compress(parts, unknown))
            new = set(lost)
            # a first word with white space about it or none before a space, or any other odd white space
            if (parts and not _VISIBLE(head)) or "" in new or "\n" in new or _ODD_SPACE("".join(new)):
                odd.append(t)
                plain.append(None)
            else:
                missing |= new
                heads.append(head)
                plain.append((lost, got, at))
        self._learn(missing)
        get = self.known.get
        whole, first = iter(self._whole(odd)), iter(self._whole(heads))
        out = []
        for found in plain:
            if found is None:
                out.append(next(whole))
                continue
            lost, got, at = found
            for i, ids in zip(at, map(get, lost), strict=True):
                got[i] = ids
            out.append(next(first) + b"".join(got))
        return out


def tokenise(df: DataFrame, key: str, text: str, path: str, ranks: tuple[str, str] | None = None, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """(``key``, n, crcs, tail, tail_crc) of every row: token count with the closing ``end_id``, the crc32 of each
    full window's ids (as little-endian uint32), the ids behind the last full window (uint16) and their crc32.

    Null text is empty text, whose only token is ``end_id``.
    """
    kind = df.schema[key].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, ranks)  # a task's own: a worker that goes on to other work keeps nothing of it
        close = np.array([end_id], "<u2").tobytes()
        for b in batches:
            for lo, hi, raw, off in sub_batches(b.column("t")):
                data = raw.tobytes()
                texts = [data[off[i] : off[i + 1]].decode("utf-8", "replace") for i in range(hi - lo)]
                n, crcs, tails, tail_crcs = [], [], [], []
                for ids in encoder.encode(texts):
                    wide = np.frombuffer(ids + close, "<u2").astype("<u4")
                    full = len(wide) // window
                    n.append(len(wide))
                    crcs.append([zlib.crc32(wide[i * window : (i + 1) * window].tobytes()) for i in range(full)])
                    rest = wide[full * window :]
                    tails.append(rest.astype("<u2").tobytes())
                    tail_crcs.append(zlib.crc32(rest.tobytes()))
                yield pa.RecordBatch.from_arrays([b.column("key").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary()), pa.array(tail_crcs, pa.int64())], ["key", "n", "crcs", "tail", "tail_crc"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(part, f"key {kind}, n long, crcs array<long>, tail binary, tail_crc long").withColumnRenamed("key", key)


# ------------------------------------------------------------------------ plan


def combinations(window: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, that sum to ``window``; a is 0 in pairs."""
    pairs = np.array([(0, a, window - a) for a in range(1, window // 2 + 1)])
    triples = []
    for a in range(1, window // 3 + 1):
        top = (window - a) // 2
        for b in np.unique(np.linspace(a, top, TRIPLE_SPREAD).astype(int)):
            triples.append((a, b, window - a - b))
    return np.vstack([pairs, np.array(triples).reshape(-1, 3)])


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: x >= 0 that brings the lengths used by ``combos`` x times nearest to ``histogram``.

    Accelerated projected gradient with a restart; the matrix has at most
    three ones a column, so a step is a few gathers and one bincount.
    """
    size = len(histogram)
    h = histogram.astype(float).copy()
    h[0] = 0
    used = combos > 0
    limit = np.where(used, h[combos], np.inf).min(1)  # no more than the scarcest length allows
    live = limit > 0
    x = np.zeros(len(combos))
    if not live.any():
        return x
    c, u, top = combos[live], used[live], limit[live]
    degree = np.bincount(c.ravel(), weights=u.ravel().astype(float), minlength=size)
    step = 1 / (3 * max(1.0, degree.max()))
    x_ = np.zeros(len(c))
    y, t = x_.copy(), 1.0
    for _ in range(rounds):
        short = np.bincount(c.ravel(), weights=(u * y[:, None]).ravel(), minlength=size) - h
        new = np.clip(y - step * (short[c] * u).sum(1), 0, top)
        if ((y - new) * (new - x_)).sum() > 0:
            t = 1.0
        t_ = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_ * (new - x_)
        x_, t = new, t_
    x[live] = x_
    return x


def plan(histogram: np.ndarray, window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(slots, sequences): each slot (length, first rank, end rank, first sequence, offset in the sequence).

    Tails of a length, ranked from 0, fall into that length's slots; ranks
    beyond its last slot are left over.
    """
    combos = combinations(window)
    x = repeat_counts(histogram, combos)
    left = histogram.astype(np.int64).copy()
    slots, sequences = [], 0
    taken = np.zeros(len(histogram), np.int64)

    def use(combo: np.ndarray, times: int) -> None:
        nonlocal sequences
        offset = 0
        for length in combo[::-1]:
            if length:
                slots.append((int(length), int(taken[length]), int(taken[length] + times), sequences, offset))
                taken[length] += times
                left[length] -= times
                offset += int(length)
        sequences += times

    def room(combo: np.ndarray) -> int:
        lengths, need = np.unique(combo[combo > 0], return_counts=True)
        return int((left[lengths] // need).min())

    for i in np.argsort(-x, kind="stable"):
        if x[i] < 0.5:
            break
        if times := min(int(round(x[i])), room(combos[i])):
            use(combos[i], times)
    for combo in combos[: window // 2]:  # exact pairs among what rounding left
        if times := room(combo):
            use(combo, times)
    return slots, sequences


def _running(df: DataFrame, value: str, shared: Shared, by: list[str] | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows ahead in the order (``__g``, ``__id``), per ``by``."""
    by = by or []
    totals = df.groupBy(*by, "__g").agg(F.sum(value).alias("__sum"))
    ahead = F.sum("__sum").over(Window.partitionBy(*by).orderBy("__g").rowsBetween(Window.unboundedPreceding, -1))
    ahead = shared.save(totals.select(*by, "__g", F.coalesce(ahead, F.lit(0)).alias("__ahead")), "totals")
    inside = F.sum(value).over(Window.partitionBy(*by, "__g").orderBy("__id").rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(ahead, [*by, "__g"]).withColumn("before", F.col("__inside") + F.col("__ahead")).drop("__inside", "__ahead")


def pack(tokens: DataFrame, key: str, shared: Shared, window: int = WINDOW) -> DataFrame:
    """(``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of every row of ``tokens``.

    ``tokens`` comes from ``tokenise`` with the same ``window`` and is stored
    here. Sequences count from 0 without gaps. Equal rows are packed as
    separate documents; an empty table gives no piece.
    """
    # the id is given once and stored; it tells equal rows apart from then on
    stored = shared.save(tokens.withColumn("__id", F.monotonically_increasing_id()), "tokens")
    rows = stored.select("__id", F.col(key).alias("key"), "n", F.size("crcs").cast("long").alias("full"), "tail_crc", (F.col("n") % window).alias("r"))
    n_docs, n_full = rows.agg(F.count("*"), F.coalesce(F.sum("full"), F.lit(0))).first()
    rows = rows.withColumn("__g", F.pmod(F.xxhash64("__id"), F.lit(max(1, -(-n_docs // GROUP_ROWS)))))
    out_key, kind = F.col("key").alias(key), stored.schema[key].dataType
    start = F.col("n") - F.col("r")

    histogram = np.zeros(window, np.int64)
    for row in rows.where("r > 0").groupBy("r").count().collect():  # one row a length
        histogram[row["r"]] = row["count"]
    slots, n_planned = plan(histogram, window)

    # full windows
    numbered = _running(rows.where("full > 0"), "full", shared).select("__id", "before")
    whole = stored.where(F.size("crcs") > 0).select("__id", F.col(key).alias("key"), "n", "crcs").join(numbered, "__id").select("key", "n", "before", F.posexplode("crcs").alias("i", "crc"))
    whole = whole.select(out_key, (F.col("i") * F.lit(window)).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.lit(n_planned) + F.col("before") + F.col("i")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    # tails: rank within the length, then the length's slots
    ranked = _running(rows.where("r > 0").withColumn("__one", F.lit(1).cast("long")), "__one", shared, ["r"]).withColumnRenamed("before", "rank")
    # at most three slots a combination: a few MB for any input
    table = stored.sparkSession.createDataFrame(slots or [(-1, 0, 0, 0, 0)], "sr long, lo long, hi long, first long, at long")
    fit = (F.col("r") == F.col("sr")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = shared.save(ranked.join(F.broadcast(table), fit, "left"), "placed")
    dealt = placed.where("sr is not null").select(out_key, start.alias("start"), F.col("r").alias("length"), F.col("tail_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), F.col("at").alias("offset"))

    # what is left goes end to end
    left = _running(placed.where("sr is null").select("__id", "key", "n", "r", "tail_crc", "__g"), "r", shared)
    left = shared.save(left.withColumn("room", F.lit(window) - F.col("before") % window), "left")
    first_left = n_planned + n_full
    sequence = F.lit(first_left) + F.floor(F.col("before") / window)
    uncut = left.where("r <= room").select(out_key, start.alias("start"), F.col("r").alias("length"), F.col("tail_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), sequence.cast("long").alias("sequence_id"), (F.col("before") % window).alias("offset"))
    cut = shared.save(left.where("r > room").select("__id", "key", "n", "r", "before", "room"), "cut")
    met = stored.select("__id", "tail").join(cut, "__id")

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            out = {k: [] for k in ("key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for k, n, r, before, room, tail in zip(d["key"], d["n"], d["r"], d["before"], d["room"], d["tail"], strict=True):
                wide = np.frombuffer(tail, "<u2").astype("<u4")
                for lo, hi, seq, at in ((0, room, before // window, before % window), (room, r, before // window + 1, 0)):
                    for name, v in zip(out, (k, n - r + lo, hi - lo, zlib.crc32(wide[lo:hi].tobytes()), n, first_left + seq, at), strict=True):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, b.column("key").type if name == "key" else pa.int64()) for name, v in out.items()], list(out))

    both = met.drop("__id").mapInArrow(halves, f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long").withColumnRenamed("key", key)
    return whole.unionByName(dealt).unionByName(uncut).unionByName(both)
