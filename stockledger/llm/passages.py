"""Substring deduplication by paragraph MinHash banding.

A text's units are its lines of at least ``min_words`` words, runs of shorter
lines merged to as many (:func:`lines`), and blocks of ``BLOCK`` words that begin at content-defined words (a word pair whose hash is the least within
``REACH`` words on both sides), which lie alike in a shared passage wherever it
stands. A line's signature is banded MinHash of its 5-word shingles; a block
is too short to survive an edit, so its one band is the hash of all its words.

Units that collide in a band are joined with the band's least unit; colliding
lines that differ are verified by exact Jaccard similarity, and verified
links form components. Lines that collide and are still in different components
are then all compared, by bit counts in tiles of bounded size first, and what
passes exactly. Of each component (and of each set of equal blocks) the
first unit in the order (key, place) stays and the others are marked. The words
behind a marked block up to the next are marked if their hash agrees too; at
the ends of a run, words are compared one by one with those around the first
occurrence. Touching spans are merged, and spans of at least ``min_words`` words
are cut out. Shorter repeats, such as headings and licence lines, are left alone.

``BANDS`` bands of ``ROWS`` rows find lines of similarity 0.75 with probability
1 - (1 - 0.75 ** 3) ** 16 = 0.9998, and let lines of 0.25 collide with 0.22, of
0.1 with 0.016. A shared passage of 51 words holds no whole block with
probability 0.0004 (simulated), one of 60 words practically never.

The texts are scanned once for signatures (a few numbers a unit, stored), once
more where words around a unit are needed, and once to cut. Counts of a
signature are partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, Words, as_long, components, if_small, mix, slices, sub_batches
from .ngram_join import across, bitmap, further_leaders

MIN_WORDS = 50
PERCENT = 75
REACH, BLOCK = 6, 12
#: Words without a content-defined one after which a block begins all the same.
LONGEST_GAP = 32
#: Words around a first occurrence with which the ends of a run are compared.
AROUND = 40
BANDS, ROWS = 16, 3
SHINGLE = 5
_SEED = np.array([0x9E3779B97F4A7C15 * (2 * j + 1) % 2**64 for j in range(BANDS * ROWS)], np.uint64)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def blocks(w: Words) -> np.ndarray:
    """First word of every block, over all rows: content-defined words and a row's first word
    (and every ``LONGEST_GAP`` words behind one, where the text repeats itself), if ``BLOCK`` words follow in the row."""
    h, row, n = w.hash, w.row, len(w.start)
    if not n:
        return np.zeros(0, np.int64)
    pair = h.copy()
    pair[:-1] += mix(h[1:] ^ _STEP) * (row[1:] == row[:-1])
    least = np.ones(n, bool)
    for d in range(1, REACH + 1):
        if n > d:
            same = row[d:] == row[:-d]
            less = pair[d:] < pair[:-d]
            least[d:] &= less | ~same
            least[:-d] &= (~less & (pair[d:] != pair[:-d])) | ~same
    least[w.first[:-1][np.diff(w.first) > 0]] = True
    begin = np.flatnonzero(least)
    gap = np.diff(np.append(begin, n))
    if (gap > LONGEST_GAP).any():
        extra = [np.arange(b + LONGEST_GAP, b + k, LONGEST_GAP) for b, k in zip(begin[gap > LONGEST_GAP], gap[gap > LONGEST_GAP], strict=True)]
        begin = np.sort(np.concatenate([begin, *extra]))
    return begin[begin + BLOCK <= w.first[row[begin] + 1]]


def gaps(w: Words, begin: np.ndarray) -> np.ndarray:
    """Hash of the words between each block's end and the next block of its row; 0 where they touch or none follows."""
    out = np.zeros(len(begin), np.uint64)
    if len(begin) > 1:
        open_ = np.flatnonzero((w.row[begin[1:]] == w.row[begin[:-1]]) & (begin[1:] > begin[:-1] + BLOCK))
        out[open_] = _sequence_hashes(w.hash, begin[open_] + BLOCK, begin[open_ + 1])
        near = np.flatnonzero((w.row[begin[1:]] == w.row[begin[:-1]]) & (begin[1:] <= begin[:-1] + BLOCK))
        out[near] = (begin[near + 1] - begin[near]).astype(np.uint64)
    return out


def _sequence_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the word hashes of each [begin, end); the spans are not empty."""
    length = end - begin
    lead = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(lead, length)
    powers = np.cumprod(np.full(int(length.max()) if len(length) else 1, _STEP), dtype=np.uint64)
    return mix(np.add.reduceat(h[np.repeat(begin, length) + within] * powers[within], lead) + length.astype(np.uint64)) if len(length) else np.zeros(0, np.uint64)


def lines(w: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end word) of the paragraphs, in order.

    A line of at least ``min_words`` words is one. Shorter lines that follow each
    other without a blank line are merged: a paragraph ends where it has
    ``min_words`` words and the next line begins with a content-defined word, or at
    twice as many, if ``min_words`` words are left behind it. Runs of short lines
    that have fewer words in all make none.
    """
    n = len(w.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, times = np.unique(np.searchsorted(w.start, np.flatnonzero(w.raw == 10)), return_counts=True)
    begin = np.unique(np.concatenate([w.first[:-1], at]))
    begin = begin[begin < n]
    end = np.append(begin[1:], n)
    long = end - begin >= min_words
    first, last = [begin[long]], [end[long]]
    short = np.flatnonzero(~long)
    if len(short):
        apart = np.isin(begin[short], np.concatenate([w.first[:-1], at[times > 1]]))
        apart[0] = True
        apart[1:] |= short[1:] != short[:-1] + 1
        run = np.flatnonzero(apart)
        stop = np.append(run[1:], len(short))
        close = end[short[stop - 1]]
        for i in np.flatnonzero(close - begin[short[run]] >= min_words).tolist():
            ends = end[short[run[i] : stop[i]]]
            x, y = int(begin[short[run[i]]]), int(close[i])
            for e, odd in zip(ends.tolist(), (w.hash[np.minimum(ends, n - 1)] & np.uint64(1)).tolist()):
                if e == y or (e - x >= min_words and y - e >= min_words and (odd or e - x >= 2 * min_words)):
                    first.append(np.array([x]))
                    last.append(np.array([e]))
                    x = e
    first, last = np.concatenate(first), np.concatenate(last)
    order = np.argsort(first, kind="stable")
    return first[order].astype(np.int64), last[order].astype(np.int64)


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of the ``SHINGLE``-word shingles of one span (all of it if shorter)."""
    k = min(SHINGLE, len(h))
    factor = np.cumprod(np.full(k, _STEP), dtype=np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out += h[i : len(h) - k + 1 + i] * factor[i]
    return mix(out)


def band_values(h: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the ``ROWS`` minima of each of the ``BANDS`` bands, a row for each span [first, end) of the word hashes ``h``.

    The shingles of all spans lie end to end in one array, so each of the minima
    is taken for all spans at once.
    """
    if not len(first):
        return np.zeros((0, BANDS), np.uint64)
    factor = np.cumprod(np.full(max(SHINGLE, ROWS), _STEP), dtype=np.uint64)
    whole = np.zeros(len(h), np.uint64)
    for i in range(min(SHINGLE, len(h))):
        whole[: len(h) - i] += h[i:] * factor[i]
    length = end - first
    count = np.maximum(length - SHINGLE + 1, 1)
    lead = np.cumsum(count) - count
    shingles = mix(whole[np.arange(int(count.sum())) + np.repeat(first - lead, count)])
    for i in np.flatnonzero(length < SHINGLE).tolist():
        shingles[lead[i]] = shingle_hashes(h[first[i] : end[i]])[0]
    out = np.zeros((BANDS, len(first)), np.uint64)
    for j, seed in enumerate(_SEED):
        out[j // ROWS] += np.minimum.reduceat((shingles ^ seed) * _STEP, lead) * factor[j % ROWS]
    return mix(out).T


#: What names a text: its row's key, and a hash of the text itself, which tells rows of one key apart.
TEXT = ["key", "h"]


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, h, t) of the rows with a key; equal rows are one text."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t"))


def _signatures(texts: DataFrame, min_words: int) -> DataFrame:
    """(key, h, blocks, gaps, lines, line_bands): hashes of blocks, gaps and lines in order; ``BANDS`` band values a line."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in sub_batches(b.column("t")):
                w = Words(raw, off)
                rows = np.arange(hi - lo + 1)
                begin = blocks(w)
                block_off = pa.array(np.searchsorted(w.row[begin], rows), pa.int32())
                first, end = lines(w, min_words)
                line = _sequence_hashes(w.hash, first, end)
                bands = band_values(w.hash, first, end)
                line_off = np.searchsorted(w.row[first], rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c).slice(lo, hi - lo) for c in TEXT),
                        pa.ListArray.from_arrays(block_off, pa.array(as_long(_sequence_hashes(w.hash, begin, begin + BLOCK)))),
                        pa.ListArray.from_arrays(block_off, pa.array(as_long(gaps(w, begin)))),
                        pa.ListArray.from_arrays(pa.array(line_off, pa.int32()), pa.array(as_long(line))),
                        pa.ListArray.from_arrays(pa.array(line_off * BANDS, pa.int32()), pa.array(as_long(bands.ravel()))),
                    ],
                    [*TEXT, "blocks", "gaps", "lines", "line_bands"],
                )

    return texts.mapInArrow(part, "key long, h long, blocks array<long>, gaps array<long>, lines array<long>, line_bands array<long>")


def _line_sets(texts: DataFrame, min_words: int, wanted: DataFrame) -> DataFrame:
    """(line, set): sorted shingle hashes of the lines ``wanted(key, h, line)``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column("line").to_numpy()
            for lo, hi, raw, off in sub_batches(b.column("t")):
                w = Words(raw, off)
                first, end = lines(w, min_words)
                name = as_long(_sequence_hashes(w.hash, first, end))
                chosen = np.flatnonzero(name == asked[lo:hi][w.row[first]])
                out = [(int(name[i]), np.unique(shingle_hashes(w.hash[first[i] : end[i]])).tobytes()) for i in chosen]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["line", "set"])

    return texts.join(if_small(wanted), TEXT).select("t", "line").mapInArrow(part, "line long, set binary").dropDuplicates(["line"])


def _across_components(spans: DataFrame, sets: DataFrame, percent: int, shared: Shared) -> DataFrame:
    """(a, b): lines of one bucket in different components that may be similar, from ``spans(list, key, component)``."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = [np.frombuffer(x, np.uint64) for x in b.column("set").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("line"), pa.array([len(x) for x in own], pa.int64()), pa.array([bitmap(x, 8) for x in own], pa.binary())], ["key", "n", "bits"])

    wanted = spans.select(F.col("key").alias("line")).distinct()
    signatures = shared.save(sets.join(wanted, "line", "left_semi").select("line", "set").mapInArrow(bits, "key long, n long, bits binary"), "line-bits")
    # similar sets have sizes of one band or of two neighbours; each line stands in its own and the next, so they meet
    # (the bands are a little wider than the ratio, for rounding)
    size_band = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)) + 1e-6)) if percent < 100 else F.col("n")
    sized = spans.drop("n", "pos").join(signatures.select("key", F.col("n").cast("int").alias("n")), "key").withColumn("band", F.explode(F.array(size_band, size_band + 1)))
    sized = shared.save(sized.select(F.xxhash64("list", "band").alias("list"), "key", "n", F.lit(0).alias("pos"), "component"), "sized-buckets")
    return across(sized, signatures, percent, shared).select("a", "b")


def _marked_lines(sig: DataFrame, texts: DataFrame, min_words: int, percent: int, shared: Shared) -> DataFrame:
    """(key, h, at): lines that repeat an earlier one."""
    own = sig.select(*TEXT, "line_bands", F.posexplode("lines").alias("at", "line"))
    own = own.select(*TEXT, "at", "line", F.slice("line_bands", F.col("at") * BANDS + 1, BANDS).alias("bands"))
    distinct = shared.save(own.groupBy("line").agg(F.min(F.struct(*TEXT, "at")).alias("first"), F.count_distinct(*TEXT, "at").alias("n"), F.min("bands").alias("bands")), "distinct-lines")
    band = distinct.select("line", F.posexplode("bands").alias("band", "value"))
    least = band.groupBy("band", "value").agg(F.min("line").alias("least"), F.max("line").alias("most")).where("least != most").drop("most")
    met = shared.save(band.join(least, ["band", "value"]).select(F.xxhash64("band", "value").alias("list"), "line", "least"), "line-buckets")
    pairs = shared.save(met.where("line != least").select(F.col("least").alias("a"), F.col("line").alias("b")).distinct(), "line-pairs")
    asked = pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct().join(distinct, "line").select("first.key", "first.h", "line")
    sets = shared.save(_line_sets(texts, min_words, shared.save(asked, "asked")), "line-sets")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ok = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def settled(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
        return shared.save(both.mapInArrow(settle, "a long, b long"), "line-links")

    found = settled(pairs)
    groups = components(found, shared)
    lists = met.select("list", F.col("line").alias("key"), F.lit(0).alias("n"), F.lit(0).alias("pos"))
    found, groups, spans_ = further_leaders(lists, found, groups, settled, "true", shared)
    missed = _across_components(spans_, sets, percent, shared)
    if missed.take(1):
        groups = components(found.union(settled(missed)), shared)
    groups = groups.toDF("line", "component")
    named = distinct.join(groups, "line", "left").select("line", "first", "n", F.coalesce("component", "line").alias("component"))
    named = shared.save(named, "named-lines")
    whole = named.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    dup = shared.save(named.select("line", "component").join(whole, "component").select("line", "keep"), "repeated-lines")
    return own.select(*TEXT, "at", "line").join(dup, "line").where(F.struct(*TEXT, "at") != F.col("keep")).select(*TEXT, "at")


def _marked_blocks(sig: DataFrame, shared: Shared) -> DataFrame:
    """(key, h, at, on, keep_key, keep_h, keep_at): blocks that repeat an earlier one, the first one of them, and
    whether the words up to the next block are the same (``on``)."""
    own = sig.select(*TEXT, F.posexplode(F.arrays_zip("blocks", "gaps")).alias("at", "x")).select(*TEXT, "at", F.col("x.blocks").alias("block"), F.col("x.gaps").alias("gap"))
    place = F.struct(*TEXT, "at", "gap")
    dup = own.groupBy("block").agg(F.min(place).alias("keep"), F.max(place).alias("last")).where("keep != last").drop("last")
    dup = shared.save(dup, "repeated-blocks")
    later = own.join(dup, "block").where(place != F.col("keep"))
    return later.select(*TEXT, "at", ((F.col("gap") != 0) & (F.col("gap") == F.col("keep.gap"))).alias("on"), *(F.col(f"keep.{c}").alias(f"keep_{c}") for c in (*TEXT, "at")))


def _half(h: np.ndarray) -> bytes:
    return (h >> np.uint64(32)).astype(np.uint32).tobytes()


def _around(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(keep_key, keep_h, keep_at, side, words): half hashes of the ``AROUND`` words ahead of (side -1) or behind (1)
    the blocks ``wanted(key, h, array of (at, side))``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked, key, h = b.column("asked").to_pylist(), b.column("key").to_pylist(), b.column("h").to_pylist()
            for lo, hi, raw, off in sub_batches(b.column("t")):
                w = Words(raw, off)
                begin = blocks(w)
                cut = np.searchsorted(w.row[begin], np.arange(hi - lo + 1))
                out = []
                for r in range(hi - lo):
                    for q in asked[lo + r]:
                        x = int(begin[cut[r] + q["at"]])
                        ends = (max(int(w.first[r]), x - AROUND), x) if q["side"] < 0 else (x + BLOCK, min(int(w.first[r + 1]), x + BLOCK + AROUND))
                        out.append((key[lo + r], h[lo + r], q["at"], q["side"], _half(w.hash[ends[0] : ends[1]])))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], ["keep_key", "keep_h", "keep_at", "side", "words"])

    rows = texts.join(if_small(wanted, held="asked"), TEXT)
    return rows.mapInArrow(part, "keep_key long, keep_h long, keep_at int, side int, words binary").dropDuplicates(["keep_key", "keep_h", "keep_at", "side"])


def spans(w: Words, r: int, begin: np.ndarray, own_lines: tuple[np.ndarray, np.ndarray], marks: dict[int, bool], marked_lines: list[int], grow: dict[tuple[int, int], bytes], min_words: int) -> list[tuple[int, int]]:
    """Word spans [from, to) of row ``r`` to cut, counted from the row's first word.

    ``begin``: first words of the row's blocks; ``marks``: marked blocks, and
    whether the words up to the next block are repeated too; ``grow``: half
    hashes of the words around the first occurrence, by (block, side).
    """
    first, last = int(w.first[r]), int(w.first[r + 1])
    marked = np.zeros(last - first, bool)
    for i in marked_lines:
        marked[own_lines[0][i] - first : own_lines[1][i] - first] = True
    half = (w.hash[first:last] >> np.uint64(32)).astype(np.uint32)
    for m, on in marks.items():
        x = int(begin[m]) - first
        end = x + BLOCK
        marked[x:end] = True
        if on and m + 1 < len(begin):
            marked[x : begin[m + 1] - first] = True
        if (other := grow.get((m, -1))) is not None:
            other = np.frombuffer(other, np.uint32)
            k = min(x, len(other))
            differ = half[x - k : x][::-1] != other[len(other) - k :][::-1]
            marked[x - (int(np.argmax(differ)) if differ.any() else k) : x] = True
        if (other := grow.get((m, 1))) is not None:
            other = np.frombuffer(other, np.uint32)
            k = min(len(half) - end, len(other))
            differ = half[end : end + k] != other[:k]
            marked[end : end + (int(np.argmax(differ)) if differ.any() else k)] = True
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    found = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
    return [(a, b) for a, b in found if b - a >= min_words]


def deduplicate(df: DataFrame, key: str, text: str, shared: Shared, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """All rows of ``df`` with repeated passages cut out of ``text``, and n_words, n_removed (words) and
    spans (array of (from, to), word positions) added; columns of these names are replaced.

    ``key`` is a whole number that names the row. A passage stays in the row of
    least key (and at its first place there). Null text stays null; a text of
    which all is repeated becomes empty. Equal rows of one key are one text and
    are cut alike; rows of one key with different texts are ordered by a hash
    of the text. Rows of null keys are left as they are. An empty table gives an empty table.
    """
    kept = df.drop(*[c for c in ("n_words", "n_removed", "spans") if c not in (key, text)])
    texts = _texts(df, key, text)
    sig = shared.save(_signatures(texts, min_words), "signatures")
    marked = shared.save(_marked_blocks(sig, shared).distinct(), "marked-blocks")
    in_lines = shared.save(_marked_lines(sig, texts, min_words, percent, shared).groupBy(*TEXT).agg(F.sort_array(F.collect_set("at")).alias("marked_lines")), "marked-lines")

    # the ends of runs of marked blocks may grow into the words around them
    marks = marked.groupBy(*TEXT).agg(F.collect_list(F.struct("at", "on")).alias("marks"))
    along = Window.partitionBy(*TEXT).orderBy("at")
    runs = marked.withColumn("prev", F.lag(F.struct("at", "on")).over(along)).withColumn("next", F.lead("at").over(along))
    joined_before = F.coalesce((F.col("prev.at") == F.col("at") - 1) & F.col("prev.on"), F.lit(False))
    joined_after = F.col("on") & F.coalesce(F.col("next") == F.col("at") + 1, F.lit(False))
    sides = F.array_compact(F.array(F.when(~joined_before, F.lit(-1)), F.when(~joined_after, F.lit(1))))
    near = ["keep_key", "keep_h", "keep_at", "side"]
    ends = shared.save(runs.select(*TEXT, "at", "keep_key", "keep_h", "keep_at", F.explode(sides).alias("side")), "ends")
    wanted = ends.select(*near).distinct().groupBy(F.col("keep_key").alias("key"), F.col("keep_h").alias("h")).agg(F.collect_list(F.struct(F.col("keep_at").alias("at"), "side")).alias("asked"))
    words = shared.save(_around(texts, shared.save(wanted, "wanted")), "around")
    grown = ends.join(words, near).groupBy(*TEXT).agg(F.collect_list(F.struct("at", "side", "words")).alias("grow"))
    info = marks.join(grown, TEXT, "left").join(in_lines, TEXT, "full")
    info = shared.save(info.withColumnsRenamed({"key": "__k", "h": "__h", "marks": "__marks", "grow": "__grow", "marked_lines": "__lines"}), "cuts")

    met = kept.withColumn("__k", F.col(key).cast("long")).withColumn("__h", F.xxhash64(F.col(text))).join(info, ["__k", "__h"], "left").drop("__k", "__h")
    return _cut(met, kept.columns, text, min_words)


def _cut(met: DataFrame, names: list[str], text: str, min_words: int) -> DataFrame:
    schema = ", ".join([*(f"`{c}` {met.schema[c].dataType.simpleString()}" for c in names), "n_words long, n_removed long, spans array<struct<`from`:int,`to`:int>>"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks, grow, in_lines = (b.column(c).to_pylist() for c in ("__marks", "__grow", "__lines"))
            missing = b.column(text).is_null().to_numpy(zero_copy_only=False)
            for lo, hi, raw, off in sub_batches(b.column(text)):
                w = Words(raw, off)
                begin = blocks(w) if any(marks[lo + r] for r in range(hi - lo)) else np.zeros(0, np.int64)
                cut = np.searchsorted(w.row[begin], np.arange(hi - lo + 1))
                first, end = lines(w, min_words)
                line_cut = np.searchsorted(w.row[first], np.arange(hi - lo + 1))
                data = raw.tobytes()
                texts, removed, found = [], [], []
                for r in range(hi - lo):
                    own = data[off[r] : off[r + 1]]
                    out: list[tuple[int, int]] = []
                    if marks[lo + r] or in_lines[lo + r]:
                        around = {(g["at"], g["side"]): g["words"] for g in grow[lo + r] or ()}
                        chosen = {m["at"]: m["on"] for m in marks[lo + r] or ()}
                        mine = (first[line_cut[r] : line_cut[r + 1]], end[line_cut[r] : line_cut[r + 1]])
                        out = spans(w, r, begin[cut[r] : cut[r + 1]], mine, chosen, in_lines[lo + r] or [], around, min_words)
                    if out:
                        a = int(w.first[r])
                        n = int(w.first[r + 1]) - a
                        parts, at = [], 0
                        for x, y in out:
                            parts.append(own[at : w.start[a + x] - off[r]])
                            at = int(w.start[a + y] - off[r]) if y < n else len(own)
                        parts.append(own[at:])
                        own = b"".join(parts).rstrip() if out[-1][1] == n else b"".join(parts)
                    texts.append(None if missing[lo + r] else own.decode("utf-8", "replace"))
                    removed.append(sum(y - x for x, y in out))
                    found.append([{"from": x, "to": y} for x, y in out])
                own = [pa.array(texts, pa.string()) if c == text else b.column(c).slice(lo, hi - lo) for c in names]
                kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(w.first).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(found, kind)], [*names, "n_words", "n_removed", "spans"])

    return met.select(*[F.col(f"`{c}`") for c in names], "__marks", "__grow", "__lines").mapInArrow(part, schema)
