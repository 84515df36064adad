"""N-gram Jaccard self-join of documents, exact, as components.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two
documents link when 100 * |A and B| >= 75 * |A or B|. The steps:

1. Equal sets collapse to their least document.
2. Prefix lists. Under any fixed order of shingles, two sets that link share
   a shingle among each one's first ``n - ceil(0.75 n) + 1``. The order is by
   hash, with shingles that many documents share put last, so that lists stay
   short; which shingles these are changes the cost, never the result.
3. Tiles. Sharers of a list whose sizes and positions allow a link are paired,
   first with the list's most central document only. Pairs go to size-banded tiles, where
   hashed bitmap signatures bound the overlap from above by bit counts; what
   passes is settled by intersecting the sorted arrays.
4. The links found give components. Where a list still spans several, it tries
   further leaders, and then all pairs across its components are settled in the
   same way, so no link between components is lost; pairs inside one component
   need no test.

Shingles travel in blobs, one per batch and hash bucket, so the shuffle moves
5 to 16 bytes an entry and no rows of its own; the number of buckets grows
with the input. Signatures are kept for documents that share a list, and
sets go only to the tiles that need them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, Words, as_long, components, if_small, mix, slices, sub_batches

SHINGLE = 5
PERCENT = 75
#: Part of the hash range whose shingles are counted to find common ones.
COUNTED = 0.30
#: A shingle is common when so many documents hold it; the commonest so many are put last (a broadcast of 8 bytes each).
COMMON, MOST_COMMON = 48, 100_000
BUCKET_ENTRIES = 400_000
#: Further leaders that a list may try before its pairs across components are compared.
LEADERS = 4
#: Sets in a tile of exact tests, and members of a list in a tile of bit counts, about.
TILE_SETS, TILE_MEMBERS = 400, 2048


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def band(n: np.ndarray) -> np.ndarray:
    """Size band: sets that link lie in one band or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / PERCENT)).astype(np.int64)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingles one row after another, row offsets)."""
    for lo, hi, raw, off in sub_batches(column):
        values, rows = Words(raw, off).shingles(k)
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        values, rows = values[new], rows[new]
        yield lo, hi, values, np.searchsorted(rows, np.arange(hi - lo + 1))


def _digests(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(key, n, d1, d2): the size and two hashes of each document's set."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, values, off in _sets(b.column("t"), k):
                n = np.diff(off)
                spread = values * np.uint64(0x9E3779B97F4A7C15) ^ (values >> np.uint64(31))
                filled = n > 0
                at = off[:-1][filled]
                d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(at):
                    d1[filled], d2[filled] = np.add.reduceat(spread, at), np.add.reduceat(spread * (spread | np.uint64(1)), at)
                yield pa.RecordBatch.from_arrays([b.column("key").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(as_long(d1)), pa.array(as_long(d2))], ["key", "n", "d1", "d2"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(part, f"key {kind}, n long, d1 long, d2 long")


def _split(bucket: np.ndarray, n_buckets: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows (bucket, one blob a column) of the entries of each bucket."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    found = np.flatnonzero(np.diff(cut))
    blobs = [[c[order[cut[i] : cut[i + 1]]].tobytes() for i in found] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), *(pa.array(x, pa.binary()) for x in blobs)], ["bucket", *(f"c{i}" for i in range(len(columns)))])


def _blobs(t: pa.Table, *kinds: type) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(t.column(f"c{i}").to_pylist()), d) for i, d in enumerate(kinds)]


def _common(df: DataFrame, text: str, k: int, n_buckets: int) -> np.ndarray:
    """Sorted top halves of the hashes of the commonest low shingles.

    Half a hash is enough: any function of a shingle may set the order.
    """
    top = np.uint32(int(COUNTED * 2**32))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, values, _ in _sets(b.column("t"), k):
                half = (values >> np.uint64(32)).astype(np.uint32)
                low, times = np.unique(half[half < top], return_counts=True)
                yield _split((low % np.uint32(n_buckets)).astype(np.int32), n_buckets, low, np.minimum(times, 255).astype(np.uint8))

    def count(t: pa.Table) -> pa.Table:
        h, c = _blobs(t, np.uint32, np.uint8)
        order = np.argsort(h)
        h, c = h[order], c[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        total = np.add.reduceat(c, first)
        keep = total >= COMMON
        return pa.table({"h": h[first][keep].astype(np.int64), "n": total[keep]})

    blobs = df.select(F.col(text).alias("t")).mapInArrow(part, "bucket int, c0 binary, c1 binary")
    rows = blobs.groupBy("bucket").applyInArrow(count, "h long, n long").orderBy(F.desc("n"), "h").limit(MOST_COMMON).collect()
    return np.sort(np.array([r.h for r in rows], np.uint32))


def _lists(df: DataFrame, key: str, text: str, k: int, percent: int, common: np.ndarray, n_buckets: int) -> DataFrame:
    """(list, key, n, pos): sharers of a prefix shingle, lists of two or more; ``pos``: how many of the document's
    shingles come before it. Equal lists come once a bucket, with the least positions."""
    common_ = df.sparkSession.sparkContext.broadcast(common)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = common_.value
        for b in batches:
            keys = b.column("key").cast(pa.int64()).to_numpy(zero_copy_only=False)
            for lo, _, values, off in _sets(b.column("t"), k):
                n = np.diff(off)
                rows = np.repeat(np.arange(len(n)), n)
                if len(common):
                    half = (values >> np.uint64(32)).astype(np.uint32)
                    at = np.minimum(np.searchsorted(common, half), len(common) - 1)
                    values = values[np.lexsort((values, common[at] == half, rows))]
                pos = np.arange(len(values)) - off[rows]
                take = pos < prefix_length(n, percent)[rows]
                values, rows, pos = values[take], rows[take], pos[take].astype(np.int32)
                # the bucket and half a hash name a shingle; the rare collision only adds a pair to test
                yield _split((values % np.uint64(n_buckets)).astype(np.int32), n_buckets, (values >> np.uint64(32)).astype(np.uint32), keys[lo + rows], n[rows].astype(np.int32), pos)

    def meet(t: pa.Table) -> pa.Table:
        h, own, size, pos = _blobs(t, np.uint32, np.int64, np.int32, np.int32)
        order = np.lexsort((own, h))
        h, own, size, pos = h[order], own[order], size[order], pos[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        length = np.diff(np.append(first, len(h)))
        shared = np.repeat(length > 1, length)
        own, size, pos, length = own[shared], size[shared], pos[shared], length[length > 1]
        if not len(length):
            return pa.table({"list": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "n": pa.array([], pa.int32()), "pos": pa.array([], pa.int32())})
        mixed = mix(own.view(np.uint64) + np.uint64(0x632BE59BD9B4E019) * size.astype(np.uint64))
        name = np.repeat(mix(np.add.reduceat(mixed, np.cumsum(length) - length) + length.astype(np.uint64)), length)
        order = np.lexsort((size, own, name))
        name, own, size, pos = name[order], own[order], size[order], pos[order]
        once = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (own[1:] != own[:-1]) | (size[1:] != size[:-1])]))
        return pa.table({"list": as_long(name[once]), "key": own[once], "n": size[once], "pos": np.minimum.reduceat(pos, once)})

    blobs = df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(part, "bucket int, c0 binary, c1 binary, c2 binary, c3 binary")
    return blobs.groupBy("bucket").applyInArrow(meet, "list long, key long, n int, pos int")


# --------------------------------------------------------------------- verifying


def bitmap(values: np.ndarray, per: int = 4) -> bytes:
    """Hashed bits of a set: ``per`` bits an element or up to twice as many, 64 to 65,536 of them."""
    bits = 64
    while bits < per * len(values) and bits < 65_536:
        bits *= 2
    on = np.zeros(bits, np.uint8)
    on[((values >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(on, bitorder="little").tobytes()


def overlap_bound(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """No less than the true overlap: every bit that one set has alone stands for an element of its own."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    both = int(np.bitwise_count(x & y).sum())
    return min(n_a - int(np.bitwise_count(x).sum()) + both, n_b - int(np.bitwise_count(y).sum()) + both)


def links(overlap: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def _signatures(df: DataFrame, key: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(key, n, bits) of the documents in ``wanted(key)``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, values, off in _sets(b.column("t"), k):
                bits = [bitmap(values[off[i] : off[i + 1]]) for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column("key").slice(lo, hi - lo), pa.array(np.diff(off), pa.int64()), pa.array(bits, pa.binary())], ["key", "n", "bits"])

    texts = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t"))
    return texts.join(if_small(wanted), "key", "left_semi").mapInArrow(part, "key long, n long, bits binary")


def _compare(t: pa.Table, percent: int) -> pa.Table:
    """Pairs of a tile's members that may link, each once: in one list, in different components, by position, size and bit counts.

    Members are compared by the width of their bitmaps: the ones of a width with
    each other and with those of the next widths that a similar size can have,
    folded to it. A small set in the list does not blunt the bits of large ones.
    """
    lists, key, n, pos, comp, i, j, block = (t.column(c).to_numpy() for c in ("list", "key", "n", "pos", "component", "i", "j", "block"))
    bits = t.column("bits").to_pylist()
    bytes_ = np.array([len(x) for x in bits])
    order = np.lexsort((key, bytes_, j, i, lists))
    edge = np.flatnonzero(np.concatenate([[True], (lists[order][1:] != lists[order][:-1]) | (i[order][1:] != i[order][:-1]) | (j[order][1:] != j[order][:-1])]))
    wider = 2 ** int(np.ceil(np.log2(100 / percent)))
    out_a, out_b, out_n, out_m = [], [], [], []
    for g in np.split(order, edge[1:]):
        within = i[g[0]] == j[g[0]]
        for width in np.unique(bytes_[g]):
            members = g[(bytes_[g] >= width) & (bytes_[g] <= width * wider)]  # by width: the ones of this width come first
            own_width = int((bytes_[members] == width).sum())
            if len(members) < 2:
                continue
            folded = np.stack([np.bitwise_or.reduce(np.frombuffer(bits[x], np.uint64).reshape(-1, width // 8), axis=0) for x in members])
            ones = np.bitwise_count(folded).sum(1).astype(np.int64)
            size, rest, c, own, blk = n[members].astype(np.int64), (n[members] - pos[members]).astype(np.int64), comp[members], key[members], block[members]
            for r in range(min(own_width, len(members) - 1)):
                s = np.arange(r + 1, len(members))
                ok = (c[s] != c[r]) & (np.minimum(rest[s], rest[r]) * (100 + percent) >= percent * (size[s] + size[r])) & (own[s] != own[r])
                s = s[ok if within else ok & (blk[s] != blk[r])]
                if len(s):
                    both = np.bitwise_count(folded[s] & folded[r]).sum(1).astype(np.int64)
                    most = np.minimum(np.minimum(size[r] - ones[r], size[s] - ones[s]) + both, np.minimum(size[r], size[s]))
                    s = s[100 * most >= percent * (size[r] + size[s] - most)]
                    first = own[r] < own[s]
                    out_a.append(np.where(first, own[r], own[s]))
                    out_b.append(np.where(first, own[s], own[r]))
                    out_n.append(np.where(first, size[r], size[s]))
                    out_m.append(np.where(first, size[s], size[r]))
    join = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
    pairs = np.unique(np.stack([join(out_a), join(out_b), join(out_n), join(out_m)]), axis=1)
    return pa.table({"a": pairs[0], "b": pairs[1], "n_a": pairs[2]})


def split_lists(lists: DataFrame, groups: DataFrame, shared: Shared) -> DataFrame:
    """The rows of ``lists(list, key, n, pos)`` whose list spans several components, with their ``component``."""
    marked = lists.select("list", "key", "n", "pos").join(groups.toDF("key", "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    marked = shared.save(marked, "marked")
    several = marked.groupBy("list").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("list")
    return shared.save(marked.join(several, "list", "left_semi"), "spans")


def further_leaders(lists: DataFrame, found: DataFrame, groups: DataFrame, settle: Callable[[DataFrame], DataFrame], enough: str, shared: Shared) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, components, rows of the lists that still span several components).

    Every such list takes ``LEADERS`` further leaders at once (the members of least
    hash, under as many hashes), and only the members outside a leader's component
    are tested with it, so the members of a large group of near copies that the first
    leader missed are joined by a few rows a member, before all pairs across
    components are looked at. Which links are found here changes the cost, never
    the components.
    """
    spans = split_lists(lists, groups, shared)
    places = [F.struct(F.xxhash64("key", F.lit(r)).alias("at"), "key", "n", "pos", "component") for r in range(LEADERS)]
    leaders = spans.groupBy("list").agg(F.array(*(F.min(p) for p in places)).alias("fs")).select("list", F.explode("fs").alias("f"))
    leaders = leaders.select("list", F.col("f.key").alias("a"), F.col("f.n").alias("n_a"), F.col("f.pos").alias("pos_a"), F.col("f.component").alias("own"))
    pairs = shared.save(spans.join(leaders, "list").where("component != own").where(enough).select("a", F.col("key").alias("b")).distinct(), "leader-pairs")
    new = settle(pairs)
    if not new.isEmpty():
        found = found.union(new)
        groups = components(found, shared)
        spans = split_lists(spans, groups, shared)
    return found, groups, spans


def across(spans: DataFrame, signatures: DataFrame, percent: int, shared: Shared) -> DataFrame:
    """(a, b, n_a): pairs across components, from ``spans(list, key, n, pos, component)``.

    A list's members are compared inside tiles, by vectors of bit counts, so only what passes
    becomes a row. A long list is cut into blocks and each two blocks meet in a tile of their own;
    short lists share tiles.
    """
    counts = spans.groupBy("list").agg(F.ceil(F.count("*") / F.lit(TILE_MEMBERS)).alias("blocks"))
    rows = spans.join(signatures.select("key", F.col("n").cast("int").alias("n"), "bits"), ["key", "n"]).join(counts, "list")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "n"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    n_tiles = max(1, -(-spans.count() // TILE_MEMBERS))
    tile = F.when(F.col("blocks") > 1, F.col("list")).otherwise(F.pmod(F.xxhash64("list"), F.lit(n_tiles)))
    tiles = rows.withColumn("tile", tile).drop("other", "blocks")
    return shared.save(tiles.groupBy("tile", "i", "j").applyInArrow(lambda t: _compare(t, percent), "a long, b long, n_a long").distinct(), "across")


def _bounded(pairs: DataFrame, signatures: DataFrame, percent: int, shared: Shared) -> DataFrame:
    """(a, b, n_a) of the pairs that may link by their sizes and bit counts."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            d = b.to_pydict()
            ok = [links(min(overlap_bound(x, n, y, m), n, m), n, m, percent) for x, n, y, m in zip(d["bits_a"], d["n_a"], d["bits_b"], d["n_b"], strict=True)]
            yield b.select(["a", "b", "n_a"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(signatures.toDF("a", "n_a", "bits_a"), "a").join(signatures.toDF("b", "n_b", "bits_b"), "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return shared.save(both.mapInArrow(bound, "a long, b long, n_a long").distinct(), "passed")


def _settled(passed: DataFrame, df: DataFrame, key: str, text: str, k: int, percent: int, shared: Shared) -> DataFrame:
    """The (a, b) of ``passed`` that link, by intersecting their sorted sets in tiles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, values, off in _sets(b.column("t"), k):
                own = [values[off[i] : off[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in ("tile", "a", "key", "first")), pa.array(own, pa.binary())], ["tile", "a", "key", "first", "set"])

    def settle(t: pa.Table) -> pa.Table:
        own: dict[int, list[np.ndarray]] = {}
        asked = []
        for a, key, is_first, s in zip(*(t.column(c).to_pylist() for c in ("a", "key", "first", "set")), strict=True):
            (own.setdefault(a, []) if is_first else asked).append(np.frombuffer(s, np.uint64) if is_first else (a, key, np.frombuffer(s, np.uint64)))
        out = [(a, key) for a, key, s in asked if any(links(len(np.intersect1d(s, f, assume_unique=True)), len(s), len(f), percent) for f in own[a])]
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    # tiles: by the size band of the pair's first set; a first set with many partners is split over tiles
    partners = passed.groupBy("a").agg(F.count("*").alias("partners"))
    n_tiles = max(1, -(-2 * passed.count() // TILE_SETS))
    part_of = F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / TILE_SETS))
    size_band = F.floor(F.log(F.greatest(F.col("n_a"), F.lit(1))) / F.lit(float(np.log(100 / percent)))) if percent < 100 else F.col("n_a")
    tiled = passed.join(partners, "a").withColumn("part", part_of).withColumn("tile", F.pmod(F.xxhash64(size_band, "a", "part"), F.lit(n_tiles)))
    rows = tiled.select("tile", "a", F.col("a").alias("key"), F.lit(True).alias("first")).distinct().union(tiled.select("tile", "a", F.col("b").alias("key"), F.lit(False)))
    asked = if_small(shared.save(rows, "tiles"))
    texts = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).join(asked, "key")
    tiles = texts.mapInArrow(sets, "tile long, a long, key long, first boolean, set binary")
    return shared.save(tiles.groupBy("tile").applyInArrow(settle, "a long, b long").distinct(), "links")


def join(df: DataFrame, key: str, text: str, shared: Shared, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """(``key``, n_shingles, component_id) for every row of ``df``.

    ``key`` is a whole number that names the document. Words are
    ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a text of fewer than ``k`` words is one
    shingle; null, empty or blank text has no shingle and links with nothing.
    Equal rows get equal results; rows of one key with different texts count
    as one document with all their links. Null keys are never linked and get
    a null component. Other columns are not read.
    """
    n_docs = df.count()
    n_buckets = max(8, -(-n_docs * 160 // BUCKET_ENTRIES))
    docs = shared.save(_digests(df, key, text, k), "digests")
    common = _common(df, text, k, n_buckets)
    classes = shared.save(docs.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("first is not null"), "classes")
    copies = docs.where("n > 0").join(classes.where("copies > 1"), ["n", "d1", "d2"]).where("key != first or key is null").select(F.col("key").alias(key)).distinct()
    own = df.select(key, text).where(F.col(key).isNotNull()).join(if_small(shared.save(copies, "copies")), key, "left_anti")
    lists = shared.save(_lists(own, key, text, k, percent, common, n_buckets).groupBy("list", "key", "n").agg(F.min("pos").alias("pos")), "lists")

    # in the list of the first shingle that two sets share, all they share lies at or behind its position in
    # either: the overlap has that bound, and a pair that fails it in every list cannot link
    enough = f"least(n_a - pos_a, n - pos) * {100 + percent} >= {percent} * (n_a + n)"
    # a list's first partner is the one with most lists: of near copies, the one that differs least from the rest
    degree = lists.groupBy("key").agg(F.count("*").alias("degree"))
    best = F.struct("degree", (-F.col("key")).alias("low"), "key", "n", "pos")
    leader = lists.join(degree, "key").groupBy("list").agg(F.max(best).alias("f")).select("list", F.col("f.key").alias("a"), F.col("f.n").alias("n_a"), F.col("f.pos").alias("pos_a"))
    near = shared.save(lists.join(leader, "list").where("a != key").where(enough).select("a", F.col("key").alias("b")).distinct(), "pairs")
    wanted = shared.save(lists.select("key").distinct(), "wanted")
    signatures = shared.save(_signatures(own, key, text, k, wanted), "signatures")
    found = _settled(_bounded(near, signatures, percent, shared), own, key, text, k, percent, shared)
    groups = components(found, shared)

    # lists that span several components: further leaders, then every pair across them
    def settle(pairs: DataFrame) -> DataFrame:
        return _settled(_bounded(pairs, signatures, percent, shared), own, key, text, k, percent, shared)

    found, groups, spans = further_leaders(lists, found, groups, settle, enough, shared)
    missed = across(spans, signatures, percent, shared)
    if missed.take(1):
        found = found.union(_settled(missed, own, key, text, k, percent, shared))
        groups = components(found, shared)
    placed = docs.join(classes, ["n", "d1", "d2"], "left").join(groups.toDF("first", "component"), "first", "left")
    own_id = F.when(F.col("key").isNotNull(), F.coalesce("component", "first", "key"))
    return placed.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own_id.alias("component_id"))


def oracle(k: int = SHINGLE, percent: int = PERCENT) -> str:
    """DuckDB SQL of ``join`` over ``documents``, from the definitions."""
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {k - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - {k - 1}) + 1)) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= {percent} * (x.n + y.n - o)),
    r(d, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.d),
    m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.d = w.doc_id
    """
