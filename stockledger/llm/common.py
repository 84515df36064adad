"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockledger.session import shared_dir

SUB_BATCH_BYTES = 1 << 19
#: Bytes of a batch that Spark hands to Python, about. A batch is held several times over, in the executor's buffers
#: and in each worker, so Spark's own limit (64 MB) takes GBs of an executor where rows are wide.
BATCH_BYTES = "4m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_MUL = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a context, as Spark does with any ``--py-files``.

    Bounds the session's Arrow batches by ``BATCH_BYTES``, unless it names a limit of its own.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    sc = spark.sparkContext
    if getattr(sc, "_stockledger_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="stockledger-")), "stockledger_modules.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(target)
    sc._stockledger_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table; the path may lie in any store that Spark reads."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


class Shared:
    """Intermediate tables in the cluster's shared folder (``spark.checkpoint.dir``).

    A stored table cuts lineage, survives lost executors, is not computed
    twice, and tells the planner its size, so later joins are chosen from bytes.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        ship(spark)
        self.spark = spark
        self.root = shared_dir(spark, purpose)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(self.root, f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers (16 bytes or so) that may be broadcast: some tens of MB an executor.
BROADCAST_ROWS = 500_000


def if_small(narrow: DataFrame, rows: int = BROADCAST_ROWS, held: str | None = None) -> DataFrame:
    """``narrow`` marked for broadcast if a count finds at most ``rows`` rows, else left to Spark's own choice.

    For stored tables of a few numeric columns, whose bytes the row count
    bounds; where a row holds an array, ``held`` names it and its entries are
    counted too. The join's result is the same either way.
    """
    n = F.count("*") + (F.coalesce(F.sum(F.size(held)), F.lit(0)) if held else F.lit(0))
    return F.broadcast(narrow) if narrow.agg(n).first()[0] <= rows else narrow


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; the labelled folds are set by it."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def sample_key(doc_id: str | Column) -> Column:
    """A pseudo-random but repeatable order of rows, for bounded samples."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.xxhash64(c.cast("string"))


# ---------------------------------------------------------------- text in tasks


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column without making Python strings; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def sub_batches(column: pa.Array, limit: int = SUB_BATCH_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes: (first row, end row, bytes, offsets).

    Bounds the memory of vectorised work; a longer row makes a run of its own.
    """
    raw, off = utf8(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, for work that makes Python objects of them."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240517)).integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * _MUL
    return h ^ (h >> np.uint64(32))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 4096), 0x5851F42D4C957F2D, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of rows, A-Z lower-cased.

    start, end: byte positions; row: the word's row; hash: 64 bits of its
    bytes; first: the first word of each row (length rows + 1).
    """

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        self.low = _LOWER[raw]
        space = _SPACE[raw]
        word = ~space
        begins = word.copy()
        if len(raw):
            begins[1:] &= space[:-1]
        inner = off[:-1][(np.diff(off) > 0)]
        begins[inner] = word[inner]  # rows meet without a space between
        self.start = np.flatnonzero(begins)
        stops = np.zeros(len(raw) + 1, bool)
        stops[1:] = word
        if len(raw):
            stops[1:-1] &= space[1:] | begins[1:]
        self.end = np.flatnonzero(stops)
        self.row = np.searchsorted(off, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, off)
        self._word = word

    @property
    def hash(self) -> np.ndarray:
        if not hasattr(self, "_hash"):
            self._hash = self.prefix_hash(None)
        return self._hash

    def prefix_hash(self, k: int | None) -> np.ndarray:
        """Hash of each word's first ``k`` bytes (all of them for None)."""
        n = len(self.start)
        if not n:
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        if k is not None:
            length = np.minimum(length, k)
        total = int(length.sum())
        lead = np.cumsum(length) - length
        within = np.arange(total) - np.repeat(lead, length)
        at = np.repeat(self.start, length) + within
        value = _BYTE[self.low[at]] * _powers(int(length.max()))[within]
        return mix(np.add.reduceat(value, lead) + length.astype(np.uint64))

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(hash, row) of each ``k``-word shingle; a row of fewer words, but not none, has one shingle of all."""
        h, n = self.hash, len(self.start)
        sums = np.zeros(n, np.uint64)
        factor = np.cumprod(np.full(k, 0x2545F4914F6CDD1D, np.uint64), dtype=np.uint64)
        for i in range(min(k, n)):
            sums[: n - i] += h[i:] * factor[i]
        counts = np.diff(self.first)
        valid = np.zeros(n, bool)
        if n >= k:
            valid[: n - k + 1] = self.row[: n - k + 1] == self.row[k - 1 :]
        values, rows = mix(sums[valid]), self.row[valid]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            own = np.zeros(len(short), np.uint64)
            for j, r in enumerate(short):
                own[j] = self.sequence_hash(h[self.first[r] : self.first[r + 1]], 77)
            values, rows = np.concatenate([values, own]), np.concatenate([rows, short])
            order = np.argsort(rows, kind="stable")
            values, rows = values[order], rows[order]
        return values, rows

    @staticmethod
    def sequence_hash(h: np.ndarray, seed: int) -> np.uint64:
        """Hash of a sequence of word hashes."""
        f = np.cumprod(np.full(len(h), 0x2545F4914F6CDD1D + 2 * seed, np.uint64), dtype=np.uint64)
        return mix(np.array([(h * f).sum(dtype=np.uint64) + np.uint64(len(h) * 1000003 + seed)], np.uint64))[0]


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


# ---------------------------------------------------------------- components


#: Edges that a task of a round of ``components`` takes: rounds are many, and their tasks follow the edges, not the session's partitions.
EDGES_A_TASK = 200_000


def components(edges: DataFrame, shared: Shared, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component), component = least node.

    Alternating large-star and small-star rounds over the edge list, each a
    join and partial aggregates, so no star is gathered in one task; rounds are
    stored in the shared folder and read by a task for every ``EDGES_A_TASK``
    edges, so few edges take few tasks and files. Nodes may be of any orderable type. Null nodes
    and self-loops are ignored; repeated edges count once. Stops when a round
    changes nothing (the star form); rounds grow with the logarithm of the
    longest path.
    """

    def stored(df: DataFrame) -> DataFrame:
        kept = shared.save(df, "edges")
        return kept.coalesce(max(1, -(-kept.count() // EDGES_A_TASK)))

    def ends(e: DataFrame, *ways: Column) -> DataFrame:
        return e.select(F.explode(F.array(*ways)).alias("s")).select("s.*")

    u, v = F.col("u"), F.col("v")
    e = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = stored(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    for _ in range(max_rounds):
        least = ends(e, F.struct(u, v), F.struct(v.alias("u"), u.alias("v"))).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: each larger neighbour of u is joined to the least of u's neighbourhood
        large = e.select(v.alias("u"), u.alias("v")).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are joined to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(ends(large.join(low, "u"), F.struct(u, F.col("m").alias("v")), F.struct(v.alias("u"), F.col("m").alias("v"))).where("u != v").distinct())
        # stars: each u has one v, and no v is a u
        roles = ends(e, F.struct(u.alias("node"), F.lit(1).alias("left"), F.lit(0).alias("right")), F.struct(v.alias("node"), F.lit(0).alias("left"), F.lit(1).alias("right")))
        if roles.groupBy("node").agg(F.sum("left").alias("left"), F.max("right").alias("right")).where("left > 1 or (left = 1 and right = 1)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(u.alias("node"), v.alias("component")).union(e.select(v.alias("node"), v.alias("component")).distinct())


# ---------------------------------------------------------------- distributed order


def number(df: DataFrame, order: list[Column], shared: Shared, name: str, rows_a_part: int = 500_000) -> DataFrame:
    """``df`` stored with ``n``: the row's place, from 0 without gaps, in the given order.

    Rows are dealt to ranges of the whole key, so however many share its first
    columns no task gets more than its part; the ranges' sizes (a row a range)
    are summed up to offsets. The order must be total but for rows that are alike.
    """
    kept = shared.save(df, f"{name}-rows")
    parts = max(1, -(-kept.count() // rows_a_part))
    dealt = kept.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = shared.save(dealt, f"{name}-order").withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = shared.save(sizes.select("__part", before.alias("__before")), f"{name}-offsets")
    n = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return placed.join(offsets, "__part").select(*[F.col(f"`{c}`") for c in df.columns], n.alias("n"))
