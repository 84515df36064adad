"""Stored tables on a shared file system, without a transactional table format.

Every write puts its files into a folder of its own (``data/<id>``) and then
publishes them with one small commit file, ``_commits/<n>``, whose JSON names
the folders that make up the table. The commit is written under a temporary
name and renamed, so it is there whole or not at all, and a job that dies at
any point leaves files that nothing names. A reader takes the newest commit, so
it sees the table before a write or after it. A commit that cannot be read (a
copy or an upload cut short) counts as not published: readers take the one
before it and the next write goes on from there under a number above it.

A writer states the commit it started from and fails if another one is there
by the time it publishes. The rename never replaces a commit; that is atomic on
HDFS, while on local disks and object stores, which check and then rename, a
table needs one writer at a time, as scheduled jobs are.

* :class:`VersionedTable` - each write replaces the whole table.
* :class:`SlicedTable` - keyed by an integer slice (sold day or sold week) and
  stored in coarser folders; a write drops one slice and appends a batch.
* :func:`sql_view` - the newest commit under a name for Spark SQL.

Paths go through Hadoop's file system API, so they work on HDFS, object
stores and local disks alike.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ConcurrentWrite(RuntimeError):
    """Another writer has published since this one read the table."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not exist yet, whole or not at all."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(temp, p, rename)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "AlreadyExists" in str(e.java_exception):
            raise ConcurrentWrite(path) from e
        raise


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` by column name (INSERT INTO t (cols) SELECT ...)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Temporarily override SQL settings (for looking at plans, and for the write of the daily job as SQL)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class CommitLog:
    """The published states of a table, numbered from 1.

    ``retain``: commits kept readable; older ones are removed together with
    the folders that only they name (a query still reading such an old state
    would fail, so keep more than a query's runtime spans). None keeps all.
    """

    def __init__(self, spark: SparkSession, root: str, retain: int | None = None):
        if retain is not None and retain < 1:
            raise ValueError("retain must be at least 1")
        self.spark, self.root, self.retain = spark, root.rstrip("/"), retain

    def _path(self, n: int) -> str:
        return f"{self.root}/_commits/{n:08d}"

    def numbers(self) -> list[int]:
        return sorted(int(x) for x in list_names(self.spark, f"{self.root}/_commits") if x.isdigit())

    def state(self, n: int) -> dict:
        """What commit ``n`` says; empty if it cannot be read."""
        try:
            state = json.loads(_read_text(self.spark, self._path(n)))
        except ValueError:
            return {}
        return state if isinstance(state, dict) and "parts" in state else {}

    def latest(self) -> tuple[int, dict]:
        """(number, state) of the newest commit that can be read; (0, {}) before the first."""
        for n in reversed(self.numbers()):
            if state := self.state(n):
                return n, state
        return 0, {}

    def new_folder(self) -> str:
        """A folder for a write's files, relative to the table's root."""
        return f"data/{uuid.uuid4().hex[:16]}"

    def publish(self, base: int, state: dict) -> int:
        """Make ``state`` the table's content if ``base`` is still the newest commit."""
        newest = self.latest()[0]
        if newest != base:
            raise ConcurrentWrite(f"{self.root}: commit {newest} was published after {base}")
        n = max([base, *self.numbers()]) + 1  # above what cannot be read
        _create_text(self.spark, self._path(n), json.dumps(state))
        if self.retain is not None:
            self._expire(n)
        return n

    def _expire(self, newest: int) -> None:
        old = [n for n in self.numbers() if n < newest][: 1 - self.retain or None]
        if not old:
            return
        named = {f for n in self.numbers() if n not in old for f in folders(self.state(n))}
        gone = {f for n in old for f in folders(self.state(n))} - named
        for n in old:
            delete_path(self.spark, self._path(n))
        for f in sorted(gone):
            delete_path(self.spark, f"{self.root}/{f}")


def folders(state: dict) -> list[str]:
    """The data folders that a state names."""
    return [part["folder"] for part in state.get("parts", [])]


def _read_parts(spark: SparkSession, root: str, state: dict, parts: list[dict] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    paths = [f"{root}/{p['folder']}" for p in (state["parts"] if parts is None else parts)]
    return spark.read.schema(schema).parquet(*paths) if paths else empty_frame(spark, schema)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a stored table, or of a plain Parquet path.

    The one way to read an input whose writer is not known: a folder with
    published commits is read through the newest one, anything else as Parquet.
    """
    log = CommitLog(spark, path)
    if path_exists(spark, f"{log.root}/_commits"):
        n, state = log.latest()
        if not n:
            raise ValueError(f"{path}: the table's first write is not finished")
        return _read_parts(spark, log.root, state)
    return spark.read.parquet(path)


def sql_view(spark: SparkSession, name: str, root: str, temporary: bool = True) -> None:
    """``CREATE OR REPLACE VIEW name`` over the folders that the newest commit names.

    The view stands for that state; run it again after a write to move it on. A
    view that is not temporary lies in the session's catalog, where others find it.
    """
    _, state = CommitLog(spark, root).latest()
    if not state:
        raise ValueError(f"{root}: no published state")
    schema = T.StructType.fromJson(state["schema"])
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    parts = [f"SELECT {columns} FROM parquet.`{root.rstrip('/')}/{p}`" for p in folders(state)]
    text = " UNION ALL ".join(parts) or f"SELECT {nulls} WHERE false"
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {name} AS {text}")


class VersionedTable:
    """A table whose every write replaces it; older versions stay readable until retired."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, retain: int | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.log = CommitLog(spark, root, retain)

    def versions(self) -> list[int]:
        return self.log.numbers()

    def current_version(self) -> int | None:
        return self.log.latest()[0] or None

    def read(self, version: int | None = None) -> DataFrame:
        state = self.log.latest()[1] if version is None else self.log.state(version)
        return _read_parts(self.spark, self.root, state) if state else empty_frame(self.spark, self.schema)

    def write(self, df: DataFrame, base: int | None = None) -> int:
        """Publish ``df`` as the next version and return its number.

        ``base``: the version that ``df`` was computed from (default: the
        current one). Fails with :class:`ConcurrentWrite` if another was published since.
        """
        if base is None:
            base = self.log.latest()[0]
        folder = self.log.new_folder()
        conform(df, self.schema).write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        return self.log.publish(base, {"schema": self.schema.jsonValue(), "parts": [{"folder": folder}]})

    def truncate(self) -> int:
        """``TRUNCATE TABLE``: a new, empty version (schema kept)."""
        return self.log.publish(self.log.latest()[0], {"schema": self.schema.jsonValue(), "parts": []})


class SlicedTable:
    """A table keyed by one integer slice, changed by "drop a slice, append a batch".

    Slices are stored as a column in folders of ``width`` consecutive slices,
    so a daily table of years has tens of files, not thousands. The commit
    lists the folders and the newest slice (the watermark), so a run plans
    from one small file; a pruned read lists only the folders it needs.
    """

    #: Folders one range of slices may have before a write merges them.
    MAX_PARTS = 8

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        slice_col: str,
        cluster_by: tuple[str, ...] = (),
        width: int = 32,
        retain: int | None = None,
    ):
        self.spark, self.root, self.schema, self.slice_col = spark, root.rstrip("/"), schema, slice_col
        self.cluster_by, self.width = cluster_by, width
        self.log = CommitLog(spark, root, retain)

    def exists(self) -> bool:
        return self.log.latest()[0] > 0

    def read(self, min_slice: int | None = None) -> DataFrame:
        """The table, or only its slices ``>= min_slice`` (older folders are not opened)."""
        _, state = self.log.latest()
        if not state:
            return empty_frame(self.spark, self.schema)
        if min_slice is None:
            return _read_parts(self.spark, self.root, state)
        parts = [p for p in state["parts"] if p["bucket"] >= min_slice // self.width]
        return _read_parts(self.spark, self.root, state, parts).where(F.col(self.slice_col) >= F.lit(min_slice))

    def slices(self) -> list[int]:
        """The distinct slices (one row a slice)."""
        return sorted(r[0] for r in self.read().select(self.slice_col).distinct().collect())

    def last_slice(self) -> int | None:
        """``SELECT MAX(slice)``: the watermark, as the newest commit states it."""
        return self.log.latest()[1].get("last")

    def replace_slice(self, dropped: int | None, batch: DataFrame | None) -> int:
        """``DELETE WHERE slice = dropped``, then ``INSERT`` the batch: one commit.

        Rows of other slices stay, also where the batch adds to their slice.
        The folders that hold the dropped slice are written again without it,
        together with the batch's rows of that range and with ranges that have gathered many folders; all other
        folders are kept as they are. Nothing is removed before the new state is
        published, and a run that dies leaves the table unchanged. NULL slices are not stored.

        ``rebalance`` on the range puts each range in one shuffle partition
        and lets AQE split an oversized one over several writers. Rows are
        sorted by slice and ``cluster_by``, so Parquet min/max statistics let
        filters on those columns skip row groups.
        """
        base, state = self.log.latest()
        parts = state.get("parts", [])
        held: dict[int, int] = {}
        for p in parts:
            held[p["bucket"]] = held.get(p["bucket"], 0) + 1
        redone = {b for b, n in held.items() if n >= self.MAX_PARTS}
        if dropped is not None:
            redone.add(dropped // self.width)
        kept = [p for p in parts if p["bucket"] not in redone]
        old = [p for p in parts if p["bucket"] in redone]
        rows = empty_frame(self.spark, self.schema) if batch is None else conform(batch, self.schema)
        rows = rows.where(F.col(self.slice_col).isNotNull())
        if old:
            again = _read_parts(self.spark, self.root, state, old)
            if dropped is not None:
                again = again.where(F.col(self.slice_col) != F.lit(dropped))
            rows = again.unionByName(rows)
        folder = self.log.new_folder()
        out = rows.withColumn("_range", F.floor(F.col(self.slice_col) / self.width).cast("long")).hint("rebalance", "_range")
        out = out.sortWithinPartitions("_range", self.slice_col, *self.cluster_by)
        out.write.mode("errorifexists").partitionBy("_range").parquet(f"{self.root}/{folder}")
        new = [
            {"folder": f"{folder}/{name}", "bucket": int(name.partition("=")[2])}
            for name in sorted(list_names(self.spark, f"{self.root}/{folder}"))
            if name.startswith("_range=")
        ]
        parts = kept + new
        after = {"schema": self.schema.jsonValue(), "parts": parts, "last": None}
        if parts:
            newest = max(p["bucket"] for p in parts)
            newest = [p for p in parts if p["bucket"] == newest]
            after["last"] = _read_parts(self.spark, self.root, after, newest).agg(F.max(self.slice_col)).first()[0]
        return self.log.publish(base, after)


def copy_table(spark: SparkSession, src: DataFrame, dst: str, retain: int | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE dst CLONE src`` as a full copy; returns the copy.

    A failed copy leaves the previous one."""
    table = VersionedTable(spark, dst, src.schema, retain)
    table.write(src)
    return table.read()
