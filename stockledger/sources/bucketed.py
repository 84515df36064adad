"""Customer history in buckets of the customer key: a run moves the load, never the history.

A load is staged once, bucketed on ``c_customer_sk`` (one shuffle of the load,
a row a customer). The history lies in the same number of buckets, so the
unique check, the insert merge and the close merge find their rows bucket by
bucket: none of them shuffles or broadcasts stored rows. The result is written
back by the tasks that merged it, one bucket a task.

A run adds at most one row a customer, so buckets stay even: no customer can hold
more rows than there were runs.

In literal mode a run reads and writes the whole history, as closed versions may
change again. In strict mode they cannot: a run reads and writes the open
versions alone, and the versions that it closes lie in a folder that later runs
only name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.operators import customers
from stockledger.sources.storage import CommitLog, _read_parts, conform, delete_path, empty_frame, list_names

#: Rows of the first load that one bucket takes.
ROWS_PER_BUCKET = 500_000
#: Closed folders that are gathered into one when a run finds so many.
MAX_CLOSED = 64


def write_buckets(df: DataFrame, path: str, key: str, n: int, partition: str | None = None) -> None:
    """Parquet files at ``path``, hashed by ``key`` into ``n`` buckets; no table stays in the catalog."""
    spark, name = df.sparkSession, f"stockledger_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(n, key).sortBy(key).option("path", path)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table's files stay


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, key: str, n: int) -> DataFrame:
    """The rows that :func:`write_buckets` left at ``path``; Spark knows that they are bucketed."""
    name = f"stockledger_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)


class BucketedHistory:
    """A customer history whose runs are one commit each; ``strict`` as in :func:`customers.scd2_merge`."""

    def __init__(self, spark: SparkSession, root: str, strict: bool = False, buckets: int | None = None, retain: int | None = None):
        self.spark, self.root, self.strict, self.buckets = spark, root.rstrip("/"), strict, buckets
        self.schema, self.log = schemas.CUSTOMER_SNAPSHOT, CommitLog(spark, root, retain)

    def _live(self, state: dict) -> DataFrame:
        """The rows that a run may change: all of them, or the open ones in strict mode."""
        live = [p for p in state.get("parts", []) if p["kind"] != "closed"]
        if not live:
            return empty_frame(self.spark, self.schema)
        return read_buckets(self.spark, f"{self.root}/{live[0]['folder']}", self.schema, customers.KEY, state["buckets"])

    def stage(self, load: DataFrame) -> tuple[DataFrame, int, str]:
        """(the load in buckets, their number, its folder)."""
        _, state = self.log.latest()
        n = state.get("buckets") or self.buckets or max(8, -(-load.count() // ROWS_PER_BUCKET))
        path = f"{self.root}/loads/{uuid.uuid4().hex[:16]}"
        write_buckets(conform(load, schemas.CUSTOMER).repartition(n, customers.KEY), path, customers.KEY, n)
        return read_buckets(self.spark, path, schemas.CUSTOMER, customers.KEY, n), n, path

    def plan(self, staged: DataFrame, run_date: str) -> DataFrame:
        """The rows that replace what :meth:`_live` holds, and those that are closed for good."""
        return customers.scd2_merge_in_buckets(self._live(self.log.latest()[1]), staged, run_date, strict=self.strict)

    def run(self, load: DataFrame, run_date: str) -> int:
        """Apply one load. Two rows for one customer are refused (strict: unless they are alike)."""
        base, state = self.log.latest()
        staged, n, path = self.stage(load)
        if self.strict:
            staged = staged.dropDuplicates()
        customers.assert_unique_key(staged)
        rows = conform(self.plan(staged, run_date), self.schema)
        closed = [p for p in state.get("parts", []) if p["kind"] == "closed"]
        if len(closed) >= MAX_CLOSED:
            rows = rows.unionByName(_read_parts(self.spark, self.root, state, closed))
            closed = []
        kind = F.when(F.col("end_date").isNull(), F.lit("open")).otherwise(F.lit("closed")) if self.strict else F.lit("all")
        folder = self.log.new_folder()
        write_buckets(rows.withColumn("_kind", kind), f"{self.root}/{folder}", customers.KEY, n, "_kind")
        names = sorted(x for x in list_names(self.spark, f"{self.root}/{folder}") if x.startswith("_kind="))
        parts = closed + [{"folder": f"{folder}/{x}", "kind": x.partition("=")[2]} for x in names]
        done = self.log.publish(base, {"schema": self.schema.jsonValue(), "parts": parts, "buckets": n})
        delete_path(self.spark, path)
        return done

    def open_versions(self) -> DataFrame:
        return customers.current_versions(self._live(self.log.latest()[1]))

    def read(self) -> DataFrame:
        """The whole history: closed and open versions."""
        _, state = self.log.latest()
        return _read_parts(self.spark, self.root, state) if state else empty_frame(self.spark, self.schema)
