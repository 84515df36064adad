"""Customer history stored as open versions plus append-only closed versions.

In strict SCD2 mode a closed version never changes again, so a run only needs
the open versions: it reads them, merges the load, and writes the open rows
and the rows it closed into two folders of one write. One commit then names the new open folder and adds the
closed one to those of earlier runs. A run therefore rewrites one row per
customer instead of the whole history, and the history is complete at every
moment: a reader takes one commit, before a run or after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.sources.storage import CommitLog, _read_parts, conform, empty_frame, list_names

#: Closed folders that are gathered into one when a run finds so many.
MAX_CLOSED = 64


class OpenClosedHistory:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = schemas.CUSTOMER_SNAPSHOT, retain: int | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.log = CommitLog(spark, root, retain)

    def _read(self, state: dict, kind: str | None = None) -> DataFrame:
        if not state:
            return empty_frame(self.spark, self.schema)
        return _read_parts(self.spark, self.root, state, [p for p in state["parts"] if kind in (None, p["kind"])])

    def open_versions(self) -> DataFrame:
        return self._read(self.log.latest()[1], "open")

    def apply(self, merged_from_open: Callable[[DataFrame], DataFrame]) -> int:
        """Run one step: ``merged_from_open(open_versions) -> next versions``."""
        base, state = self.log.latest()
        rows = conform(merged_from_open(self._read(state, "open")), self.schema)
        closed = [p for p in state.get("parts", []) if p["kind"] == "closed"]
        if len(closed) >= MAX_CLOSED:
            rows = rows.unionByName(self._read(state, "closed"))
            closed = []
        folder = self.log.new_folder()
        kind = F.when(F.col("end_date").isNull(), F.lit("open")).otherwise(F.lit("closed"))
        rows.withColumn("_kind", kind).write.mode("errorifexists").partitionBy("_kind").parquet(f"{self.root}/{folder}")
        written = [n for n in list_names(self.spark, f"{self.root}/{folder}") if n.startswith("_kind=")]
        new = [{"folder": f"{folder}/{n}", "kind": n.partition("=")[2]} for n in sorted(written)]
        return self.log.publish(base, {"schema": self.schema.jsonValue(), "parts": closed + new})

    def read(self) -> DataFrame:
        """The whole history: closed versions and the current open ones."""
        return self._read(self.log.latest()[1])
