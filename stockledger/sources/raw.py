"""Raw fact tables that grow by drops and are kept in coarse ranges of days.

A drop is appended as one commit. Its files lie in folders ``_drop=<id>/_range=<day
div width>``, which Spark reads as partition columns: a literal day bound prunes
folders when the scan is planned, and a join with a set of ranges that is only
known at run time prunes them by dynamic partition pruning.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.sources.storage import CommitLog, conform, empty_frame

DROP, RANGE = "_drop", "_range"


class RawTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, day_col: str, width: int = 32, retain: int | None = None):
        self.spark, self.root, self.schema, self.day_col, self.width = spark, root.rstrip("/"), schema, day_col, width
        self.log = CommitLog(spark, root, retain)

    def _range_of(self, day: Column) -> Column:
        return F.floor(day / self.width).cast("int")

    def append(self, drop: DataFrame) -> int:
        """Add the rows of ``drop``; one shuffle by range, in which AQE splits a large one. Null days have a folder of their own."""
        base, state = self.log.latest()
        folder = f"data/{DROP}={uuid.uuid4().hex[:16]}"
        rows = conform(drop, self.schema).withColumn(RANGE, self._range_of(F.col(self.day_col))).hint("rebalance", RANGE)
        rows.sortWithinPartitions(RANGE, self.day_col).write.partitionBy(RANGE).parquet(f"{self.root}/{folder}")
        return self.log.publish(base, {"schema": self.schema.jsonValue(), "parts": [*state.get("parts", []), {"folder": folder}]})

    def _scan(self) -> DataFrame:
        parts = self.log.latest()[1].get("parts", [])
        whole = T.StructType([*self.schema.fields, T.StructField(DROP, T.StringType()), T.StructField(RANGE, T.IntegerType())])
        if not parts:
            return empty_frame(self.spark, whole)
        return self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/{p['folder']}" for p in parts])

    def read(self, since: int | None = None) -> DataFrame:
        """All rows, or those of days from ``since`` on: folders of older ranges are not opened."""
        rows = self._scan()
        if since is not None:
            rows = rows.where((F.col(RANGE) >= since // self.width) & (F.col(self.day_col) >= since))
        return rows.select(*self.schema.names)

    def read_days(self, days: DataFrame, column: str) -> DataFrame:
        """The rows whose day is among ``days``.

        The scan is also joined with the days' ranges, so Spark opens only the
        folders of those ranges, found at run time.
        """
        wanted = days.select(F.col(column).alias("_day")).distinct()
        ranges = wanted.select(self._range_of(F.col("_day")).alias("_wanted")).distinct()
        rows = self._scan()
        rows = rows.join(ranges, rows[RANGE] == ranges["_wanted"], "left_semi")
        return rows.join(wanted, rows[self.day_col] == wanted["_day"], "left_semi").select(*self.schema.names)
