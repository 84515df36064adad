"""Reading the input tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy access to ``<root>/<name>.parquet`` tables.

    Nothing is read until a plan runs; each access returns a new scan so that
    Catalyst prunes columns and pushes filters per query.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)
