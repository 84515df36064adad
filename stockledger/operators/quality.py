"""Data-quality checks: each returns the offending rows; ``verdict`` turns them
into the one-row pass/fail answer (``count(*) = 0``).

All checks are distributed: the failing rows are found by filters, a grouped
count or an anti-join, and the verdict is a global count (partial counts per
partition, one tiny final merge). Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# The warehouse keys the weekly fact accepts.
ACCEPTED_WAREHOUSES = (1, 2, 3, 4, 5, 6)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (``GROUP BY key HAVING count(*) > 1``)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose ``column`` has no match in ``parent`` (a NULL key has none).

    The source writes ``LEFT JOIN ... WHERE parent_key IS NULL``; ``left_anti``
    is the same result without materialising the joined rows. Spark broadcasts
    the parent when its size is under the threshold and sort-merges otherwise.
    """
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    return df.join(keys, df[column] == keys["_parent_key"], "left_anti")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows where ``column NOT IN (values)``; a NULL is neither in nor out, so passes."""
    return df.where(~F.col(column).isin(list(values)))


def orphan_key(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows with a non-NULL ``column`` that has no match in ``parent``."""
    return relationship(df.where(F.col(column).isNotNull()), column, parent, parent_column)


def verdict(failing: DataFrame, check_name: str) -> DataFrame:
    """``SELECT count(*) = 0``: one row with the check name, failing count and verdict."""
    return failing.agg(F.count(F.lit(1)).alias("n_failing")).select(
        F.lit(check_name).alias("check_name"),
        F.col("n_failing"),
        (F.col("n_failing") == 0).alias("passed"),
    )


def verdicts(*checks: tuple[str, DataFrame]) -> DataFrame:
    """Several verdicts as one frame."""
    out = None
    for name, failing in checks:
        v = verdict(failing, name)
        out = v if out is None else out.unionByName(v)
    return out


class Watch:
    """Checks whose failing rows are counted by the job that writes the table.

    ``frame()`` is the table with the checks as metrics of its plan
    (``DataFrame.observe``); once it has been written, ``verdicts()`` has their
    counts without a second scan. Metrics are taken in the stage that writes,
    where Spark counts each task once.
    """

    def __init__(self, df: DataFrame):
        self._df, self._columns, self._failing = df, df.columns, {}
        self._seen = Observation()

    def _add(self, name: str, failing: Column) -> Watch:
        flag = f"_check_{len(self._failing)}"
        self._df = self._df.withColumn(flag, failing)
        self._failing[name] = flag
        return self

    def not_null(self, name: str, column: str) -> Watch:
        return self._add(name, F.col(column).isNull())

    def accepted_values(self, name: str, column: str, values: Iterable) -> Watch:
        return self._add(name, ~F.col(column).isin(list(values)))

    def relationship(self, name: str, column: str, parent: DataFrame, parent_column: str) -> Watch:
        """One left join with the parent's distinct keys; a null key has no parent."""
        key = f"_parent_{len(self._failing)}"
        keys = parent.select(F.col(parent_column).alias(key)).where(F.col(key).isNotNull()).distinct()
        self._df = self._df.join(keys, F.col(column) == F.col(key), "left")
        return self._add(name, F.col(key).isNull())

    def unique(self, name: str, columns: Sequence[str]) -> Watch:
        """Counts key values that occur more than once, by their second rows.

        For tables aggregated by (nearly) these columns, whose rows lie by key
        already; for raw tables, where one key may hold many rows, use :func:`unique`.
        """
        return self._add(name, F.row_number().over(Window.partitionBy(*columns).orderBy(columns[0])) == 2)

    def frame(self) -> DataFrame:
        counts = [F.count_if(F.col(flag)).alias(flag) for flag in self._failing.values()]
        return self._df.observe(self._seen, *counts).select(*self._columns)

    def verdicts(self) -> DataFrame:
        """As :func:`verdicts`, from the metrics of the write (call it after the write)."""
        found = self._seen.get
        rows = [(name, found[flag], found[flag] == 0) for name, flag in self._failing.items()]
        return self._df.sparkSession.createDataFrame(rows, "check_name string, n_failing bigint, passed boolean")
