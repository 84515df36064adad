"""Scheduled jobs: explicit inputs, run dates and watermarks; any scheduler can call them.

Each job does at most one small eager step (reading a watermark or a version
number), then builds one lazy plan and writes it. Lineage is cut at every
write: the next run reads the stored table, never the previous plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.operators import customers, sales, weekly
from stockledger.sources.bucketed import BucketedHistory
from stockledger.sources.history import OpenClosedHistory
from stockledger.sources.raw import RawTable
from stockledger.sources.storage import SlicedTable, VersionedTable, empty_frame, session_conf, sql_view

#: Lines of an SQL daily batch that one task groups, about, and the shuffled bytes that Spark may put together
#: for a task again: ``DAILY_SQL`` holds a task's groups in three hash tables.
LINES_A_TASK, TASK_BYTES = 500_000, "16m"


@dataclass
class RunInfo:
    watermark: int | None
    note: str = ""


def daily_table(spark: SparkSession, root: str) -> SlicedTable:
    return SlicedTable(spark, root, schemas.DAILY_AGGREGATED_SALES, "sold_date_sk", ("item_sk", "warehouse_sk"))


def weekly_table(spark: SparkSession, root: str) -> SlicedTable:
    return SlicedTable(spark, root, schemas.WEEKLY_SALES_INVENTORY, "sold_wk_sk", ("item_sk", "warehouse_sk"))


def plan_daily_sales(
    catalog_sales: DataFrame,
    web_sales: DataFrame,
    date_dim: DataFrame,
    target: SlicedTable,
) -> tuple[int | None, DataFrame]:
    """The watermark and the lazy batch of a daily run (nothing is written)."""
    wm = target.last_slice()
    return wm, sales.daily_sales(sales.sales_union(catalog_sales, web_sales, wm), date_dim)


def run_daily_sales(
    catalog_sales: DataFrame,
    web_sales: DataFrame,
    date_dim: DataFrame,
    target: SlicedTable,
) -> RunInfo:
    """Incremental daily aggregate.

    1. watermark = last stored sold day (NULL on an empty table = full load);
    2. re-aggregate every sale on or after the watermark;
    3. in one commit, drop the possibly partial watermark day and add the batch.
    Sales older than the watermark that arrive late are not picked up.
    """
    wm, batch = plan_daily_sales(catalog_sales, web_sales, date_dim, target)
    target.replace_slice(wm, batch)
    return RunInfo(wm)


def run_daily_from_raw(catalog_sales: RawTable, web_sales: RawTable, date_dim: DataFrame, target: SlicedTable) -> RunInfo:
    """:func:`run_daily_sales` over raw tables in day ranges: a run opens the folders from its watermark's on."""
    wm = target.last_slice()
    return run_daily_sales(catalog_sales.read(wm), web_sales.read(wm), date_dim, target)


def marks_table(spark: SparkSession, root: str) -> SlicedTable:
    return SlicedTable(spark, root, T._parse_datatype_string(sales.MARK_SCHEMA), "sold_date_sk")


def run_daily_with_marks(catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame, target: SlicedTable, marks: SlicedTable) -> RunInfo:
    """:func:`run_daily_sales`, and a fingerprint of each day that it aggregates, stored by the same rule."""
    wm = target.last_slice()
    lines = sales.sales_union(catalog_sales, web_sales, wm)
    target.replace_slice(wm, sales.daily_sales(lines, date_dim))
    marks.replace_slice(wm, sales.day_marks(lines))
    return RunInfo(wm)


def late_day_report(catalog_sales: DataFrame, web_sales: DataFrame, target: SlicedTable, marks: SlicedTable) -> DataFrame:
    """The days behind the watermark that the source has changed since they were aggregated.

    Reads the source once (a row a day is shuffled) and the stored fingerprints, no
    stored detail rows. Empty before the first run.
    """
    wm = target.last_slice()
    return sales.late_days(marks.read(), sales.day_marks(sales.sales_union(catalog_sales, web_sales)), wm if wm is not None else -(1 << 62))


def run_daily_sql(spark: SparkSession, catalog_sales: str, web_sales: str, date_dim: str, target: SlicedTable) -> RunInfo:
    """The daily job as SQL over named tables: the watermark is a session variable.

    Same result as :func:`run_daily_sales`; the stored table stands in SQL under a
    view of its newest commit. The batch's lines are counted first, and the write has a
    shuffle partition for every ``LINES_A_TASK`` of them, at least, so that the memory of a
    task does not grow with the batch; the session's settings are as before afterwards.
    """
    base = "daily_aggregated_sales"
    if target.exists():
        sql_view(spark, base, target.root)
    else:
        empty_frame(spark, target.schema).createOrReplaceTempView(base)
    spark.sql("DECLARE OR REPLACE VARIABLE sold_since BIGINT DEFAULT 0")
    spark.sql(f"SET VARIABLE sold_since = (SELECT coalesce(max(sold_date_sk), 0) FROM {base})")
    batch = spark.sql(sales.DAILY_SQL.format(catalog_sales=catalog_sales, web_sales=web_sales, date_dim=date_dim))
    lines = spark.sql(sales.DAILY_LINES_SQL.format(catalog_sales=catalog_sales, web_sales=web_sales)).first()[0]
    partitions, advisory = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings = {partitions: str(max(int(spark.conf.get(partitions)), -(-lines // LINES_A_TASK)))}
    if spark.conf.get(advisory, None) is None:
        settings[advisory] = TASK_BYTES
    wm = target.last_slice()
    with session_conf(spark, settings):
        target.replace_slice(wm, batch)
    return RunInfo(wm)


def plan_weekly_sales_inventory(
    daily: SlicedTable,
    inventory: DataFrame,
    date_dim: DataFrame,
    target: SlicedTable,
) -> tuple[int | None, DataFrame | None]:
    """The watermark and the lazy batch of a weekly run (``None`` when no week
    can qualify); nothing is written.

    The source re-aggregates the whole daily history each run and keeps weeks
    whose first sale is on or after the watermark. Here the daily table is
    pruned first to the weeks that can still qualify (their last calendar day
    is on or after the watermark): a folder and row-group filter on ``sold_date_sk`` plus
    a semi-join on the week, both exact for any calendar. The source's ``HAVING`` is then applied unchanged.
    """
    wm = target.last_slice()
    if wm is None:
        return None, weekly.weekly_sales_inventory(daily.read(), inventory, date_dim)
    live = weekly.live_weeks(date_dim, wm)
    lower = live.agg(F.min("_first")).first()[0]
    if lower is None:
        return wm, None
    days = daily.read(min_slice=lower).join(
        live.select(F.col("wk_num").alias("_wk"), F.col("yr_num").alias("_yr")),
        (F.col("sold_wk_num") == F.col("_wk")) & (F.col("sold_yr_num") == F.col("_yr")),
        "left_semi",
    )
    inv = inventory.where(F.col("inv_data_sk") >= F.lit(lower))
    return wm, weekly.weekly_sales_inventory(days, inv, date_dim, wm)


def run_weekly_from_raw(daily: SlicedTable, inventory: RawTable, date_dim: DataFrame, target: SlicedTable) -> RunInfo:
    """:func:`run_weekly_sales_inventory` over an inventory in day ranges: only folders of live weeks are opened."""
    wm = target.last_slice()
    stock = inventory.read() if wm is None else live_stock(inventory, date_dim, wm)
    _, batch = plan_weekly_sales_inventory(daily, stock, date_dim, target)
    target.replace_slice(wm, batch)
    return RunInfo(wm)


def live_stock(inventory: RawTable, date_dim: DataFrame, since_wk_sk: int) -> DataFrame:
    """Inventory of the weeks that can still qualify (:func:`weekly.live_weeks`), found at run time."""
    live = weekly.live_weeks(date_dim, since_wk_sk).select(F.col("wk_num").alias("_wk"), F.col("yr_num").alias("_yr"))
    days = date_dim.join(live, (F.col("wk_num") == F.col("_wk")) & (F.col("yr_num") == F.col("_yr")), "left_semi")
    return inventory.read_days(days, "d_date_sk")


def run_weekly_sales_inventory(
    daily: SlicedTable,
    inventory: DataFrame,
    date_dim: DataFrame,
    target: SlicedTable,
) -> RunInfo:
    """Incremental weekly fact: in one commit, drop the last week slice and add the recomputed weeks.

    The batch may add rows to an older slice (a week number that recurs in a
    calendar year); that slice's stored rows stay. Without a qualifying week
    the last slice is dropped all the same.
    """
    wm, batch = plan_weekly_sales_inventory(daily, inventory, date_dim, target)
    target.replace_slice(wm, batch)
    return RunInfo(wm, "" if batch is not None else "no week can qualify; the last slice was dropped")


def customer_snapshot_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, schemas.CUSTOMER_SNAPSHOT)


def run_customer_snapshot(
    source: DataFrame,
    snapshot: VersionedTable,
    run_date: str,
    strict: bool = False,
    check_unique: bool = True,
) -> int:
    """Apply one customer load to the history and store it as a new version.

    A source with two rows for one customer makes the change merge ambiguous;
    the run is refused, as the source warehouse would refuse it. Strict mode
    first drops exact duplicate rows, so only conflicting rows are refused.
    """
    if strict:
        source = source.dropDuplicates()
    if check_unique:
        customers.assert_unique_key(source)
    base = snapshot.current_version()
    nxt = customers.scd2_merge(snapshot.read(base) if base else snapshot.read(), source, run_date, strict=strict)
    return snapshot.write(nxt, base=base or 0)


def run_customer_history_strict(
    source: DataFrame,
    history: OpenClosedHistory,
    run_date: str,
    check_unique: bool = True,
) -> int:
    """Strict SCD2 run over the open/closed layout: only open versions are
    read, merged and rewritten; closed versions are appended once."""
    source = source.dropDuplicates()
    if check_unique:
        customers.assert_unique_key(source)
    return history.apply(lambda open_rows: customers.scd2_merge(open_rows, source, run_date, strict=True))


def run_customer_dimension(
    snapshot: VersionedTable | OpenClosedHistory | BucketedHistory,
    address: DataFrame,
    demographics: DataFrame,
    household: DataFrame,
    income_band: DataFrame,
    target: VersionedTable,
) -> int:
    """``CREATE OR REPLACE TABLE customer_dim AS SELECT ...`` as a new version.

    Spark chooses the joins from the tables' sizes in bytes: the demographic
    tables are broadcast while small, the address table grows with the
    customers and is sort-merge joined. With the open/closed layout only the open versions are read.
    """
    current = snapshot.read() if isinstance(snapshot, VersionedTable) else snapshot.open_versions()
    return target.write(customers.customer_dimension(current, address, demographics, household, income_band))
