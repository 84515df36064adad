"""Physical-plan properties: shuffles, broadcasts, pushdown and pruning."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockledger import schemas
from stockledger.operators import calendar, sales, weekly
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources.storage import session_conf

CH = ("{p}warehouse_sk bigint, {p}item_sk bigint, {p}sold_date_sk bigint, {p}quantity bigint, "
      "{p}sales_price decimal(12,2), {p}net_profit decimal(18,4)")
SUN = 19729


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def stored(spark):
    """Channel, daily and inventory tables written as Parquet (like real inputs)."""
    root = shared_dir(spark, "test_plans")
    rows = [(1 + i % 6, i % 50, SUN + i % 30, 1 + i % 5, Decimal("3.10"), Decimal("0.1000")) for i in range(600)]
    for p in ("cs_", "ws_"):
        spark.createDataFrame(rows, CH.format(p=p)).write.parquet(f"{root}/{p}sales")
    bounds = spark.createDataFrame([(dt.date(2024, 1, 7), dt.date(2024, 3, 2))], "lo date, hi date")
    cal = calendar.calendar_between(bounds)
    cal.write.parquet(f"{root}/date_dim")
    inv = spark.createDataFrame([(SUN + 2 + 7 * (i % 8), i % 50, i, 1 + i % 6) for i in range(400)], schemas.INVENTORY)
    inv.write.parquet(f"{root}/inventory")
    return root


def test_daily_plan_has_one_shuffle_and_broadcast_calendar(spark, stored):
    r = spark.read
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        d = sales.daily_sales(
            sales.sales_union(r.parquet(f"{stored}/cs_sales"), r.parquet(f"{stored}/ws_sales"), SUN + 3),
            r.parquet(f"{stored}/date_dim"),
        )
        plan = plan_of(d)
    assert hash_exchanges(plan) == 1, plan  # the second aggregate reuses the partitioning
    assert "BroadcastHashJoin" in plan  # Spark broadcasts the calendar by its size
    # the watermark reaches both scans
    assert len(re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\((cs|ws)_sold_date_sk,\d+\)", plan)) == 2


def test_weekly_plan_shuffles(spark, stored):
    r = spark.read
    # without any broadcast: a calendar too large for one would be joined by shuffle, the job still runs
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.enabled": "false"}):
        daily = sales.daily_sales(
            sales.sales_union(r.parquet(f"{stored}/cs_sales"), r.parquet(f"{stored}/ws_sales")),
            r.parquet(f"{stored}/date_dim"),
        )
        w = weekly.weekly_sales_inventory(daily, r.parquet(f"{stored}/inventory"), r.parquet(f"{stored}/date_dim"))
        plan = plan_of(w)
    assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SinglePartition" not in plan, plan
    assert plan.count("SortMergeJoin") == 4


def test_weekly_incremental_reads_only_live_slices(spark, stored):
    r = spark.read
    cal = r.parquet(f"{stored}/date_dim")
    daily_t = jobs.daily_table(spark, shared_dir(spark, "test_plans_daily"))
    jobs.run_daily_sales(r.parquet(f"{stored}/cs_sales"), r.parquet(f"{stored}/ws_sales"), cal, daily_t)
    assert len(daily_t.slices()) == 30
    pruned = daily_t.read(min_slice=SUN + 21)
    # folders hold 32 days: the older one is not opened
    assert len(pruned.inputFiles()) < len(daily_t.read().inputFiles())
    assert {x.sold_date_sk for x in pruned.select("sold_date_sk").distinct().collect()} == set(
        range(SUN + 21, SUN + 30))


def test_probe_moves_no_fact_rows(spark, stored):
    """Only distinct keys of the fact are shuffled, and what is broadcast is the preview's few keys."""
    from stockledger.operators import explore

    fact = spark.read.parquet(f"{stored}/cs_sales")
    dim = spark.range(1, 7).select(F.col("id").alias("w_warehouse_sk"), F.concat(F.lit("W"), "id").alias("w_name"))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        p = explore.key_probe_preview(fact, "cs_warehouse_sk", dim, "w_warehouse_sk", ["cs_item_sk"], 5)
        lines = plan_of(p).splitlines()
        rows = p.collect()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(cs_warehouse_sk" in line:
            assert "HashAggregate" in lines[i + 1], line  # distinct keys only
    assert [(r.cs_warehouse_sk, r.cs_item_sk, r.w_name) for r in rows] == [(1, 0, "W1")] * 4 + [(1, 2, "W1")]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """One warehouse/item/day holds a third of the rows: partial aggregation
    reduces it to one row per task before the Exchange."""
    hot = [(1, 1, SUN, 1, Decimal("1.00"), Decimal("0.1000"))] * 1000
    rest = [(1 + i % 6, 2 + i % 97, SUN + i % 20, 1, Decimal("1.00"), Decimal("0.1000")) for i in range(2000)]
    cs = spark.createDataFrame(hot + rest, CH.format(p="cs_")).repartition(8)
    ws = spark.createDataFrame([], CH.format(p="ws_"))
    bounds = spark.createDataFrame([(dt.date(2024, 1, 7), dt.date(2024, 2, 3))], "lo date, hi date")
    d = sales.daily_sales(sales.sales_union(cs, ws), calendar.calendar_between(bounds))
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = plan_of(d)
    lines = plan.splitlines()
    ex = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(warehouse_sk" in line)  # the lowest
    assert "partial_sum" in next(line for line in lines[ex + 1:] if "HashAggregate" in line)
    (row,) = d.where((F.col("warehouse_sk") == 1) & (F.col("item_sk") == 1)).collect()
    assert row.daily_qty == 1000 and row.daily_sales_amt == 1000.0
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_customer_dimension_forces_no_broadcast(spark, sf_dir):
    from stockledger.operators import customers
    from stockledger.sources import fixtures as fx
    from stockledger.sources.storage import empty_frame
    from stockledger.sources.tables import Tables

    t = Tables(spark, sf_dir)
    tables = (fx.customer_address(t), fx.customer_demographics(t), fx.household_demographics(t), fx.income_band(t))
    snapshot = empty_frame(spark, schemas.CUSTOMER_SNAPSHOT)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = plan_of(customers.customer_dimension(snapshot, *tables))
    assert plan.count("SortMergeJoin") == 4 and "Broadcast" not in plan, plan
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = plan_of(customers.customer_dimension(snapshot, *tables))
    assert plan.count("BroadcastHashJoin") >= 3, plan  # small by their sizes in bytes
