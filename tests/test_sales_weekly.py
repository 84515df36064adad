"""Daily and weekly semantics on small hand-made frames (edge rows of SURVEY R2-R8)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockledger.operators import calendar, sales, weekly

CH = ("{p}warehouse_sk bigint, {p}item_sk bigint, {p}sold_date_sk bigint, {p}quantity bigint, "
      "{p}sales_price decimal(12,2), {p}net_profit decimal(18,4)")


def channel(spark, prefix, rows):
    return spark.createDataFrame(rows, CH.format(p=prefix))


def cal_days(spark, first, last, rule="sunday"):
    b = spark.createDataFrame([(dt.date.fromisoformat(first), dt.date.fromisoformat(last))], "lo date, hi date")
    return calendar.calendar_between(b, rule)


# 2024-01-07 is a Sunday; day keys are days since 1970-01-01.
SUN = (dt.date(2024, 1, 7) - dt.date(1970, 1, 1)).days


def test_calendar_rules(spark):
    cal = cal_days(spark, "2023-12-27", "2024-01-13")
    rows = {r.d_date_sk: r for r in cal.collect()}
    assert min(rows) == SUN - 14  # starts on the Sunday on or before the first day
    assert rows[SUN].day_of_wk_num == 0 and rows[SUN + 6].day_of_wk_num == 6
    # sunday rule: the week of 2023-12-31 (a Sunday) belongs to 2023
    assert (rows[SUN - 7].yr_num, rows[SUN - 1].yr_num) == (2023, 2023)
    per_week = cal.groupBy("wk_num", "yr_num").agg(F.sum((F.col("day_of_wk_num") == 0).cast("int")).alias("s"))
    assert {r.s for r in per_week.collect()} == {1}
    # %U rule splits that week at New Year: 2024-01-01..06 have no Sunday
    u = cal_days(spark, "2023-12-27", "2024-01-13", "calendar_u")
    per_week_u = u.groupBy("wk_num", "yr_num").agg(F.sum((F.col("day_of_wk_num") == 0).cast("int")).alias("s"))
    assert 0 in {r.s for r in per_week_u.collect()}


def test_sales_union_filters_and_watermark(spark):
    cs = channel(spark, "cs_", [
        (1, 10, SUN, 2, Decimal("5.00"), Decimal("1.0000")),
        (1, 10, SUN, None, Decimal("5.00"), Decimal("1.0000")),   # NULL quantity: dropped
        (1, 10, SUN, 1, None, Decimal("1.0000")),                 # NULL amount: dropped
        (1, 10, None, 1, Decimal("5.00"), Decimal("1.0000")),     # NULL day: dropped
        (1, 10, SUN - 1, 1, Decimal("5.00"), None),               # NULL profit: kept
    ])
    ws = channel(spark, "ws_", [(None, 10, SUN, 3, Decimal("2.00"), Decimal("0.5000"))])
    u = sales.sales_union(cs, ws)
    assert u.count() == 3
    assert sales.sales_union(cs, ws, SUN).count() == 2  # watermark keeps days >= SUN


def test_daily_groups_null_warehouse_and_sums(spark):
    cs = channel(spark, "cs_", [
        (1, 10, SUN, 2, Decimal("5.00"), Decimal("1.0000")),
        (1, 10, SUN, 3, Decimal("1.10"), None),
        (None, 10, SUN, 1, Decimal("9.99"), Decimal("0.1000")),
    ])
    ws = channel(spark, "ws_", [(1, 10, SUN, 1, Decimal("0.10"), Decimal("0.2000"))])
    d = sales.daily_sales(sales.sales_union(cs, ws), cal_days(spark, "2024-01-07", "2024-01-13"))
    got = {r.warehouse_sk: r for r in d.collect()}
    assert got[1].daily_qty == 6
    assert got[1].daily_sales_amt == pytest.approx(10.0 + 3.3 + 0.1)
    assert got[1].daily_net_profit == pytest.approx(1.2)
    assert got[None].daily_qty == 1  # NULL warehouse is its own group
    assert (got[1].sold_wk_num, got[1].sold_yr_num) == (1, 2024)


def test_daily_keeps_day_without_calendar_row(spark):
    cs = channel(spark, "cs_", [(1, 10, SUN + 100, 2, Decimal("5.00"), Decimal("1.0000"))])
    ws = channel(spark, "ws_", [])
    d = sales.daily_sales(sales.sales_union(cs, ws), cal_days(spark, "2024-01-07", "2024-01-13")).collect()
    assert len(d) == 1 and d[0].sold_wk_num is None  # left join: NULL week


DAILY = ("warehouse_sk bigint, item_sk bigint, sold_date_sk bigint, sold_wk_num bigint, sold_yr_num bigint, "
         "daily_qty bigint, daily_sales_amt double, daily_net_profit double")
INV = "inv_data_sk int, inv_item_sk int, inv_quantity_on_hand int, inv_warehouse_sk int"


def test_weekly_metrics_and_flags(spark):
    cal = cal_days(spark, "2024-01-07", "2024-01-27")
    daily = spark.createDataFrame([
        (1, 10, SUN + 2, 1, 2024, 10, 100.0, 5.0),   # week 1, first sale on Tuesday
        (1, 10, SUN + 3, 1, 2024, 4, 40.0, 2.0),
        (1, 11, SUN + 7, 2, 2024, 7, 70.0, 1.0),     # week 2, no inventory -> 0 on hand
        (2, 12, SUN + 7, 2, 2024, 0, 0.0, 0.0),      # week 2, zero quantity -> removed by HAVING
        (None, 10, SUN + 8, 2, 2024, 3, 30.0, 1.0),  # NULL warehouse never matches inventory
    ], DAILY)
    inv = spark.createDataFrame([(SUN + 2, 10, 100, 1)], INV)
    w = {(r.warehouse_sk, r.item_sk): r for r in weekly.weekly_sales_inventory(daily, inv, cal).collect()}
    assert set(w) == {(1, 10), (1, 11), (None, 10)}
    a = w[(1, 10)]
    assert a.sold_wk_sk == SUN  # Sunday key, not the first sale day
    assert a.sum_qty_wk == 14 and a.inv_qty_wk == 100
    assert a.avg_qty_dy == Decimal("2.000000")
    assert a.wks_sply == Decimal("7.142857")
    assert a.low_stock_flg_wk is False
    b = w[(1, 11)]
    assert b.inv_qty_wk == 0 and b.low_stock_flg_wk is True and b.wks_sply == Decimal("0E-6")
    assert w[(None, 10)].inv_qty_wk == 0


def test_weekly_inventory_fan_out_multiplies(spark):
    cal = cal_days(spark, "2024-01-07", "2024-01-13")
    daily = spark.createDataFrame([(1, 10, SUN + 1, 1, 2024, 5, 50.0, 1.0)], DAILY)
    inv = spark.createDataFrame([(SUN + 2, 10, 3, 1), (SUN + 4, 10, None, 1)], INV)
    (r,) = weekly.weekly_sales_inventory(daily, inv, cal).collect()
    assert r.sum_qty_wk == 10 and r.sum_amt_wk == 100.0  # two snapshots double the sales
    assert r.inv_qty_wk == 3  # NULL on hand counts as 0


def test_weekly_week_without_sunday_is_dropped(spark):
    cal = cal_days(spark, "2023-12-27", "2024-01-13", "calendar_u")
    day = (dt.date(2024, 1, 3) - dt.date(1970, 1, 1)).days  # week 0 of 2024 under %U: no Sunday
    daily = spark.createDataFrame([(1, 10, day, 0, 2024, 5, 50.0, 1.0)], DAILY)
    inv = spark.createDataFrame([], INV)
    assert weekly.weekly_sales_inventory(daily, inv, cal).count() == 0


def test_weekly_having_on_first_sale_day(spark):
    cal = cal_days(spark, "2024-01-07", "2024-01-20")
    daily = spark.createDataFrame([
        (1, 10, SUN + 1, 1, 2024, 5, 50.0, 1.0),
        (1, 11, SUN + 3, 1, 2024, 5, 50.0, 1.0),
    ], DAILY)
    inv = spark.createDataFrame([], INV)
    # since = SUN + 2: only the group whose first sale is on/after it passes
    rows = weekly.weekly_sales_inventory(daily, inv, cal, since_wk_sk=SUN + 2).collect()
    assert [(r.item_sk, r.sold_wk_sk) for r in rows] == [(11, SUN)]


def test_long_calendar_is_not_refused(spark):
    """The public retail schema's date table has 73,049 days; nothing caps a calendar's span."""
    cal = cal_days(spark, "1800-01-01", "2100-12-31")
    assert cal.count() > 100_000
    cs = channel(spark, "cs_", [(1, 10, SUN, 2, Decimal("5.00"), Decimal("1.0000"))])
    (r,) = sales.daily_sales(sales.sales_union(cs, channel(spark, "ws_", [])), cal).collect()
    assert r.daily_qty == 2 and r.sold_yr_num == 2024


def test_double_amounts_are_rounded_per_line(spark):
    """FLOAT amounts: each line counts with four decimals, so sums do not depend on the order of rows."""
    schema = CH.format(p="cs_").replace("decimal(12,2)", "double").replace("decimal(18,4)", "double")
    cs = spark.createDataFrame([(1, 10, SUN, 1, 0.1, 0.00004), (1, 10, SUN, 3, 0.1, 0.00006)], schema)
    (r,) = sales.daily_sales(sales.sales_union(cs, channel(spark, "ws_", [])), cal_days(spark, "2024-01-07", "2024-01-13")).collect()
    assert r.daily_sales_amt == 0.4 and r.daily_net_profit == 0.0001


def test_calendar_schema(spark):
    from stockledger import schemas

    cal = cal_days(spark, "2024-01-07", "2024-01-13")
    assert [(f.name, f.dataType) for f in cal.schema] == [(f.name, f.dataType) for f in schemas.DATE_DIM]


def test_repeated_calendar_day_doubles_the_days_sums(spark):
    """The second daily aggregate is kept: a calendar with a repeated day key
    multiplies that day's sums, as the source query does."""
    cal = cal_days(spark, "2024-01-07", "2024-01-13")
    dup = cal.unionByName(cal.where(F.col("d_date_sk") == SUN))
    cs = channel(spark, "cs_", [(1, 10, SUN, 2, Decimal("5.00"), Decimal("1.0000"))])
    ws = channel(spark, "ws_", [])
    (r,) = sales.daily_sales(sales.sales_union(cs, ws), dup).collect()
    assert r.daily_qty == 4 and r.daily_sales_amt == 20.0


def test_week_with_two_sundays_doubles_and_keeps_the_first(spark):
    cal = cal_days(spark, "2024-01-07", "2024-01-20")
    # relabel the second Sunday as week 1 too: week 1 now has two Sunday rows
    two = cal.withColumn("wk_num", F.when(F.col("d_date_sk") == SUN + 7, F.lit(1)).otherwise(F.col("wk_num")))
    daily = spark.createDataFrame([(1, 10, SUN + 1, 1, 2024, 5, 50.0, 1.0)], DAILY)
    inv = spark.createDataFrame([], INV)
    (r,) = weekly.weekly_sales_inventory(daily, inv, two).collect()
    assert r.sum_qty_wk == 10 and r.sold_wk_sk == SUN
