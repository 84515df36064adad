"""What keeps the mart's larger jobs cheap: lines hashed once, no decimals a line."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger.operators import calendar, sales, weekly
from stockledger.sources import csv_ingest
from stockledger.sources.storage import session_conf
from tests.test_plans import CH, SUN, plan_of


def inputs(spark):
    cs = spark.createDataFrame([(1, 1, SUN + 1, 2, None, None), (1, 1, SUN + 2, 3, None, None)], CH.format(p="cs_")).withColumn("cs_sales_price", F.lit("2.50").cast("decimal(12,2)"))
    ws = spark.createDataFrame([], CH.format(p="ws_"))
    bounds = spark.sql("SELECT date_from_unix_date({0}) AS lo, date_from_unix_date({0} + 6) AS hi".format(SUN))
    return sales.sales_union(cs, ws), calendar.calendar_between(bounds)


def plan(spark, df):
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        return plan_of(df)


def test_lines_are_aggregated_once_and_repeated_days_multiply(spark):
    lines, cal = inputs(spark)
    daily = sales.daily_sales(lines, cal.union(cal.where(F.col("d_date_sk") == SUN + 1)))
    assert plan(spark, daily).count("HashAggregate(keys=[warehouse_sk") == 2  # partial and final
    assert {r.sold_date_sk: (r.daily_qty, r.daily_sales_amt) for r in daily.collect()} == {SUN + 1: (4, 10.0), SUN + 2: (3, 7.5)}


def test_weekly_joined_rows_are_not_aggregated_again(spark):
    lines, cal = inputs(spark)
    cal = cal.union(cal.where(F.col("d_date_sk") == SUN))  # a second Sunday row
    stock = spark.createDataFrame([(SUN + 2, 1, 4, 1), (SUN + 4, 1, None, 1), (SUN + 2, 1, 9, None)], "inv_data_sk long, inv_item_sk long, inv_quantity_on_hand long, inv_warehouse_sk long")
    fact = weekly.weekly_sales_inventory(sales.daily_sales(lines, cal), stock, cal)
    text = plan(spark, fact)
    assert "Aggregate" not in text[: text.index("Join")]
    (row,) = fact.collect()
    assert (row.sold_wk_sk, row.sum_qty_wk, row.inv_qty_wk) == (SUN, 5 * 2 * 2, 4 * 2)


def test_day_marks_sum_the_same_hashes_without_a_decimal_a_line(spark):
    lines = spark.range(500).select(F.lit(1).alias("warehouse_sk"), F.col("id").alias("item_sk"), (F.col("id") % 3).alias("sold_date_sk"), F.lit(2).alias("quantity"), F.lit(1.5).alias("sales_amt"), F.lit(0.25).alias("net_profit"))
    marks = sales.day_marks(lines)
    assert "sum(cast(xxhash64" not in plan(spark, marks)
    whole = F.xxhash64("warehouse_sk", "item_sk", "sold_date_sk", "quantity", F.col("sales_amt").cast(sales.MONEY), F.col("net_profit").cast(sales.MONEY))
    want = {}
    for day, h in lines.select("sold_date_sk", whole).collect():
        want[day] = want.get(day, 0) + h
    assert {r.sold_date_sk: int(r.sum_hash) for r in marks.collect()} == want


def test_plain_numbers_of_a_drop_are_cast_directly(spark, tmp_path):
    lines = ["1,2,3,4", "+1, 7 ,2.5,4", '"1","2","","4"', "1,2,5\x7f,4", "1,,3,4", "1,2,x,4", "99999999999999999999,2,3,4", "1,2,-0.5,4"]
    (tmp_path / "drop.csv").write_text("\n".join(lines))
    load = csv_ingest.read_csv_drop(spark, str(tmp_path))
    assert sorted(map(tuple, load.good.collect()), key=str) == sorted([(1, 2, 3, 4), (1, 7, 3, 4), (1, 2, None, 4), (1, 2, -1, 4)], key=str)
    assert load.rejected.count() == 4
    assert "trim(inv_item_sk" not in plan(spark, load.good)
