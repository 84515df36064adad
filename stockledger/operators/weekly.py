"""Weekly sales x inventory fact with stock cover and low-stock flag.

Plan shape: daily rows -> partial/final aggregate by ``(warehouse, item, week,
year)`` (one Exchange by ``(item, warehouse, week, year)``) -> join to the week's Sunday (broadcast by size) -> sort-merge left join with the inventory, aggregated to a
row per item/warehouse/week with its number of rows (several snapshots in one week multiply the sales sums, as in the
source, and the ``dq_unique`` check on the inventory key reports it) ->
``HAVING sum_qty_wk > 0`` before any division.

At scale both sides of the left join are one row per item/warehouse/week, so the join
is balanced even when one item or warehouse dominates the raw sales; AQE's
skew-join splitting covers what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.scalar import MONEY, iff, nvl, ratio6, repeated, zero_if_null
from stockledger.operators.calendar import sundays

# The item first: sorts for the join compare rows by it, and it has the most values.
WEEK_KEYS = ("item_sk", "warehouse_sk", "sold_wk_num", "sold_yr_num")


def week_rollup(daily: DataFrame, since_wk_sk: int | None = None) -> DataFrame:
    """Daily rows summed to item/warehouse/week; ``sold_wk_sk`` is the week's
    first sale day. ``HAVING sold_wk_sk >= NVL(since, 0)`` keeps only weeks
    whose first sale is on or after the watermark."""
    weeks = daily.groupBy(*WEEK_KEYS).agg(
        F.min("sold_date_sk").alias("sold_wk_sk"),
        F.sum("daily_qty").alias("sum_qty_wk"),
        F.sum(F.col("daily_sales_amt").cast(MONEY)).alias("sum_amt_wk"),
        F.sum(F.col("daily_net_profit").cast(MONEY)).alias("sum_profit_wk"),
    )
    return weeks.where(F.col("sold_wk_sk") >= nvl(F.lit(since_wk_sk).cast("bigint"), 0))


def with_sunday_key(weeks: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Replace ``sold_wk_sk`` by the day key of the week's first Sunday, and add the number of its Sunday rows (``_sundays``).

    Inner join on ``(wk_num, yr_num)`` with the Sunday rows: a week without a
    Sunday row is dropped, a week with two Sundays counts twice (as the source).
    """
    sun = sundays(date_dim).groupBy(F.col("wk_num").alias("_wk"), F.col("yr_num").alias("_yr")).agg(
        F.min("d_date_sk").alias("_sunday_sk"),
        F.count(F.lit(1)).alias("_sundays"),
    )
    joined = weeks.join(sun, (weeks["sold_wk_num"] == sun["_wk"]) & (weeks["sold_yr_num"] == sun["_yr"]), "inner")
    return joined.select(
        "warehouse_sk",
        "item_sk",
        F.col("_sunday_sk").alias("sold_wk_sk"),
        "sold_wk_num",
        "sold_yr_num",
        "sum_qty_wk",
        "sum_amt_wk",
        "sum_profit_wk",
        "_sundays",
    )


def inventory_with_week(inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    """``inventory.*`` plus the week and year of the snapshot day (inner join:
    snapshots on days outside the calendar are dropped)."""
    cal = date_dim.select(
        F.col("d_date_sk").alias("_inv_day"),
        F.col("wk_num").alias("inv_wk_num"),
        F.col("yr_num").alias("inv_yr_num"),
    )
    joined = inventory.join(cal, inventory["inv_data_sk"] == cal["_inv_day"], "inner")
    return joined.select(inventory["*"], "inv_wk_num", "inv_yr_num")


def weekly_sales_inventory(
    daily: DataFrame,
    inventory: DataFrame,
    date_dim: DataFrame,
    since_wk_sk: int | None = None,
) -> DataFrame:
    """The weekly fact: sales per item/warehouse/week joined to on-hand stock.

    The source joins sales, Sundays and inventory row by row and sums afterwards.
    Here each side is one row a key with its number of rows, and the sums are
    multiplied by the other sides' rows, so the joined rows are not hashed again.
    """
    weeks = with_sunday_key(week_rollup(daily, since_wk_sk), date_dim)
    week = [F.col(c).cast(weeks.schema[s].dataType).alias(c) for c, s in zip(("inv_item_sk", "inv_warehouse_sk", "inv_wk_num", "inv_yr_num"), WEEK_KEYS)]
    inv = inventory_with_week(inventory, date_dim).groupBy(*week).agg(  # keys of the sales' types: the join needs no second shuffle
        F.sum(zero_if_null("inv_quantity_on_hand")).alias("_on_hand"),
        F.count(F.lit(1)).alias("_rows"),
    )
    joined = weeks.join(
        inv,
        (weeks["item_sk"] == inv["inv_item_sk"])
        & (weeks["warehouse_sk"] == inv["inv_warehouse_sk"])
        & (weeks["sold_wk_num"] == inv["inv_wk_num"])
        & (weeks["sold_yr_num"] == inv["inv_yr_num"]),
        "left",
    )
    times = joined.withColumn("_times", F.col("_sundays") * F.coalesce("_rows", F.lit(1)))
    agg = times.select(
        *WEEK_KEYS,
        "sold_wk_sk",
        repeated("sum_qty_wk", "_times").alias("sum_qty_wk"),
        repeated("sum_amt_wk", "_times").alias("sum_amt_wk"),
        repeated("sum_profit_wk", "_times").alias("sum_profit_wk"),
        repeated(zero_if_null("_on_hand"), "_sundays").alias("inv_qty_wk"),
    )
    # HAVING first: the ratios below never see a zero or negative quantity.
    agg = agg.where(F.col("sum_qty_wk") > 0)
    avg_qty_dy = ratio6(F.col("sum_qty_wk"), F.lit(7))
    return agg.select(
        F.col("warehouse_sk").cast("bigint").alias("warehouse_sk"),
        F.col("item_sk").cast("bigint").alias("item_sk"),
        F.col("sold_wk_sk").cast("bigint").alias("sold_wk_sk"),
        F.col("sold_wk_num").cast("bigint").alias("sold_wk_num"),
        F.col("sold_yr_num").cast("bigint").alias("sold_yr_num"),
        F.col("sum_qty_wk").cast("bigint").alias("sum_qty_wk"),
        F.col("sum_amt_wk").cast("double").alias("sum_amt_wk"),
        F.col("sum_profit_wk").cast("double").alias("sum_profit_wk"),
        avg_qty_dy.alias("avg_qty_dy"),
        F.col("inv_qty_wk").cast("bigint").alias("inv_qty_wk"),
        ratio6(F.col("inv_qty_wk"), F.col("sum_qty_wk")).alias("wks_sply"),
        iff((avg_qty_dy > 0) & (avg_qty_dy > F.col("inv_qty_wk")), F.lit(True), F.lit(False)).alias(
            "low_stock_flg_wk"
        ),
    )


def live_weeks(date_dim: DataFrame, since_wk_sk: int) -> DataFrame:
    """``(wk_num, yr_num)`` of weeks that can still pass ``min(day) >= since``:
    those whose last day is on or after the watermark. Exact for any calendar,
    used to prune an incremental weekly run to the recent weeks."""
    return (
        date_dim.groupBy("wk_num", "yr_num")
        .agg(F.max("d_date_sk").alias("_last"), F.min("d_date_sk").alias("_first"))
        .where(F.col("_last") >= F.lit(since_wk_sk))
        .select("wk_num", "yr_num", "_first")
    )
