"""Sales lines of both channels and their daily aggregate.

Plan shape (what ``explain`` shows): two Parquet scans with the watermark
filter pushed into each -> projection -> ``Union`` -> partial
``HashAggregate`` (map-side combine, so a hot warehouse/item/day is reduced
before the shuffle) -> one ``Exchange hashpartitioning(warehouse_sk, item_sk,
sold_date_sk)`` -> final aggregate -> join of the calendar (brought to a row a day,
broadcast by size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.scalar import MONEY, nvl, repeated

# The two channels and the column prefix each uses.
CHANNEL_PREFIXES = {"catalog": "cs_", "web": "ws_"}

DAILY_KEYS = ("warehouse_sk", "item_sk", "sold_date_sk")


def channel_lines(sales: DataFrame, prefix: str, since_date_sk: int | None = None) -> DataFrame:
    """One channel's sales mapped onto the common line schema.

    Keeps lines on or after ``since_date_sk`` (``NVL(since, 0)``: no watermark
    means a full load; NULL sold dates fail the comparison and are dropped in
    both modes) whose quantity and line amount are present.
    """
    p = prefix
    lines = sales.select(
        F.col(f"{p}warehouse_sk").alias("warehouse_sk"),
        F.col(f"{p}item_sk").alias("item_sk"),
        F.col(f"{p}sold_date_sk").alias("sold_date_sk"),
        F.col(f"{p}quantity").alias("quantity"),
        (F.col(f"{p}sales_price") * F.col(f"{p}quantity")).alias("sales_amt"),
        F.col(f"{p}net_profit").alias("net_profit"),
    )
    return lines.where(
        (F.col("sold_date_sk") >= nvl(F.lit(since_date_sk).cast("bigint"), 0))
        & F.col("quantity").isNotNull()
        & F.col("sales_amt").isNotNull()
    )


def sales_union(catalog: DataFrame, web: DataFrame, since_date_sk: int | None = None) -> DataFrame:
    """``UNION ALL`` of both channels' lines (duplicates kept)."""
    return channel_lines(catalog, CHANNEL_PREFIXES["catalog"], since_date_sk).unionByName(
        channel_lines(web, CHANNEL_PREFIXES["web"], since_date_sk)
    )


def daily_sales(lines: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Daily aggregate per warehouse, item and sold day, with week and year.

    ``date_dim`` is a calendar, a few MB at most in practice, which Spark
    broadcasts by its size. Amounts given as double are rounded to four
    decimals a line before the sum, which makes sums exact and repeatable. A calendar
    with repeated ``d_date_sk`` multiplies the day's sums, as in the source query, which
    aggregates again after the join; here the calendar is brought to a row a day
    with its number of rows first, so the lines' groups are hashed once. A NULL warehouse forms
    its own group. Amounts are summed as exact decimals and stored as double.
    """
    per_day = lines.groupBy(*DAILY_KEYS).agg(
        F.sum("quantity").alias("daily_qty"),
        F.sum(F.col("sales_amt").cast(MONEY)).alias("daily_sales_amt"),
        F.sum(F.col("net_profit").cast(MONEY)).alias("daily_net_profit"),
    )
    weeks = date_dim.repartitionByRange("d_date_sk").groupBy("d_date_sk").agg(
        F.max("wk_num").alias("sold_wk_num"),
        F.max("yr_num").alias("sold_yr_num"),
        F.count(F.lit(1)).alias("_times"),
    )
    with_week = per_day.join(weeks, per_day["sold_date_sk"] == weeks["d_date_sk"], "left")
    return with_week.select(
        *DAILY_KEYS,
        F.col("sold_wk_num").cast("bigint").alias("sold_wk_num"),
        F.col("sold_yr_num").cast("bigint").alias("sold_yr_num"),
        repeated("daily_qty", "_times").cast("bigint").alias("daily_qty"),
        repeated("daily_sales_amt", "_times").cast("double").alias("daily_sales_amt"),
        repeated("daily_net_profit", "_times").cast("double").alias("daily_net_profit"),
    )


MARK_SCHEMA = "sold_date_sk bigint, n_lines bigint, sum_qty bigint, sum_amt decimal(38,4), sum_hash decimal(38,0)"


def day_marks(lines: DataFrame) -> DataFrame:
    """A fingerprint of each sold day's lines that does not depend on their order.

    Count, sums and the sum of 64-bit row hashes: a line that is added, lost or
    changed changes its day's mark (two changes whose hashes cancel out apart).
    The hashes' upper and lower halves are summed as whole numbers (room for 2^31
    lines a day) and put together a row a day, without a decimal a line.
    """
    whole = F.xxhash64(*[F.col(c) for c in ("warehouse_sk", "item_sk", "sold_date_sk", "quantity")], F.col("sales_amt").cast(MONEY), F.col("net_profit").cast(MONEY))
    return lines.groupBy("sold_date_sk").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("quantity").cast("bigint").alias("sum_qty"),
        F.sum(F.col("sales_amt").cast(MONEY)).cast("decimal(38,4)").alias("sum_amt"),
        (F.sum(F.shiftright(whole, 32)).cast("decimal(26,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.sum(whole.bitwiseAND((1 << 32) - 1))).cast("decimal(38,0)").alias("sum_hash"),
    )


def late_days(stored: DataFrame, now: DataFrame, before: int) -> DataFrame:
    """The days older than ``before`` whose lines are no longer those that were aggregated.

    ``stored`` and ``now`` are :func:`day_marks`, a row a day, of the lines that
    the daily table was made from and of the source as it is. Returns
    (sold_date_sk, n_stored, n_source, qty_stored, qty_source), 0 for a day that one side lacks.
    """
    old = stored.where(F.col("sold_date_sk") < before).select("sold_date_sk", F.struct("n_lines", "sum_qty", "sum_amt", "sum_hash").alias("_old"))
    new = now.where(F.col("sold_date_sk") < before).select("sold_date_sk", F.struct("n_lines", "sum_qty", "sum_amt", "sum_hash").alias("_new"))
    both = old.join(new, "sold_date_sk", "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    value = lambda side, field: F.coalesce(F.col(f"{side}.{field}"), F.lit(0)).cast("bigint")
    return both.select(
        "sold_date_sk", value("_old", "n_lines").alias("n_stored"), value("_new", "n_lines").alias("n_source"), value("_old", "sum_qty").alias("qty_stored"), value("_new", "sum_qty").alias("qty_source")
    )


#: The daily batch as SQL; ``sold_since`` is a session variable, the tables are names of views.
DAILY_SQL = """
WITH sold AS (
  SELECT cs_warehouse_sk AS warehouse_sk, cs_item_sk AS item_sk, cs_sold_date_sk AS sold_date_sk, cs_quantity AS quantity,
         cs_sales_price * cs_quantity AS sales_amt, cs_net_profit AS net_profit FROM {catalog_sales} WHERE cs_sold_date_sk >= sold_since
  UNION ALL
  SELECT ws_warehouse_sk, ws_item_sk, ws_sold_date_sk, ws_quantity, ws_sales_price * ws_quantity, ws_net_profit FROM {web_sales} WHERE ws_sold_date_sk >= sold_since
), days AS (
  SELECT warehouse_sk, item_sk, sold_date_sk, sum(quantity) AS qty, sum(CAST(sales_amt AS DECIMAL(38,4))) AS amt, sum(CAST(net_profit AS DECIMAL(38,4))) AS profit
  FROM sold WHERE quantity IS NOT NULL AND sales_amt IS NOT NULL GROUP BY ALL
)
SELECT warehouse_sk, item_sk, sold_date_sk, CAST(max(wk_num) AS BIGINT) AS sold_wk_num, CAST(max(yr_num) AS BIGINT) AS sold_yr_num,
       CAST(sum(qty) AS BIGINT) AS daily_qty, CAST(sum(amt) AS DOUBLE) AS daily_sales_amt, CAST(sum(profit) AS DOUBLE) AS daily_net_profit
FROM days LEFT JOIN {date_dim} ON sold_date_sk = d_date_sk GROUP BY warehouse_sk, item_sk, sold_date_sk
"""

#: The number of lines that ``DAILY_SQL`` is to group, at most.
DAILY_LINES_SQL = """
SELECT (SELECT count(*) FROM {catalog_sales} WHERE cs_sold_date_sk >= sold_since) + (SELECT count(*) FROM {web_sales} WHERE ws_sold_date_sk >= sold_since)
"""
