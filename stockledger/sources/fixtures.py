"""Retail-shaped views over the driver's TPC-H-like tables.

The mart is written for the TPC-DS retail schema (two sales channels,
inventory, a date dimension, customers with demographics). The test tables are
TPC-H-like, so these functions derive the retail inputs from them. Every view
reads its whole source table; rules on keys only decide *which* defect a row
carries (a NULL warehouse, a missing quantity, a changed customer), so the
mart's edge cases are exercised at every scale:

* ``lineitem`` splits into two channels: lines 1-4 are catalog sales, lines 5+
  web sales (together they are all of ``lineitem``).
* ``inventory`` is derived from the sales keys, one snapshot per item and
  warehouse on the Tuesday of a week with sales and of the following week,
  with an extra Thursday snapshot for one item in ten (the fan-out case). For
  the weekly fact, which must also meet sales without inventory,
  ``inventory_with_gaps`` leaves out the pairs with ``(item + wh) % 23 = 0``.
* three customer loads (``load`` 0, 1, 2) model arrivals, changes, value ->
  NULL, A -> B -> A and customers missing from a load.
* customer address / demographics / household / income band stand-ins come
  from ``orders`` (aggregated per customer), ``nation`` and ``region``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.scalar import days_since_epoch, week_start_sk
from stockledger.operators.calendar import calendar_spanning
from stockledger.schemas import CUSTOMER_COLUMNS
from stockledger.sources.tables import Tables

# Fixed run dates of the three customer loads.
CUSTOMER_LOAD_DATES = ("2024-01-01", "2024-01-02", "2024-01-03")


def date_dim(t: Tables, week_rule: str = "sunday") -> DataFrame:
    """Calendar spanning every ship date."""
    return calendar_spanning(t.lineitem, "l_shipdate", week_rule)


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _sales_channel(lines: DataFrame, p: str) -> DataFrame:
    order = F.col("l_orderkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return lines.select(
        _null_when(order % 101 == 0, F.col("l_suppkey") % 6 + 1).cast("bigint").alias(f"{p}warehouse_sk"),
        F.col("l_partkey").cast("bigint").alias(f"{p}item_sk"),
        _null_when(order % 83 == 0, days_since_epoch("l_shipdate")).cast("bigint").alias(f"{p}sold_date_sk"),
        _null_when(order % 97 == 0, F.col("l_quantity").cast("bigint")).alias(f"{p}quantity"),
        _null_when(order % 89 == 0, price).cast("decimal(12,2)").alias(f"{p}sales_price"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)").alias(f"{p}net_profit"),
        order.cast("bigint").alias(f"{p}order_number"),
        F.col("l_linenumber").cast("bigint").alias(f"{p}line_number"),
    )


def catalog_sales(t: Tables) -> DataFrame:
    return _sales_channel(t.lineitem.where(F.col("l_linenumber") <= 4), "cs_")


def web_sales(t: Tables) -> DataFrame:
    return _sales_channel(t.lineitem.where(F.col("l_linenumber") > 4), "ws_")


def catalog_sales_billed(t: Tables) -> DataFrame:
    """``catalog_sales`` with the bill-to keys that the order and its customer carry."""
    o = t.orders.select(F.col("o_orderkey").cast("bigint").alias("_o"), F.col("o_custkey").cast("bigint").alias("cs_bill_customer_sk"))
    c = t.customer.select(F.col("c_custkey").alias("_c"), F.col("c_nationkey").cast("bigint").alias("_n"))
    cs = catalog_sales(t)
    j = cs.join(o, cs["cs_order_number"] == o["_o"], "left").join(c, F.col("cs_bill_customer_sk") == c["_c"], "left")
    return j.select(cs["*"], "cs_bill_customer_sk", F.col("_n").alias("cs_bill_cdemo_sk"), F.col("_n").alias("cs_bill_hdemo_sk"),
                    F.col("cs_bill_customer_sk").alias("cs_bill_addr_sk"))


def inventory(t: Tables) -> DataFrame:
    """Weekly inventory snapshots derived from the keys of both channels."""

    def keys(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            F.col(f"{p}item_sk").alias("item"),
            F.col(f"{p}warehouse_sk").alias("wh"),
            week_start_sk(F.col(f"{p}sold_date_sk")).alias("sunday"),
        ).where(F.col("wh").isNotNull() & F.col("sunday").isNotNull())

    k = keys(catalog_sales(t), "cs_").unionByName(keys(web_sales(t), "ws_"))
    offsets = F.when(
        F.col("item") % 10 == 0, F.array(F.lit(2), F.lit(4), F.lit(9))
    ).otherwise(F.array(F.lit(2), F.lit(9)))
    snaps = (
        k.select("item", "wh", "sunday", F.explode(offsets).alias("offset"))
        .select("item", "wh", (F.col("sunday") + F.col("offset")).alias("day"))
        .distinct()
    )
    qty = (F.col("item") * 31 + F.col("wh") * 17 + F.col("day")) % 60
    return snaps.select(
        F.col("day").cast("bigint").alias("inv_data_sk"),
        F.col("item").cast("bigint").alias("inv_item_sk"),
        _null_when((F.col("item") + F.col("day")) % 50 == 0, qty).cast("bigint").alias("inv_quantity_on_hand"),
        F.col("wh").cast("bigint").alias("inv_warehouse_sk"),
    )


def inventory_with_gaps(t: Tables) -> DataFrame:
    """The inventory without some item/warehouse pairs: their weeks have sales but no stock row."""
    return inventory(t).where((F.col("inv_item_sk") + F.col("inv_warehouse_sk")) % 23 != 0)


def customer_load(t: Tables, load: int) -> DataFrame:
    """Raw CUSTOMER as delivered by load 0, 1 or 2."""
    c = t.customer
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    nation = F.col("c_nationkey").cast("bigint")
    if load == 0:
        c = c.where(key % 23 != 0)
    elif load == 1:
        c = c.where(key % 29 != 1)
        segment = F.when(key % 17 == 0, F.lit(None)).when(key % 10 == 0, F.lit("CHANGED")).otherwise(segment)
        nation = _null_when(key % 13 == 0, nation)
    elif load == 2:
        segment = F.when(key % 20 == 0, F.lit("AGAIN")).otherwise(segment)
    else:
        raise ValueError("load must be 0, 1 or 2")
    name = F.col("c_name")
    cols = {
        "c_salutation": segment,
        "c_preferred_cust_flag": F.when(F.col("c_acctbal") >= 0, F.lit("Y")).otherwise(F.lit("N")),
        "c_first_sales_date_sk": _null_when(key % 7 == 0, key + 2450000),
        "c_customer_sk": key,
        "c_login": F.lower(name),
        "c_current_cdemo_sk": nation,
        "c_first_name": F.split_part(name, F.lit("#"), F.lit(1)),
        "c_current_hdemo_sk": nation,
        "c_current_addr_sk": key,
        "c_last_name": F.split_part(name, F.lit("#"), F.lit(2)),
        "c_customer_id": name,
        "c_last_review_date_sk": F.lit(None),
        "c_birth_month": key % 12 + 1,
        "c_birth_country": F.lit("UNKNOWN"),
        "c_birth_year": key % 60 + 1940,
        "c_birth_day": key % 28 + 1,
        "c_email_address": F.concat(F.lower(name), F.lit("@mail.test")),
        "c_first_shipto_date_sk": _null_when(key % 7 == 0, key + 2450010),
    }
    text = {"c_salutation", "c_preferred_cust_flag", "c_login", "c_first_name", "c_last_name",
            "c_customer_id", "c_birth_country", "c_email_address"}
    return c.select(*[cols[n].cast("string" if n in text else "bigint").alias(n) for n in CUSTOMER_COLUMNS])


def customer_address(t: Tables) -> DataFrame:
    """One address row per customer with orders (customers without orders have none)."""
    o = t.orders.groupBy("o_custkey").agg(
        F.max("o_orderpriority").alias("max_prio"),
        F.min("o_orderpriority").alias("min_prio"),
        F.max("o_orderstatus").alias("max_status"),
        F.min("o_orderstatus").alias("min_status"),
        F.min("o_orderkey").alias("first_order"),
        F.max("o_orderkey").alias("last_order"),
        F.min("o_orderdate").alias("first_date"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    return o.select(
        F.col("o_custkey").cast("bigint").alias("ca_address_sk"),
        F.col("max_prio").alias("ca_street_name"),
        F.col("last_order").cast("string").alias("ca_suite_number"),
        F.col("max_status").alias("ca_state"),
        F.col("min_status").alias("ca_location_type"),
        F.lit("United States").alias("ca_country"),
        F.col("o_custkey").cast("string").alias("ca_address_id"),
        F.year("first_date").cast("string").alias("ca_county"),
        F.col("first_order").cast("string").alias("ca_street_number"),
        F.col("n_orders").cast("string").alias("ca_zip"),
        F.col("min_prio").alias("ca_city"),
        (F.lit(-5) - F.col("o_custkey") % 4).cast("double").alias("ca_gmt_offset"),
    )


def customer_demographics(t: Tables) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return t.nation.select(
        n.alias("cd_demo_sk"),
        F.when(n % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("cd_gender"),
        F.when(n % 3 == 0, F.lit("S")).otherwise(F.lit("M")).alias("cd_marital_status"),
        F.lower(F.col("n_name")).alias("cd_education_status"),
        ((n + 1) * 500).alias("cd_purchase_estimate"),
        F.col("n_name").alias("cd_credit_rating"),
        (n % 5).alias("cd_dep_count"),
        F.col("n_regionkey").cast("bigint").alias("cd_dep_employed_count"),
        (n % 3).alias("cd_dep_college_count"),
    )


def household_demographics(t: Tables) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return t.nation.select(
        n.alias("hd_demo_sk"),
        F.col("n_regionkey").cast("bigint").alias("hd_income_band_sk"),
        F.col("n_name").alias("hd_buy_potential"),
        (n % 4).alias("hd_dep_count"),
        (n % 3).alias("hd_vehicle_count"),
    )


def income_band(t: Tables) -> DataFrame:
    r = F.col("r_regionkey").cast("bigint")
    return t.region.select(
        r.alias("ib_income_band_sk"),
        (r * 10000).alias("ib_lower_bound"),
        (r * 10000 + 9999).alias("ib_upper_bound"),
    )


def item(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("bigint").alias("i_item_sk"),
        F.col("p_name").alias("i_product_name"),
        F.col("p_brand").alias("i_brand"),
        F.col("p_type").alias("i_category"),
        F.col("p_retailprice").alias("i_current_price"),
    )


def warehouse(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").cast("bigint").alias("w_warehouse_sk"),
        F.col("s_name").alias("w_warehouse_name"),
    )


# The inventory CSV drop's line kinds, chosen per row by
# ``(inv_item_sk * 7 + inv_data_sk) % 20``: 0 too short, 1 too long,
# 2 non-numeric key, 3 empty NOT NULL key, 4 all fields quoted (valid),
# 5 empty quantity (valid, NULL); any other value is a plain valid line.
INVENTORY_CSV_HEADER = "inv_data_sk,inv_item_sk,inv_quantity_on_hand,inv_warehouse_sk"


def inventory_line_kind(inv: DataFrame):
    return (F.col("inv_item_sk") * 7 + F.col("inv_data_sk")) % 20


def inventory_csv_lines(inv: DataFrame) -> DataFrame:
    """The inventory as CSV text lines (column ``value``), with broken lines and a header."""
    kind = inventory_line_kind(inv)
    d = F.col("inv_data_sk").cast("string")
    i = F.col("inv_item_sk").cast("string")
    q = F.coalesce(F.col("inv_quantity_on_hand").cast("string"), F.lit(""))
    w = F.col("inv_warehouse_sk").cast("string")

    def quoted(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    line = (
        F.when(kind == 0, F.concat_ws(",", d, i, q))
        .when(kind == 1, F.concat_ws(",", d, i, q, w, F.lit("99")))
        .when(kind == 2, F.concat_ws(",", F.concat(F.lit("x"), d), i, q, w))
        .when(kind == 3, F.concat_ws(",", d, F.lit(""), q, w))
        .when(kind == 4, F.concat_ws(",", quoted(d), quoted(i), quoted(q), quoted(w)))
        .when(kind == 5, F.concat_ws(",", d, i, F.lit(""), w))
        .otherwise(F.concat_ws(",", d, i, q, w))
    )
    header = inv.sparkSession.range(1).select(F.lit(INVENTORY_CSV_HEADER).alias("value"))
    return header.unionByName(inv.select(line.alias("value")))
