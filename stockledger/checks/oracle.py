"""Oracle SQL (DuckDB dialect) for every registered query.

Each string is self-contained: it rebuilds the retail fixture views from the
driver tables (``lineitem``, ``customer``, ``orders`` ...) as CTEs and states
the result's meaning over them, in another form than the jobs compute it:
fan-outs are factors on sums taken once, memberships are ``IN`` and
``EXCEPT``, and an incremental key unrolls its runs as "stored rows without
the watermark slice, then the batch", so a full recompute would fail it.
"""

from __future__ import annotations

from stockledger.schemas import CUSTOMER_COLUMNS, CUSTOMER_DIM_COLUMNS

# --------------------------------------------------------------------------
# fixture views


def _calendar(name: str, rule: str) -> str:
    if rule == "sunday":
        wk = "CAST((dayofyear(cal_dt - CAST(dayofweek(cal_dt) AS INTEGER)) - 1) // 7 + 1 AS INTEGER)"
        yr = "CAST(year(cal_dt - CAST(dayofweek(cal_dt) AS INTEGER)) AS INTEGER)"
    elif rule == "iso_calendar":
        wk, yr = "CAST(weekofyear(cal_dt) AS INTEGER)", "CAST(year(cal_dt) AS INTEGER)"
    else:
        wk = "CAST((dayofyear(cal_dt) + 6 - dayofweek(cal_dt)) // 7 AS INTEGER)"
        yr = "CAST(year(cal_dt) AS INTEGER)"
    return f"""{name} AS (
  SELECT CAST(cal_dt - DATE '1970-01-01' AS BIGINT) AS d_date_sk,
         cal_dt,
         {wk} AS wk_num,
         {yr} AS yr_num,
         CAST(dayofweek(cal_dt) AS INTEGER) AS day_of_wk_num
  FROM cal_days)"""


_CAL_DAYS = """cal_days AS (
  SELECT CAST(DATE '1970-01-01' + CAST(sk AS INTEGER) AS DATE) AS cal_dt
  FROM (SELECT unnest(generate_series(
          CAST(CAST(min(l_shipdate) AS DATE) - DATE '1970-01-01' AS BIGINT) - dayofweek(CAST(min(l_shipdate) AS DATE)),
          CAST(CAST(max(l_shipdate) AS DATE) - DATE '1970-01-01' AS BIGINT))) AS sk
        FROM lineitem))"""


def _channel(p: str, where: str) -> str:
    return f"""SELECT
    CAST(CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_suppkey % 6 + 1 END AS BIGINT) AS {p}warehouse_sk,
    CAST(l_partkey AS BIGINT) AS {p}item_sk,
    CAST(CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) - DATE '1970-01-01' END AS BIGINT) AS {p}sold_date_sk,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS {p}quantity,
    CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS {p}sales_price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS {p}net_profit,
    CAST(l_orderkey AS BIGINT) AS {p}order_number,
    CAST(l_linenumber AS BIGINT) AS {p}line_number
  FROM lineitem WHERE {where}"""


def _customer_load(k: int) -> str:
    seg, nat, where = "c_mktsegment", "c_nationkey", "TRUE"
    if k == 0:
        where = "c_custkey % 23 <> 0"
    elif k == 1:
        where = "c_custkey % 29 <> 1"
        seg = ("CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'CHANGED' "
               "ELSE c_mktsegment END")
        nat = "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END"
    else:
        seg = "CASE WHEN c_custkey % 20 = 0 THEN 'AGAIN' ELSE c_mktsegment END"
    return f"""cust{k} AS (
  SELECT CAST({seg} AS VARCHAR) AS c_salutation,
         CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
         CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey + 2450000 END AS BIGINT) AS c_first_sales_date_sk,
         CAST(c_custkey AS BIGINT) AS c_customer_sk,
         lower(c_name) AS c_login,
         CAST({nat} AS BIGINT) AS c_current_cdemo_sk,
         split_part(c_name, '#', 1) AS c_first_name,
         CAST({nat} AS BIGINT) AS c_current_hdemo_sk,
         CAST(c_custkey AS BIGINT) AS c_current_addr_sk,
         split_part(c_name, '#', 2) AS c_last_name,
         c_name AS c_customer_id,
         CAST(NULL AS BIGINT) AS c_last_review_date_sk,
         CAST(c_custkey % 12 + 1 AS BIGINT) AS c_birth_month,
         'UNKNOWN' AS c_birth_country,
         CAST(c_custkey % 60 + 1940 AS BIGINT) AS c_birth_year,
         CAST(c_custkey % 28 + 1 AS BIGINT) AS c_birth_day,
         lower(c_name) || '@mail.test' AS c_email_address,
         CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey + 2450010 END AS BIGINT) AS c_first_shipto_date_sk
  FROM customer WHERE {where})"""


# The literal merge's column split. Ten attributes are compared
# with plain "=" (a NULL never matches), eight through COALESCE(x, 0).
PLAIN = ("c_salutation", "c_preferred_cust_flag", "c_customer_sk", "c_login", "c_first_name",
         "c_current_addr_sk", "c_last_name", "c_customer_id", "c_birth_country", "c_email_address")
COALESCED = ("c_first_sales_date_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_last_review_date_sk",
             "c_birth_month", "c_birth_year", "c_birth_day", "c_first_shipto_date_sk")

RUN_DATES = ("2024-01-01", "2024-01-02", "2024-01-03")


def _scd2_steps(strict: bool, prefix: str) -> list[str]:
    cols = ", ".join(f"s.{c}" for c in CUSTOMER_COLUMNS)
    tcols = ", ".join(f"t.{c}" for c in CUSTOMER_COLUMNS)
    if strict:
        match = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in CUSTOMER_COLUMNS) + " AND t.end_date IS NULL"
        changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in CUSTOMER_COLUMNS if c != "c_customer_sk")
        changed = f"t.end_date IS NULL AND ({changed})"
        src = "(SELECT DISTINCT * FROM cust{k})"
    else:
        match = " AND ".join([f"t.{c} = s.{c}" for c in PLAIN] + [f"coalesce(t.{c}, 0) = coalesce(s.{c}, 0)" for c in COALESCED])
        changed = " OR ".join([f"t.{c} != s.{c}" for c in PLAIN if c != "c_customer_sk"]
                              + [f"coalesce(t.{c}, 0) != coalesce(s.{c}, 0)" for c in COALESCED])
        src = "cust{k}"
    out = []
    prev = None
    for k, day in enumerate(RUN_DATES):
        ts = f"TIMESTAMP '{day} 00:00:00'"
        s = src.format(k=k)
        ins = f"""SELECT {cols}, {ts} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date
    FROM {s} s"""
        if prev is None:
            out.append(f"{prefix}{k} AS (\n  {ins})")
        else:
            out.append(f"""{prefix}{k} AS (
  SELECT {tcols}, t.start_date,
         CASE WHEN s.c_customer_sk IS NOT NULL AND ({changed}) THEN {ts} ELSE t.end_date END AS end_date
    FROM {prev} t LEFT JOIN {s} s ON t.c_customer_sk = s.c_customer_sk
  UNION ALL
  {ins}
    WHERE NOT EXISTS (SELECT 1 FROM {prev} t WHERE {match}))""")
        prev = f"{prefix}{k}"
    return out


_FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "cal_days": ((), _CAL_DAYS),
    "date_dim": (("cal_days",), _calendar("date_dim", "sunday")),
    "date_dim_u": (("cal_days",), _calendar("date_dim_u", "calendar_u")),
    "date_dim_iso": (("cal_days",), _calendar("date_dim_iso", "iso_calendar")),
    "catalog_sales": ((), f"catalog_sales AS (\n  {_channel('cs_', 'l_linenumber <= 4')})"),
    "web_sales": ((), f"web_sales AS (\n  {_channel('ws_', 'l_linenumber > 4')})"),
    "inventory": (("catalog_sales", "web_sales"), """inv_keys AS (
  SELECT cs_item_sk AS item, cs_warehouse_sk AS wh, cs_sold_date_sk - (cs_sold_date_sk + 4) % 7 AS sunday
    FROM catalog_sales WHERE cs_warehouse_sk IS NOT NULL AND cs_sold_date_sk IS NOT NULL
  UNION ALL
  SELECT ws_item_sk, ws_warehouse_sk, ws_sold_date_sk - (ws_sold_date_sk + 4) % 7
    FROM web_sales WHERE ws_warehouse_sk IS NOT NULL AND ws_sold_date_sk IS NOT NULL),
inv_snaps AS (
  SELECT DISTINCT item, wh, sunday + off AS day
  FROM (SELECT item, wh, sunday,
               unnest(CASE WHEN item % 10 = 0 THEN [2, 4, 9] ELSE [2, 9] END) AS off
          FROM inv_keys)),
inventory AS (
  SELECT CAST(day AS BIGINT) AS inv_data_sk,
         CAST(item AS BIGINT) AS inv_item_sk,
         CAST(CASE WHEN (item + day) % 50 = 0 THEN NULL ELSE (item * 31 + wh * 17 + day) % 60 END AS BIGINT)
           AS inv_quantity_on_hand,
         CAST(wh AS BIGINT) AS inv_warehouse_sk
  FROM inv_snaps)"""),
    "stock": (("inventory",), """stock AS (
  SELECT * FROM inventory WHERE (inv_item_sk + inv_warehouse_sk) % 23 <> 0)"""),
    "csv_good": (("inventory",), """csv_good AS (
  SELECT inv_data_sk, inv_item_sk, inv_warehouse_sk,
         CASE WHEN (inv_item_sk * 7 + inv_data_sk) % 20 <> 5 THEN inv_quantity_on_hand END AS inv_quantity_on_hand
  FROM inventory WHERE (inv_item_sk * 7 + inv_data_sk) % 20 >= 4)"""),
    "cust0": ((), _customer_load(0)),
    "cust1": ((), _customer_load(1)),
    "cust2": ((), _customer_load(2)),
    "snapshot": (("cust0", "cust1", "cust2"), ",\n".join(_scd2_steps(False, "snap"))),
    "snapshot_strict": (("cust0", "cust1", "cust2"), ",\n".join(_scd2_steps(True, "ssnap"))),
    "customer_address": ((), """customer_address AS (
  SELECT CAST(o_custkey AS BIGINT) AS ca_address_sk,
         max(o_orderpriority) AS ca_street_name,
         CAST(max(o_orderkey) AS VARCHAR) AS ca_suite_number,
         max(o_orderstatus) AS ca_state,
         min(o_orderstatus) AS ca_location_type,
         'United States' AS ca_country,
         CAST(o_custkey AS VARCHAR) AS ca_address_id,
         CAST(year(min(o_orderdate)) AS VARCHAR) AS ca_county,
         CAST(min(o_orderkey) AS VARCHAR) AS ca_street_number,
         CAST(count(*) AS VARCHAR) AS ca_zip,
         min(o_orderpriority) AS ca_city,
         CAST(-5 - o_custkey % 4 AS DOUBLE) AS ca_gmt_offset
  FROM orders GROUP BY o_custkey)"""),
    "customer_demographics": ((), """customer_demographics AS (
  SELECT CAST(n_nationkey AS BIGINT) AS cd_demo_sk,
         CASE WHEN n_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS cd_gender,
         CASE WHEN n_nationkey % 3 = 0 THEN 'S' ELSE 'M' END AS cd_marital_status,
         lower(n_name) AS cd_education_status,
         CAST((n_nationkey + 1) * 500 AS BIGINT) AS cd_purchase_estimate,
         n_name AS cd_credit_rating,
         CAST(n_nationkey % 5 AS BIGINT) AS cd_dep_count,
         CAST(n_regionkey AS BIGINT) AS cd_dep_employed_count,
         CAST(n_nationkey % 3 AS BIGINT) AS cd_dep_college_count
  FROM nation)"""),
    "household_demographics": ((), """household_demographics AS (
  SELECT CAST(n_nationkey AS BIGINT) AS hd_demo_sk,
         CAST(n_regionkey AS BIGINT) AS hd_income_band_sk,
         n_name AS hd_buy_potential,
         CAST(n_nationkey % 4 AS BIGINT) AS hd_dep_count,
         CAST(n_nationkey % 3 AS BIGINT) AS hd_vehicle_count
  FROM nation)"""),
    "income_band": ((), """income_band AS (
  SELECT CAST(r_regionkey AS BIGINT) AS ib_income_band_sk,
         CAST(r_regionkey * 10000 AS BIGINT) AS ib_lower_bound,
         CAST(r_regionkey * 10000 + 9999 AS BIGINT) AS ib_upper_bound
  FROM region)"""),
    "item": ((), """item AS (
  SELECT CAST(p_partkey AS BIGINT) AS i_item_sk, p_name AS i_product_name, p_brand AS i_brand,
         p_type AS i_category, p_retailprice AS i_current_price
  FROM part)"""),
    "warehouse": ((), """warehouse AS (
  SELECT CAST(s_suppkey AS BIGINT) AS w_warehouse_sk, s_name AS w_warehouse_name FROM supplier)"""),
}


# Every usable sales line of both channels, one relation: who, what, when, how much.
_LINES = """lines AS (
  SELECT u.wh, u.item, u.day, u.qty, CAST(u.price * u.qty AS DECIMAL(38,4)) AS amt, CAST(u.profit AS DECIMAL(38,4)) AS profit, u.ord
  FROM (SELECT cs_warehouse_sk, cs_item_sk, cs_sold_date_sk, cs_quantity, cs_sales_price, cs_net_profit, cs_order_number FROM catalog_sales
        UNION ALL FROM web_sales SELECT ws_warehouse_sk, ws_item_sk, ws_sold_date_sk, ws_quantity, ws_sales_price, ws_net_profit, ws_order_number
       ) u(wh, item, day, qty, price, profit, ord)
  WHERE u.day >= 0 AND u.qty IS NOT NULL AND u.price IS NOT NULL)"""


def _daily(name: str, cal: str, where: str = "TRUE") -> str:
    """Day sums of the lines; a day that the calendar holds more than once counts as often."""
    return f"""{name} AS (
  SELECT l.wh AS warehouse_sk, l.item AS item_sk, l.day AS sold_date_sk,
         CAST(any_value(c.wk) AS BIGINT) AS sold_wk_num, CAST(any_value(c.yr) AS BIGINT) AS sold_yr_num,
         CAST(coalesce(any_value(c.times), 1) * sum(l.qty) AS BIGINT) AS daily_qty,
         CAST(coalesce(any_value(c.times), 1) * sum(l.amt) AS DOUBLE) AS daily_sales_amt,
         CAST(coalesce(any_value(c.times), 1) * sum(l.profit) AS DOUBLE) AS daily_net_profit
  FROM lines l LEFT JOIN (SELECT d_date_sk AS day, max(wk_num) AS wk, max(yr_num) AS yr, count(*) AS times FROM {cal} GROUP BY d_date_sk) c USING (day)
  WHERE {where}
  GROUP BY ALL)"""


def _weekly(name: str, cal: str, daily: str, stock: str = "stock", since: str = "0") -> str:
    """Week sums from the days, stock summed on its own; the number of Sundays and of
    stock rows of a week multiply the sums. Weeks that begin before ``since`` stay out."""
    return f"""{name}_sales AS (
  SELECT warehouse_sk AS wh, item_sk AS item, sold_wk_num AS wk, sold_yr_num AS yr, sum(daily_qty) AS qty,
         sum(CAST(daily_sales_amt AS DECIMAL(38,4))) AS amt, sum(CAST(daily_net_profit AS DECIMAL(38,4))) AS profit
  FROM {daily} GROUP BY ALL HAVING min(sold_date_sk) >= {since}),
{name}_sunday AS (
  SELECT wk_num AS wk, yr_num AS yr, min(d_date_sk) AS first, count(*) AS times
  FROM {cal} WHERE day_of_wk_num = 0 GROUP BY ALL),
{name}_stock AS (
  SELECT s.inv_warehouse_sk AS wh, s.inv_item_sk AS item, c.wk_num AS wk, c.yr_num AS yr,
         sum(coalesce(s.inv_quantity_on_hand, 0)) AS on_hand, count(*) AS times
  FROM {stock} s, {cal} c WHERE c.d_date_sk = s.inv_data_sk GROUP BY ALL),
{name}_joined AS (
  SELECT w.wh, w.item, w.wk, w.yr, d.first,
         CAST(w.qty * d.times * coalesce(s.times, 1) AS DECIMAL(38,0)) AS qty,
         w.amt * d.times * coalesce(s.times, 1) AS amt, w.profit * d.times * coalesce(s.times, 1) AS profit,
         CAST(coalesce(s.on_hand, 0) * d.times AS DECIMAL(38,0)) AS on_hand
  FROM {name}_sales w JOIN {name}_sunday d USING (wk, yr) LEFT JOIN {name}_stock s USING (wh, item, wk, yr)),
{name} AS (
  SELECT wh AS warehouse_sk, item AS item_sk, CAST(first AS BIGINT) AS sold_wk_sk, wk AS sold_wk_num, yr AS sold_yr_num,
         CAST(qty AS BIGINT) AS sum_qty_wk, CAST(amt AS DOUBLE) AS sum_amt_wk, CAST(profit AS DOUBLE) AS sum_profit_wk,
         CAST(qty / 7 AS DECIMAL(38,6)) AS avg_qty_dy, CAST(on_hand AS BIGINT) AS inv_qty_wk,
         CAST(on_hand / qty AS DECIMAL(38,6)) AS wks_sply, CAST(qty / 7 AS DECIMAL(38,6)) > on_hand AS low_stock_flg_wk
  FROM {name}_joined WHERE qty > 0)"""


_SOURCES = ("catalog_sales", "web_sales")
_CUT, _ISO_CUT = 10450, 11139  # the cut days of the incremental keys
_DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (_SOURCES, _LINES),
    "daily": (("date_dim", "lines"), _daily("daily", "date_dim")),
    "daily_u": (("date_dim_u", "lines"), _daily("daily_u", "date_dim_u")),
    "weekly": (("daily", "stock"), _weekly("weekly", "date_dim", "daily")),
    "weekly_u": (("daily_u", "stock"), _weekly("weekly_u", "date_dim_u", "daily_u")),
    "weekly_csv": (("daily", "csv_good"), _weekly("weekly_csv", "date_dim", "daily", "csv_good")),
    "daily_late": (("date_dim", "lines"), _daily("daily_late", "date_dim", f"(l.day < {_CUT} OR (l.day = {_CUT} AND l.ord % 2 = 0)) AND l.ord % 7 <> 0")),
    "daily_cut": (("date_dim", "lines"), _daily("daily_cut", "date_dim", f"l.day <= {_CUT}")),
    "daily_iso": (("date_dim_iso", "lines"), _daily("daily_iso", "date_dim_iso")),
    "daily_iso_early": (("date_dim_iso", "lines"), _daily("daily_iso_early", "date_dim_iso", f"l.day < {_ISO_CUT}")),
    "weekly_iso_1": (("daily_iso_early", "stock"), _weekly("weekly_iso_1", "date_dim_iso", "daily_iso_early")),
    "weekly_iso_2": (("weekly_iso_1", "daily_iso"), _weekly("weekly_iso_2", "date_dim_iso", "daily_iso", since="(SELECT max(sold_wk_sk) FROM weekly_iso_1)")),
    "customer_dim": (
        ("snapshot", "customer_address", "customer_demographics", "household_demographics", "income_band"),
        "customer_dim AS (\n  SELECT " + ",\n         ".join(CUSTOMER_DIM_COLUMNS) + """
  FROM snap2
  LEFT JOIN customer_address ON c_current_addr_sk = ca_address_sk
  LEFT JOIN customer_demographics ON c_current_cdemo_sk = cd_demo_sk
  LEFT JOIN household_demographics ON c_current_hdemo_sk = hd_demo_sk
  LEFT JOIN income_band ON hd_income_band_sk = ib_income_band_sk
  WHERE end_date IS NULL)""",
    ),
}
_ALL = {**_FIXTURES, **_DERIVED}


def with_views(*names: str, body: str) -> str:
    """``WITH`` clause holding the named views (and what they need), then body."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _ALL[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(_ALL[n][1] for n in order) + "\n" + body


# --------------------------------------------------------------------------
# queries

_Q: dict[str, str] = {}

_Q["sales_union"] = with_views("lines", body="""
SELECT wh AS warehouse_sk, item AS item_sk, day AS sold_date_sk, qty AS quantity, CAST(amt AS DECIMAL(38,2)) AS sales_amt, profit AS net_profit
FROM lines""")

_Q["daily_sales"] = with_views("daily", body="SELECT * FROM daily")
_Q["daily_sales_incremental"] = _Q["daily_sales"]

_Q["inventory_with_week"] = with_views("inventory", "date_dim", body="""
SELECT inventory.*, d.wk_num AS inv_wk_num, d.yr_num AS inv_yr_num
FROM inventory JOIN date_dim d ON inventory.inv_data_sk = d.d_date_sk""")

_Q["weekly_sales_inventory"] = with_views("weekly", body="SELECT * FROM weekly")
_Q["weekly_sales_incremental"] = _Q["weekly_sales_inventory"]
_Q["weekly_incremental_iso_calendar"] = with_views("weekly_iso_2", body="""
SELECT * FROM weekly_iso_1 WHERE sold_wk_sk <> (SELECT max(sold_wk_sk) FROM weekly_iso_1) UNION ALL SELECT * FROM weekly_iso_2""")
_Q["daily_late_rows"] = with_views("daily_late", "daily", body="""
SELECT * FROM daily_late WHERE sold_date_sk < (SELECT max(sold_date_sk) FROM daily_late)
UNION ALL SELECT * FROM daily WHERE sold_date_sk >= (SELECT max(sold_date_sk) FROM daily_late)""")
_Q["daily_vanished_slice"] = with_views("daily_cut", body="""
SELECT * FROM daily_cut WHERE sold_date_sk <> (SELECT max(sold_date_sk) FROM daily_cut)""")
_Q["ingest_to_weekly"] = with_views("weekly_csv", body="FROM weekly_csv")
_Q["weekly_from_raw"] = _Q["weekly_sales_inventory"]
_Q["daily_sales_sql"] = _Q["daily_sales"]
_Q["daily_late_report"] = with_views("lines", body=f"""
SELECT day AS sold_date_sk, count(*) FILTER (had) AS n_stored, count(*) AS n_source,
       CAST(coalesce(sum(qty) FILTER (had), 0) AS BIGINT) AS qty_stored, CAST(sum(qty) AS BIGINT) AS qty_source
FROM (SELECT *, ord % 7 <> 0 AS had FROM lines WHERE day < (SELECT max(day) FROM lines WHERE (day < {_CUT} OR (day = {_CUT} AND ord % 2 = 0)) AND ord % 7 <> 0))
GROUP BY day HAVING count(*) FILTER (NOT had) > 0""")
_Q["explore_cardinality_by_day"] = with_views("lines", "date_dim", body="""
SELECT CAST(NULL AS INTEGER) AS year, count(DISTINCT item) AS n_distinct FROM lines
UNION ALL SELECT d.yr_num, count(DISTINCT l.item) FROM lines l JOIN date_dim d ON d.d_date_sk = l.day GROUP BY d.yr_num""")
_Q["weekly_missing_sunday"] = with_views("weekly_u", body="SELECT * FROM weekly_u")



# --- customers -----------------------------------------------------------------

_Q["customer_scd2"] = with_views("snapshot", body="SELECT * FROM snap2")
_Q["customer_scd2_strict"] = with_views("snapshot_strict", body="SELECT * FROM ssnap2")
_Q["customer_dim_current"] = with_views("customer_dim", body="SELECT * FROM customer_dim")

# --- copies and CSV ingest ----------------------------------------------------

_Q["dim_snapshot_copy"] = with_views("item", "warehouse", "date_dim", body="""
SELECT 'item_dim' AS table_name, count(*) AS n_rows, min(i_item_sk) AS min_key, max(i_item_sk) AS max_key FROM item
UNION ALL
SELECT 'warehouse_dim', count(*), min(w_warehouse_sk), max(w_warehouse_sk) FROM warehouse
UNION ALL
SELECT 'date_dim', count(*), min(d_date_sk), max(d_date_sk) FROM date_dim""")

_Q["csv_ingest_skip_bad"] = with_views("csv_good", body="FROM csv_good")
_Q["csv_full_refresh"] = _Q["csv_ingest_skip_bad"]
_Q["csv_rejected_lines"] = with_views("inventory", body="""
SELECT 'inv_data_sk,inv_item_sk,inv_quantity_on_hand,inv_warehouse_sk' AS line
UNION ALL
SELECT CASE kind WHEN 0 THEN d || ',' || i || ',' || q
                 WHEN 1 THEN d || ',' || i || ',' || q || ',' || w || ',99'
                 WHEN 2 THEN 'x' || d || ',' || i || ',' || q || ',' || w
                 ELSE d || ',,' || q || ',' || w END
FROM (SELECT (inv_item_sk * 7 + inv_data_sk) % 20 AS kind, CAST(inv_data_sk AS VARCHAR) AS d, CAST(inv_item_sk AS VARCHAR) AS i,
             coalesce(CAST(inv_quantity_on_hand AS VARCHAR), '') AS q, CAST(inv_warehouse_sk AS VARCHAR) AS w FROM inventory)
WHERE kind < 4""")
_Q["csv_truncate_reload"] = with_views("csv_good", body="""
SELECT 'loaded' AS step, count(*) AS n_rows, CAST(sum(inv_quantity_on_hand) AS BIGINT) AS on_hand FROM csv_good
UNION ALL SELECT 'truncated', 0, NULL
UNION ALL SELECT 'reloaded', count(*), CAST(sum(inv_quantity_on_hand) AS BIGINT) FROM csv_good WHERE inv_warehouse_sk <= 3""")

# --- data quality ----------------------------------------------------------------


def _verdicts(*checks: tuple[str, str]) -> str:
    """One row a check: ``(name, expression that counts what fails)``."""
    rows = ", ".join(f"('{name}', ({count}))" for name, count in checks)
    return f"SELECT v.check_name, CAST(v.n AS BIGINT) AS n_failing, v.n = 0 AS passed FROM (VALUES {rows}) v(check_name, n)"


_Q["dq_not_null"] = with_views("customer_dim", "lines", body=_verdicts(
    ("customer_dim.c_customer_sk", "SELECT count(*) - count(c_customer_sk) FROM customer_dim"),
    ("sales_lines.warehouse_sk", "SELECT count(*) - count(wh) FROM lines")))

_Q["dq_unique"] = with_views("weekly", "inventory", "date_dim", body=_verdicts(
    ("weekly_sales_inventory(warehouse_sk,item_sk,sold_wk_sk)",
     "SELECT count(DISTINCT k) FROM (SELECT (warehouse_sk, item_sk, sold_wk_sk) AS k, row_number() OVER (PARTITION BY warehouse_sk, item_sk, sold_wk_sk) AS nth FROM weekly) WHERE nth = 2"),
    ("inventory(inv_item_sk,inv_warehouse_sk,inv_wk_num,inv_yr_num)",
     "SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY i.inv_item_sk, i.inv_warehouse_sk, c.wk_num, c.yr_num) AS nth "
     "FROM inventory i, date_dim c WHERE c.d_date_sk = i.inv_data_sk) WHERE nth = 2")))

_Q["dq_relationship"] = with_views("weekly", "item", "cust0", body=_verdicts(
    ("weekly_sales_inventory.item_sk->item_dim.i_item_sk",
     "SELECT count(*) FROM weekly w WHERE NOT EXISTS (FROM item i WHERE i.i_item_sk = w.item_sk)"),
    ("orders.o_custkey->customer_load0.c_customer_sk",
     "SELECT coalesce(sum(n), 0) FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY k) WHERE k IN (SELECT o_custkey FROM orders EXCEPT SELECT c_customer_sk FROM cust0)")))

_Q["dq_accepted_values"] = with_views("weekly", "warehouse", body=_verdicts(
    ("weekly_sales_inventory.warehouse_sk", "SELECT count(*) FROM weekly WHERE warehouse_sk < 1 OR warehouse_sk > 6"),
    ("warehouse_dim.w_warehouse_sk", "SELECT count(*) FROM warehouse WHERE w_warehouse_sk < 1 OR w_warehouse_sk > 6")))

_Q["dq_orphan_key"] = with_views("cust2", "customer_demographics", "customer_address", body=_verdicts(
    ("customer.c_current_cdemo_sk->customer_demographics.cd_demo_sk",
     "SELECT count(*) FROM cust2 WHERE c_current_cdemo_sk IN (SELECT c_current_cdemo_sk FROM cust2 EXCEPT SELECT cd_demo_sk FROM customer_demographics)"),
    ("customer.c_current_addr_sk->customer_address.ca_address_sk",
     "SELECT count(*) FROM cust2 WHERE c_current_addr_sk IN (SELECT c_current_addr_sk FROM cust2 EXCEPT SELECT ca_address_sk FROM customer_address)")))

# --- exploration --------------------------------------------------------------------


def _bounds() -> str:
    parts = []
    for src, key in (("catalog_sales", "cs_sold_date_sk"), ("web_sales", "ws_sold_date_sk"),
                     ("inventory", "inv_data_sk")):
        for b in ("min", "max"):
            parts.append(f"SELECT '{src}' AS source, '{b}' AS bound, cal_dt FROM date_dim "
                         f"WHERE d_date_sk = (SELECT {b}({key}) FROM {src})")
    return "\nUNION ALL\n".join(parts)


_Q["explore_date_bounds"] = with_views("date_dim", "inventory", body=_bounds())

_Q["explore_daily_arrivals"] = with_views("date_dim", "catalog_sales", "web_sales", body="""
(SELECT 'catalog_sales' AS channel, d.cal_dt, cs.cs_sold_date_sk AS sold_date_sk, count(*) AS n_rows
   FROM catalog_sales cs JOIN date_dim d ON cs.cs_sold_date_sk = d.d_date_sk
  GROUP BY 1, 2, 3 ORDER BY 2 DESC LIMIT 10)
UNION ALL
(SELECT 'web_sales', d.cal_dt, ws.ws_sold_date_sk, count(*)
   FROM web_sales ws JOIN date_dim d ON ws.ws_sold_date_sk = d.d_date_sk
  GROUP BY 1, 2, 3 ORDER BY 2 DESC LIMIT 10)""")


_DIM_COLUMNS = {
    "date_dim": "d_date_sk cal_dt wk_num yr_num day_of_wk_num",
    "item": "i_item_sk i_product_name i_brand i_category i_current_price",
    "warehouse": "w_warehouse_sk w_warehouse_name",
    "cust2": " ".join(CUSTOMER_COLUMNS),
    "customer_demographics": "cd_demo_sk cd_gender cd_marital_status cd_education_status cd_purchase_estimate cd_credit_rating cd_dep_count cd_dep_employed_count cd_dep_college_count",
    "household_demographics": "hd_demo_sk hd_income_band_sk hd_buy_potential hd_dep_count hd_vehicle_count",
    "customer_address": "ca_address_sk ca_street_name ca_suite_number ca_state ca_location_type ca_country ca_address_id ca_county ca_street_number ca_zip ca_city ca_gmt_offset",
}
_BILLED = """billed AS (
  SELECT cs.*, o.o_custkey AS cs_bill_customer_sk, CAST(c.c_nationkey AS BIGINT) AS cs_bill_cdemo_sk,
         CAST(c.c_nationkey AS BIGINT) AS cs_bill_hdemo_sk, o.o_custkey AS cs_bill_addr_sk
  FROM catalog_sales cs LEFT JOIN orders o ON o.o_orderkey = cs.cs_order_number LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""
_ALL["billed"] = (("catalog_sales",), _BILLED)


def _fk_probe() -> str:
    probes = [(p, fact, key, dim, dk) for p, fact in (("cs_", "billed"), ("ws_", "web_sales"))
              for key, dim, dk in ((f"{p}sold_date_sk", "date_dim", "d_date_sk"), (f"{p}item_sk", "item", "i_item_sk"),
                                   (f"{p}warehouse_sk", "warehouse", "w_warehouse_sk"))]
    probes += [("cs_", "billed", "cs_bill_customer_sk", "cust2", "c_customer_sk"),
               ("cs_", "billed", "cs_bill_cdemo_sk", "customer_demographics", "cd_demo_sk"),
               ("cs_", "billed", "cs_bill_hdemo_sk", "household_demographics", "hd_demo_sk"),
               ("cs_", "billed", "cs_bill_addr_sk", "customer_address", "ca_address_sk")]
    parts = []
    for p, fact, key, dim, dk in probes:
        text = " || '|' || ".join(f"coalesce(CAST(d.{c} AS VARCHAR), '')" for c in _DIM_COLUMNS[dim].split())
        parts.append(f"""SELECT '{key}->{dk}' AS probe, x.kind, x.value, x.order_number, x.line_number, x.dim_row FROM (
  SELECT 'count' AS kind, (SELECT count(*) FROM {fact} WHERE {key} IN (SELECT {dk} FROM {dim})) AS value,
         CAST(NULL AS BIGINT) AS order_number, CAST(NULL AS BIGINT) AS line_number, CAST(NULL AS VARCHAR) AS dim_row
  UNION ALL
  SELECT 'sample', k, o, n, t FROM (
    SELECT f.{key} AS k, f.{p}order_number AS o, f.{p}line_number AS n, {text} AS t,
           row_number() OVER (ORDER BY f.{key}, f.{p}order_number, f.{p}line_number) AS nth
    FROM {fact} f, {dim} d WHERE d.{dk} = f.{key}) WHERE nth <= 5) x""")
    return "\nUNION ALL\n".join(parts)


_Q["explore_fk_probe"] = with_views("date_dim", "billed", "web_sales", "item", "warehouse", "cust2", "customer_demographics",
                                    "household_demographics", "customer_address", body=_fk_probe())

_COLS = ("warehouse_sk", "item_sk", "sold_date_sk", "quantity", "sales_price", "net_profit", "order_number",
         "line_number")
_PREVIEW_ORDER = ("order_number", "line_number", "warehouse_sk", "item_sk", "sold_date_sk", "quantity",
                  "sales_price", "net_profit")


def _preview(name: str, p: str) -> str:
    cols = ", ".join(f"{p}{c} AS {c}" for c in _COLS)
    order = ", ".join(f"{p}{c} NULLS FIRST" for c in _PREVIEW_ORDER)
    return f"(SELECT '{name}' AS channel, {cols} FROM {name} ORDER BY {order} LIMIT 100)"


_Q["explore_sales_preview"] = with_views(
    "catalog_sales", "web_sales", body=_preview("catalog_sales", "cs_") + "\nUNION ALL\n" + _preview("web_sales", "ws_"))

_Q["explore_inventory_counts"] = with_views("inventory", body="""
SELECT inv_data_sk, inv_item_sk, count(*) AS n_rows FROM inventory GROUP BY 1, 2 ORDER BY 2, 1""")

_Q["explore_item_days"] = with_views("date_dim", "inventory", "catalog_sales", "web_sales", "item", body="""
SELECT s.source, c.cal_dt, c.wk_num
FROM (SELECT 'inventory' AS source, inv_data_sk AS day FROM inventory WHERE inv_item_sk = 1
      UNION SELECT 'catalog_sales', cs_sold_date_sk FROM catalog_sales WHERE cs_item_sk = 1 AND cs_item_sk IN (SELECT i_item_sk FROM item)
      UNION SELECT 'web_sales', ws_sold_date_sk FROM web_sales WHERE ws_item_sk = 1 AND ws_item_sk IN (SELECT i_item_sk FROM item)) s
JOIN date_dim c ON c.d_date_sk = s.day""")

_Q["explore_distinct_items"] = with_views("item", body="""
SELECT DISTINCT i_item_sk, i_product_name FROM item ORDER BY 1""")

_Q["explore_distinct_customers"] = with_views("cust2", body="""
SELECT DISTINCT c_customer_sk, c_first_name, c_last_name FROM cust2 ORDER BY 1""")

_Q["explore_cardinality"] = with_views("item", "cust2", body="""
SELECT 'item.i_item_sk' AS metric, count(DISTINCT i_item_sk) AS n_distinct FROM item
UNION ALL
SELECT 'customer.c_customer_sk', count(DISTINCT c_customer_sk) FROM cust2""")

_Q["customer_null_key_count"] = with_views("cust2", body="""
SELECT count(*) AS n_null FROM cust2 WHERE c_first_sales_date_sk IS NULL""")

_Q["explore_calendar_head"] = with_views("date_dim", body="""
SELECT cal_dt, d_date_sk FROM date_dim ORDER BY 1 LIMIT 100""")

_Q["explore_calendar_day"] = with_views("date_dim", body="""
SELECT * FROM date_dim WHERE cal_dt = '1998-08-12'""")


def queries() -> dict[str, str]:
    return dict(_Q)
