"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the mart's operators over the retail views derived from the whole
driver tables (:mod:`stockledger.sources.fixtures`). Queries that exercise
storage (incremental runs, SCD2 versions, CSV ingest, copies) write their
intermediate tables under the session's shared checkpoint folder and return
the final table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.operators import customers, explore, quality, sales, weekly
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources import csv_ingest
from stockledger.sources import fixtures as fx
from stockledger.sources.bucketed import BucketedHistory
from stockledger.sources.raw import RawTable
from stockledger.sources.storage import SlicedTable, VersionedTable, copy_table, empty_frame, open_table
from stockledger.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- shared building blocks -------------------------------------------------


def lines_of(t: Tables, since_date_sk: int | None = None) -> DataFrame:
    return sales.sales_union(fx.catalog_sales(t), fx.web_sales(t), since_date_sk)


def daily_of(t: Tables, week_rule: str = "sunday") -> DataFrame:
    return sales.daily_sales(lines_of(t), fx.date_dim(t, week_rule))


def weekly_of(t: Tables, week_rule: str = "sunday") -> DataFrame:
    cal = fx.date_dim(t, week_rule)
    return weekly.weekly_sales_inventory(sales.daily_sales(lines_of(t), cal), fx.inventory_with_gaps(t), cal)


# --- sales and weekly fact --------------------------------------------------


@register("sales_union")
def q_sales_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = lines_of(Tables(spark, sf_dir))
    return u.select(
        "warehouse_sk",
        "item_sk",
        "sold_date_sk",
        "quantity",
        F.col("sales_amt").cast("decimal(38,2)").alias("sales_amt"),
        F.col("net_profit").cast("decimal(38,4)").alias("net_profit"),
    )


@register("daily_sales")
def q_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(Tables(spark, sf_dir))


@register("inventory_with_week")
def q_inventory_with_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return weekly.inventory_with_week(fx.inventory(t), fx.date_dim(t))


@register("weekly_sales_inventory")
def q_weekly_sales_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_of(Tables(spark, sf_dir))


@register("weekly_missing_sunday")
def q_weekly_missing_sunday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly fact over a ``%U`` calendar: weeks without a Sunday row lose their sales."""
    return weekly_of(Tables(spark, sf_dir), "calendar_u")


# --- incremental runs over stored tables -----------------------------------

# A Wednesday inside the ship-date span of every scale factor (1998-08-12).
CUT_DAY = 10450


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write a derived raw table once (as the mart stores its raw tables) and read it back."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _arrived_by_cut(df: DataFrame, p: str, half_of_cut_day: bool) -> DataFrame:
    """Sales as they had arrived when the first run happened."""
    d, o = F.col(f"{p}sold_date_sk"), F.col(f"{p}order_number")
    cond = d < F.lit(CUT_DAY)
    if half_of_cut_day:
        cond = cond | ((d == F.lit(CUT_DAY)) & (o % 2 == 0))
    return df.where(cond)


@register("daily_sales_incremental")
def q_daily_sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run with the sales up to half of the cut day, a second with all of
    them, then an identical rerun: the stored table equals a one-shot load."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    table = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    jobs.run_daily_sales(_arrived_by_cut(cs, "cs_", True), _arrived_by_cut(ws, "ws_", True), cal, table)
    jobs.run_daily_sales(cs, ws, cal, table)
    jobs.run_daily_sales(cs, ws, cal, table)
    return table.read()


@register("weekly_sales_incremental")
def q_weekly_sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and weekly jobs run in schedule order, first with sales up to a
    mid-week cut, then with all sales, then the weekly job again."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    inv = stored(spark, fx.inventory_with_gaps(t), "inventory")
    daily_t = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    weekly_t = jobs.weekly_table(spark, shared_dir(spark, "weekly_sales_inventory"))
    jobs.run_daily_sales(_arrived_by_cut(cs, "cs_", False), _arrived_by_cut(ws, "ws_", False), cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    jobs.run_daily_sales(cs, ws, cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    return weekly_t.read()


# A summer day (2000-07-01 .. the span's middle year whose first and last days share ISO week 52).
ISO_CUT_DAY = 11139


@register("weekly_incremental_iso_calendar")
def q_weekly_incremental_iso_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over ISO week numbers beside calendar years: the second run's
    December week has the number and first Sunday of January's, so it adds rows to a slice stored long before."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t, "iso_calendar"), "date_dim")
    inv = stored(spark, fx.inventory_with_gaps(t), "inventory")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    daily_t = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    weekly_t = jobs.weekly_table(spark, shared_dir(spark, "weekly_sales_inventory"))
    early = [x.where(F.col(f"{p}sold_date_sk") < F.lit(ISO_CUT_DAY)) for x, p in ((cs, "cs_"), (ws, "ws_"))]
    jobs.run_daily_sales(*early, cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    jobs.run_daily_sales(cs, ws, cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    return weekly_t.read()


@register("daily_late_rows")
def q_daily_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive behind the watermark stay out: the first run misses every
    seventh order, the second sees all, and only days from the watermark on are made again."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    table = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    first = [_arrived_by_cut(x, p, True).where(F.col(f"{p}order_number") % 7 != 0) for x, p in ((cs, "cs_"), (ws, "ws_"))]
    jobs.run_daily_sales(*first, cal, table)
    jobs.run_daily_sales(cs, ws, cal, table)
    return table.read()


@register("daily_vanished_slice")
def q_daily_vanished_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run's source has lost the last stored day and every eleventh
    older order: the day goes, the stored older days stay as they were."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    table = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    first = [x.where(F.col(f"{p}sold_date_sk") <= F.lit(CUT_DAY)) for x, p in ((cs, "cs_"), (ws, "ws_"))]
    jobs.run_daily_sales(*first, cal, table)
    wm = F.lit(table.last_slice())
    second = [x.where((F.col(f"{p}sold_date_sk") < wm) & (F.col(f"{p}order_number") % 11 != 0)) for x, p in ((cs, "cs_"), (ws, "ws_"))]
    jobs.run_daily_sales(*second, cal, table)
    return table.read()


@register("weekly_from_raw")
def q_weekly_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales and inventory that arrive in two drops and lie in day ranges;
    both jobs run after each drop, the second time on the new ranges alone."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    inv = fx.inventory_with_gaps(t)
    sources = [(fx.catalog_sales(t), "cs_sold_date_sk"), (fx.web_sales(t), "ws_sold_date_sk"), (inv, "inv_data_sk")]
    raw = [RawTable(spark, shared_dir(spark, f"raw_{day}"), df.schema, day) for df, day in sources]
    daily_t = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    weekly_t = jobs.weekly_table(spark, shared_dir(spark, "weekly_sales_inventory"))
    for first in (True, False):
        for table, (df, day) in zip(raw, sources):
            early = F.coalesce(F.col(day) < F.lit(CUT_DAY), F.lit(False))
            table.append(df.where(early if first else ~early))
        jobs.run_daily_from_raw(raw[0], raw[1], cal, daily_t)
        jobs.run_weekly_from_raw(daily_t, raw[2], cal, weekly_t)
    return weekly_t.read()


@register("daily_late_report")
def q_daily_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that :func:`q_daily_late_rows` leaves behind: after the second run the
    report names those that the source has filled up behind the first run's watermark."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    table, marks = jobs.daily_table(spark, shared_dir(spark, "daily_sales")), jobs.marks_table(spark, shared_dir(spark, "daily_marks"))
    first = [_arrived_by_cut(x, p, True).where(F.col(f"{p}order_number") % 7 != 0) for x, p in ((cs, "cs_"), (ws, "ws_"))]
    jobs.run_daily_with_marks(*first, cal, table, marks)
    jobs.run_daily_with_marks(cs, ws, cal, table, marks)
    return jobs.late_day_report(cs, ws, table, marks)


@register("daily_sales_sql")
def q_daily_sales_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job as SQL text with the watermark in a session variable, run before and after a cut."""
    t = Tables(spark, sf_dir)
    stored(spark, fx.date_dim(t), "date_dim").createOrReplaceTempView("sql_date_dim")
    cs, ws = fx.catalog_sales(t), fx.web_sales(t)
    table = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    for early in (True, False):
        for df, p, name in ((cs, "cs_", "sql_catalog_sales"), (ws, "ws_", "sql_web_sales")):
            (_arrived_by_cut(df, p, True) if early else df).createOrReplaceTempView(name)
        jobs.run_daily_sql(spark, "sql_catalog_sales", "sql_web_sales", "sql_date_dim", table)
    return table.read()


@register("explore_cardinality_by_day")
def q_explore_cardinality_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct items sold, in all and by year, from bitmaps stored per day; the second
    run adds the bitmaps of its days and reads no older line."""
    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    bitmaps = SlicedTable(spark, shared_dir(spark, "item_bitmaps"), T._parse_datatype_string("slice bigint, bucket bigint, bits binary"), "slice")
    for early in (True, False):
        wm = bitmaps.last_slice()
        cs, ws = ((_arrived_by_cut(x, p, True) if early else x) for x, p in ((fx.catalog_sales(t), "cs_"), (fx.web_sales(t), "ws_")))
        bitmaps.replace_slice(wm, explore.distinct_bitmaps(sales.sales_union(cs, ws, wm), "sold_date_sk", "item_sk"))
    held = bitmaps.read().join(cal.select(F.col("d_date_sk").alias("slice"), F.col("yr_num").alias("year")), "slice")
    every = explore.distinct_of_bitmaps(held).select(F.lit(None).cast("int").alias("year"), "n_distinct")
    return every.unionByName(explore.distinct_of_bitmaps(held, ["year"]))


# --- customers ----------------------------------------------------------------


def stored_history(spark: SparkSession, t: Tables, strict: bool = False) -> BucketedHistory:
    """The three customer loads applied in order to a history in buckets of the customer key."""
    history = BucketedHistory(spark, shared_dir(spark, "customer_history"), strict)
    for k, day in enumerate(fx.CUSTOMER_LOAD_DATES):
        history.run(fx.customer_load(t, k), day)
    return history


def customer_dim_of(spark: SparkSession, t: Tables) -> DataFrame:
    """The current-customer dimension over the stored history (lazy from there)."""
    return customers.customer_dimension(
        stored_history(spark, t).open_versions(),
        fx.customer_address(t),
        fx.customer_demographics(t),
        fx.household_demographics(t),
        fx.income_band(t),
    )


@register("customer_scd2")
def q_customer_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_history(spark, Tables(spark, sf_dir)).read()


@register("customer_scd2_strict")
def q_customer_scd2_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict history kept as open versions in buckets plus append-only closed versions."""
    return stored_history(spark, Tables(spark, sf_dir), strict=True).read()


@register("customer_dim_current")
def q_customer_dim_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    snap = stored_history(spark, t)
    dim = VersionedTable(spark, shared_dir(spark, "customer_dim"), customer_dim_schema(spark, t))
    jobs.run_customer_dimension(
        snap,
        fx.customer_address(t),
        fx.customer_demographics(t),
        fx.household_demographics(t),
        fx.income_band(t),
        dim,
    )
    return dim.read()


def customer_dim_schema(spark: SparkSession, t: Tables):
    """Schema of the dimension (analysis only; nothing runs)."""
    return customers.customer_dimension(
        empty_frame(spark, schemas.CUSTOMER_SNAPSHOT),
        fx.customer_address(t),
        fx.customer_demographics(t),
        fx.household_demographics(t),
        fx.income_band(t),
    ).schema


# --- dimension copies and CSV ingest -------------------------------------------


@register("dim_snapshot_copy")
def q_dim_snapshot_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CREATE TABLE item_dim / warehouse_dim / date_dim CLONE ...`` then profile the copies."""
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "analytics")
    copies = [
        ("item_dim", fx.item(t), "i_item_sk"),
        ("warehouse_dim", fx.warehouse(t), "w_warehouse_sk"),
        ("date_dim", fx.date_dim(t), "d_date_sk"),
    ]
    out = None
    for name, src, key in copies:
        copy = copy_table(spark, src, f"{root}/{name}")
        prof = copy.agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
        ).select(F.lit(name).alias("table_name"), "n_rows", "min_key", "max_key")
        out = prof if out is None else out.unionByName(prof)
    return out


def _write_drop(spark: SparkSession, lines: DataFrame, purpose: str) -> str:
    path = shared_dir(spark, purpose)
    lines.write.mode("errorifexists").text(path)
    return path


@register("csv_ingest_skip_bad")
def q_csv_ingest_skip_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory written as a CSV drop with broken lines, loaded back: the good rows."""
    t = Tables(spark, sf_dir)
    path = _write_drop(spark, fx.inventory_csv_lines(fx.inventory(t)), "inventory_csv")
    return csv_ingest.read_csv_drop(spark, path).good


@register("csv_full_refresh")
def q_csv_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two successive drops into one table: after the second refresh the table
    holds exactly the second drop's good rows."""
    t = Tables(spark, sf_dir)
    inv = fx.inventory(t)
    first = _write_drop(spark, fx.inventory_csv_lines(inv.where(F.col("inv_warehouse_sk") <= 3)), "inventory_csv")
    second = _write_drop(spark, fx.inventory_csv_lines(inv), "inventory_csv")
    target = VersionedTable(spark, shared_dir(spark, "raw_inventory"), schemas.INVENTORY)
    csv_ingest.full_refresh(spark, first, target)
    csv_ingest.full_refresh(spark, second, target)
    return target.read()


@register("csv_rejected_lines")
def q_csv_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the load sets aside, as they stood in the drop."""
    t = Tables(spark, sf_dir)
    path = _write_drop(spark, fx.inventory_csv_lines(fx.inventory(t)), "inventory_csv")
    fields = [F.coalesce(F.col(f.name), F.lit("")) for f in schemas.INVENTORY.fields]
    line = F.coalesce(F.col(csv_ingest.CORRUPT), F.concat_ws(",", *fields))
    return csv_ingest.read_csv_drop(spark, path).rejected.select(line.alias("line"))


@register("csv_truncate_reload")
def q_csv_truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and stock of the stored table after a load, after TRUNCATE, and after a smaller load."""
    t = Tables(spark, sf_dir)
    inv = fx.inventory(t)
    target = VersionedTable(spark, shared_dir(spark, "raw_inventory"), schemas.INVENTORY)

    def now(step: str) -> DataFrame:
        return target.read().agg(F.count(F.lit(1)).alias("n_rows"), F.sum("inv_quantity_on_hand").alias("on_hand")).select(F.lit(step).alias("step"), "n_rows", "on_hand")

    csv_ingest.full_refresh(spark, _write_drop(spark, fx.inventory_csv_lines(inv), "inventory_csv"), target)
    out = now("loaded")
    target.truncate()
    out = out.unionByName(now("truncated"))
    csv_ingest.full_refresh(spark, _write_drop(spark, fx.inventory_csv_lines(inv.where(F.col("inv_warehouse_sk") <= 3)), "inventory_csv"), target)
    return out.unionByName(now("reloaded"))


@register("ingest_to_weekly")
def q_ingest_to_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes of the stored inventory, then the weekly fact from its root: each job feeds the next."""
    t = Tables(spark, sf_dir)
    inv = fx.inventory(t)
    root = shared_dir(spark, "raw_inventory")
    target = VersionedTable(spark, root, schemas.INVENTORY)
    for part in (inv.where(F.col("inv_warehouse_sk") <= 3), inv):
        csv_ingest.full_refresh(spark, _write_drop(spark, fx.inventory_csv_lines(part), "inventory_csv"), target)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    daily_t = jobs.daily_table(spark, shared_dir(spark, "daily_sales"))
    weekly_root = shared_dir(spark, "weekly_sales_inventory")
    jobs.run_daily_sales(fx.catalog_sales(t), fx.web_sales(t), cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, open_table(spark, root), cal, jobs.weekly_table(spark, weekly_root))
    return open_table(spark, weekly_root)


# --- data quality ------------------------------------------------------------


def checked_write(spark: SparkSession, watch: quality.Watch, purpose: str) -> DataFrame:
    """Store the watched table; the verdicts come from the metrics of that write."""
    df = watch.frame()
    VersionedTable(spark, shared_dir(spark, purpose), df.schema).write(df)
    return watch.verdicts()


@register("dq_not_null")
def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    dim = quality.Watch(customer_dim_of(spark, t)).not_null("customer_dim.c_customer_sk", "c_customer_sk")
    lines = quality.verdict(quality.not_null(lines_of(t), "warehouse_sk"), "sales_lines.warehouse_sk")
    return checked_write(spark, dim, "customer_dim").unionByName(lines)


@register("dq_unique")
def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    fact = quality.Watch(weekly_of(t)).unique("weekly_sales_inventory(warehouse_sk,item_sk,sold_wk_sk)", ["item_sk", "warehouse_sk", "sold_wk_sk"])
    keys = ["inv_item_sk", "inv_warehouse_sk", "inv_wk_num", "inv_yr_num"]
    stock = quality.unique(weekly.inventory_with_week(fx.inventory(t), fx.date_dim(t)), keys)
    return checked_write(spark, fact, "weekly").unionByName(quality.verdict(stock, "inventory(inv_item_sk,inv_warehouse_sk,inv_wk_num,inv_yr_num)"))


@register("dq_relationship")
def q_dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    fact = quality.Watch(weekly_of(t)).relationship("weekly_sales_inventory.item_sk->item_dim.i_item_sk", "item_sk", fx.item(t), "i_item_sk")
    orders = quality.relationship(t.orders, "o_custkey", fx.customer_load(t, 0), "c_customer_sk")
    return checked_write(spark, fact, "weekly").unionByName(quality.verdict(orders, "orders.o_custkey->customer_load0.c_customer_sk"))


@register("dq_accepted_values")
def q_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    fact = quality.Watch(weekly_of(t)).accepted_values("weekly_sales_inventory.warehouse_sk", "warehouse_sk", quality.ACCEPTED_WAREHOUSES)
    houses = quality.accepted_values(fx.warehouse(t), "w_warehouse_sk", quality.ACCEPTED_WAREHOUSES)
    return checked_write(spark, fact, "weekly").unionByName(quality.verdict(houses, "warehouse_dim.w_warehouse_sk"))


@register("dq_orphan_key")
def q_dq_orphan_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return quality.verdicts(
        ("customer.c_current_cdemo_sk->customer_demographics.cd_demo_sk",
         quality.orphan_key(fx.customer_load(t, 2), "c_current_cdemo_sk", fx.customer_demographics(t), "cd_demo_sk")),
        ("customer.c_current_addr_sk->customer_address.ca_address_sk",
         quality.orphan_key(fx.customer_load(t, 2), "c_current_addr_sk", fx.customer_address(t), "ca_address_sk")),
    )


# --- exploration ---------------------------------------------------------------


@register("explore_date_bounds")
def q_explore_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cal = fx.date_dim(t)
    facts = [
        ("catalog_sales", fx.catalog_sales(t), "cs_sold_date_sk"),
        ("web_sales", fx.web_sales(t), "ws_sold_date_sk"),
        ("inventory", fx.inventory(t), "inv_data_sk"),
    ]
    out = None
    for name, fact, key in facts:
        for bound in ("min", "max"):
            row = explore.date_of_key_bound(fact, key, cal, bound).select(
                F.lit(name).alias("source"), F.lit(bound).alias("bound"), "cal_dt"
            )
            out = row if out is None else out.unionByName(row)
    return out


@register("explore_daily_arrivals")
def q_explore_daily_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cal = fx.date_dim(t)
    out = None
    for name, fact, key in (("catalog_sales", fx.catalog_sales(t), "cs_sold_date_sk"),
                            ("web_sales", fx.web_sales(t), "ws_sold_date_sk")):
        part = explore.daily_arrivals(fact, key, cal, 10).select(
            F.lit(name).alias("channel"), "cal_dt", F.col(key).alias("sold_date_sk"), "n_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


@register("explore_fk_probe")
def q_explore_fk_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fact -> dimension key pair: matched row count, and the first five
    matches in (key, order, line) order with their dimension row (``dim.*`` as text)."""
    t = Tables(spark, sf_dir)
    cal, item, wh = fx.date_dim(t), fx.item(t), fx.warehouse(t)
    out = None
    for p, fact in (("cs_", fx.catalog_sales_billed(t)), ("ws_", fx.web_sales(t))):
        keys = [("sold_date_sk", cal, "d_date_sk"), ("item_sk", item, "i_item_sk"), ("warehouse_sk", wh, "w_warehouse_sk")]
        if p == "cs_":
            keys += [
                ("bill_customer_sk", fx.customer_load(t, 2), "c_customer_sk"),
                ("bill_cdemo_sk", fx.customer_demographics(t), "cd_demo_sk"),
                ("bill_hdemo_sk", fx.household_demographics(t), "hd_demo_sk"),
                ("bill_addr_sk", fx.customer_address(t), "ca_address_sk"),
            ]
        pairs = [(f"{p}{key}->{dim_key}", f"{p}{key}", dim, dim_key) for key, dim, dim_key in keys]
        part = explore.key_probes(fact, pairs, [f"{p}order_number", f"{p}line_number"])
        part = part.withColumnsRenamed({f"{p}order_number": "order_number", f"{p}line_number": "line_number"})
        out = part if out is None else out.unionByName(part)
    return out


@register("explore_sales_preview")
def q_explore_sales_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 rows of each channel (``SELECT * ... LIMIT 100``) in order-line order."""
    t = Tables(spark, sf_dir)
    out = None
    for name, p, fact in (("catalog_sales", "cs_", fx.catalog_sales(t)), ("web_sales", "ws_", fx.web_sales(t))):
        part = explore.preview(fact, [f"{p}order_number", f"{p}line_number"], 100).select(
            F.lit(name).alias("channel"),
            *[F.col(c).alias(c[len(p):]) for c in fact.columns],
        )
        out = part if out is None else out.unionByName(part)
    return out


@register("explore_inventory_counts")
def q_explore_inventory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return explore.rows_per_key(fx.inventory(t), ["inv_data_sk", "inv_item_sk"])


# The item the cadence probe looks at.
PROBE_ITEM = 1


@register("explore_item_days")
def q_explore_item_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cal, item = fx.date_dim(t), fx.item(t)
    parts = [
        ("inventory", explore.days_with_item(fx.inventory(t), "inv_data_sk", "inv_item_sk", PROBE_ITEM, cal,
                                             ordered=False)),
        ("web_sales", explore.days_with_item(fx.web_sales(t), "ws_sold_date_sk", "ws_item_sk", PROBE_ITEM, cal,
                                             item, ordered=False)),
        ("catalog_sales", explore.days_with_item(fx.catalog_sales(t), "cs_sold_date_sk", "cs_item_sk", PROBE_ITEM,
                                                 cal, item, ordered=False)),
    ]
    out = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("source"), "cal_dt", "wk_num")
        out = part if out is None else out.unionByName(part)
    return out.orderBy("source", "cal_dt", "wk_num")


@register("explore_distinct_items")
def q_explore_distinct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.distinct_rows(fx.item(Tables(spark, sf_dir)), ["i_item_sk", "i_product_name"])


@register("explore_distinct_customers")
def q_explore_distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return explore.distinct_rows(fx.customer_load(t, 2), ["c_customer_sk", "c_first_name", "c_last_name"])


@register("explore_cardinality")
def q_explore_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    items = explore.distinct_count(fx.item(t), "i_item_sk", "n_distinct").select(
        F.lit("item.i_item_sk").alias("metric"), "n_distinct")
    custs = explore.distinct_count(fx.customer_load(t, 2), "c_customer_sk", "n_distinct").select(
        F.lit("customer.c_customer_sk").alias("metric"), "n_distinct")
    return items.unionByName(custs)


@register("customer_null_key_count")
def q_customer_null_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return explore.null_count(fx.customer_load(t, 2), "c_first_sales_date_sk")


@register("explore_calendar_head")
def q_explore_calendar_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.calendar_head(fx.date_dim(Tables(spark, sf_dir)), 100)


@register("explore_calendar_day")
def q_explore_calendar_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.calendar_day(fx.date_dim(Tables(spark, sf_dir)), "1998-08-12")
