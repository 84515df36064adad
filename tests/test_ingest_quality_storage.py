"""CSV ingest, data-quality checks, and slice storage (incremental runs, R1/R3/R5)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockledger import schemas
from stockledger.operators import quality
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources import csv_ingest
from stockledger.sources.storage import CommitLog, ConcurrentWrite, SlicedTable, VersionedTable, list_names, open_table, sql_view

LINES = [
    "inv_data_sk,inv_item_sk,inv_quantity_on_hand,inv_warehouse_sk",  # header: not numeric
    "1,10,5,1",
    '"2","11","6","2"',  # quoted fields are fine
    "3,12,,3",            # empty quantity -> NULL
    "4,13,7",             # too short
    "5,14,8,4,99",        # too long
    "x6,15,9,5",          # non-numeric key
    "7,,9,6",             # empty NOT NULL key
    "8,16,abc,1",         # non-numeric quantity
    "3000000000,17,1.5,1",  # keys are NUMBER(38,0): wider than 32 bits, and 1.5 loads as 2
    "9,18,99999999999999999999,1",  # does not fit 64 bits
]


def write_lines(spark, lines):
    path = shared_dir(spark, "test_csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_keeps_good_rows_and_sets_bad_aside(spark):
    load = csv_ingest.read_csv_drop(spark, write_lines(spark, LINES))
    good = sorted(tuple(r) for r in load.good.collect())
    assert good == [(1, 10, 5, 1), (2, 11, 6, 2), (3, 12, None, 3), (3000000000, 17, 2, 1)]
    assert load.rejected.count() == len(LINES) - 4
    # column pruning must not change which lines are bad
    assert load.good.count() == 4
    assert load.good.select("inv_item_sk").count() == 4
    assert load.good.agg(F.sum("inv_data_sk")).first()[0] == 3000000006


def test_full_refresh_replaces_the_table(spark):
    target = VersionedTable(spark, shared_dir(spark, "test_inv"), schemas.INVENTORY)
    csv_ingest.full_refresh(spark, write_lines(spark, ["1,10,5,1", "2,11,6,2"]), target)
    csv_ingest.full_refresh(spark, write_lines(spark, ["9,19,1,3"]), target)
    assert [tuple(r) for r in target.read().collect()] == [(9, 19, 1, 3)]
    target.truncate()
    assert target.read().count() == 0 and target.read().columns == schemas.INVENTORY.fieldNames()


def test_quality_checks_good_and_broken(spark):
    fact = spark.createDataFrame([(1, 10, 100), (2, 11, 100), (None, 12, 100), (7, 10, 100)],
                                 "warehouse_sk bigint, item_sk bigint, sold_wk_sk bigint")
    dim = spark.createDataFrame([(10,), (11,)], "i_item_sk bigint")
    v = {r.check_name: (r.n_failing, r.passed) for r in quality.verdicts(
        ("nn", quality.not_null(fact, "warehouse_sk")),
        ("uq", quality.unique(fact, ["warehouse_sk", "item_sk", "sold_wk_sk"])),
        ("uq_item", quality.unique(fact, ["item_sk", "sold_wk_sk"])),
        ("rel", quality.relationship(fact, "item_sk", dim, "i_item_sk")),
        ("acc", quality.accepted_values(fact, "warehouse_sk", [1, 2, 3, 4, 5, 6])),
        ("orph", quality.orphan_key(fact, "warehouse_sk", dim.select(F.col("i_item_sk").alias("k")), "k")),
    ).collect()}
    assert v["nn"] == (1, False)
    assert v["uq"] == (0, True)
    assert v["uq_item"] == (1, False)
    assert v["rel"] == (1, False)
    assert v["acc"] == (1, False)  # NULL passes NOT IN, 7 fails
    assert v["orph"] == (3, False)  # NULL key excluded


CH = ("{p}warehouse_sk bigint, {p}item_sk bigint, {p}sold_date_sk bigint, {p}quantity bigint, "
      "{p}sales_price decimal(12,2), {p}net_profit decimal(18,4)")


def _cal(spark):
    from stockledger.operators import calendar
    b = spark.createDataFrame([("2024-01-07", "2024-02-03")], "lo string, hi string")
    return calendar.calendar_between(b)


def test_incremental_daily_late_data_and_vanished_slice(spark):
    sun = 19729  # 2024-01-07
    cal = _cal(spark)
    table = jobs.daily_table(spark, shared_dir(spark, "test_daily"))
    web = spark.createDataFrame([], CH.format(p="ws_"))

    def cs(rows):
        return spark.createDataFrame(rows, CH.format(p="cs_"))

    one = Decimal("1.00")
    jobs.run_daily_sales(cs([(1, 1, sun, 1, one, None), (1, 1, sun + 1, 2, one, None)]), web, cal, table)
    assert table.last_slice() == sun + 1
    # late row for day `sun` plus more sales on sun+1: only days >= watermark are redone
    r = jobs.run_daily_sales(
        cs([(1, 1, sun, 1, one, None), (1, 1, sun, 5, one, None), (1, 1, sun + 1, 2, one, None),
            (1, 1, sun + 1, 3, one, None)]), web, cal, table)
    assert r.watermark == sun + 1
    got = {x.sold_date_sk: x.daily_qty for x in table.read().collect()}
    assert got == {sun: 1, sun + 1: 5}
    # the last day vanished from the source: its slice is dropped, not kept stale
    jobs.run_daily_sales(cs([(1, 1, sun, 1, one, None)]), web, cal, table)
    assert {x.sold_date_sk for x in table.read().collect()} == {sun}
    # an identical rerun changes nothing
    jobs.run_daily_sales(cs([(1, 1, sun, 1, one, None)]), web, cal, table)
    assert [(x.sold_date_sk, x.daily_qty) for x in table.read().collect()] == [(sun, 1)]


def test_incremental_weekly_equals_full(spark):
    sun = 19729
    cal = _cal(spark)
    web = spark.createDataFrame([], CH.format(p="ws_"))
    rows = [(1 + i % 2, 1 + i % 3, sun + i, 1 + i, Decimal("2.50"), Decimal("0.1000")) for i in range(20)]
    inv = spark.createDataFrame([(sun + 2 + 7 * k, 1 + j, 10 * k, 1 + j % 2) for k in range(3) for j in range(3)],
                                schemas.INVENTORY)
    daily_t = jobs.daily_table(spark, shared_dir(spark, "test_daily"))
    weekly_t = jobs.weekly_table(spark, shared_dir(spark, "test_weekly"))
    cs_all = spark.createDataFrame(rows, CH.format(p="cs_"))
    jobs.run_daily_sales(cs_all.where(F.col("cs_sold_date_sk") < sun + 10), web, cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    jobs.run_daily_sales(cs_all, web, cal, daily_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)

    full_daily = jobs.daily_table(spark, shared_dir(spark, "test_daily"))
    full_weekly = jobs.weekly_table(spark, shared_dir(spark, "test_weekly"))
    jobs.run_daily_sales(cs_all, web, cal, full_daily)
    jobs.run_weekly_sales_inventory(full_daily, inv, cal, full_weekly)
    assert sorted(map(tuple, weekly_t.read().collect()), key=str) == sorted(
        map(tuple, full_weekly.read().collect()), key=str)
    assert weekly_t.read().count() > 3


# --- publishing ------------------------------------------------------------------

NUMS = "k bigint, v bigint"


def sliced(spark, **kw):
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("k", LongType()), StructField("v", LongType())])
    return SlicedTable(spark, shared_dir(spark, "test_sliced"), schema, "k", width=4, **kw)


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_replace_slice_drops_one_slice_and_appends_to_others(spark):
    table = sliced(spark)
    assert table.last_slice() is None and content(table) == []
    table.replace_slice(None, spark.createDataFrame([(1, 10), (2, 20), (9, 90), (10, 100)], NUMS))
    assert table.last_slice() == 10
    # slice 1 gets a row and keeps its own; slice 10 is dropped; slice 9 shares 10's folder and stays
    table.replace_slice(10, spark.createDataFrame([(1, 11), (13, 130)], NUMS))
    assert content(table) == [(1, 10), (1, 11), (2, 20), (9, 90), (13, 130)]
    assert table.last_slice() == 13
    # an empty batch still drops
    table.replace_slice(13, None)
    assert content(table) == [(1, 10), (1, 11), (2, 20), (9, 90)] and table.last_slice() == 9
    assert sorted(map(tuple, table.read(min_slice=2).collect())) == [(2, 20), (9, 90)]
    # negative slices and merging of many folders
    for i in range(SlicedTable.MAX_PARTS + 2):
        table.replace_slice(None, spark.createDataFrame([(-5, i), (1, 1000 + i)], NUMS))
    assert len(content(table)) == 4 + 2 * (SlicedTable.MAX_PARTS + 2)
    state = table.log.latest()[1]
    per_range = [p["bucket"] for p in state["parts"]]
    assert max(per_range.count(b) for b in per_range) <= SlicedTable.MAX_PARTS


def test_a_job_that_dies_leaves_the_table_and_a_rerun_completes_it(spark, monkeypatch):
    table = sliced(spark)
    table.replace_slice(None, spark.createDataFrame([(1, 10), (2, 20)], NUMS))
    batch = spark.createDataFrame([(k, 10 * k) for k in range(2, 12)], NUMS)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "publish", lambda self, base, state: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.replace_slice(2, batch)  # folders are written, nothing names them
    assert content(table) == [(1, 10), (2, 20)] and table.last_slice() == 2
    table.replace_slice(2, batch)
    assert content(table) == [(k, 10 * k) for k in range(1, 12)]


def test_of_two_writers_from_one_state_the_second_fails(spark):
    schema = schemas.INVENTORY
    table = VersionedTable(spark, shared_dir(spark, "test_writers"), schema)
    table.write(spark.createDataFrame([(1, 1, 1, 1)], schema))
    base = table.current_version()
    table.write(spark.createDataFrame([(2, 2, 2, 2)], schema), base=base)
    with pytest.raises(ConcurrentWrite):
        table.write(spark.createDataFrame([(3, 3, 3, 3)], schema), base=base)
    assert [r.inv_data_sk for r in table.read().collect()] == [2]
    # also when both passed the first look at the log
    log = CommitLog(spark, table.root)
    log.numbers = lambda: [base]
    with pytest.raises(ConcurrentWrite):
        log.publish(base, {"parts": []})


def test_retention_keeps_the_newest_versions_and_the_folders_they_name(spark):
    schema = schemas.INVENTORY
    table = VersionedTable(spark, shared_dir(spark, "test_retain"), schema, retain=2)
    for i in range(5):
        table.write(spark.createDataFrame([(i, i, i, i)], schema))
    assert table.versions() == [4, 5]
    assert len(list_names(spark, f"{table.root}/data")) == 2
    assert [r[0] for r in table.read(4).collect()] == [3] and [r[0] for r in open_table(spark, table.root).collect()] == [4]
    kept = sliced(spark, retain=1)
    for i in range(4):
        kept.replace_slice(kept.last_slice(), spark.createDataFrame([(i * 4, i), (i * 4 + 1, i)], NUMS))
    assert content(kept) == [(0, 0), (4, 1), (8, 2), (12, 3), (13, 3)]


def test_weekly_run_keeps_stored_rows_of_an_older_slice(spark):
    """ISO week numbers beside calendar years: (52, 2023) holds 1 January and 27 December 2023."""
    import datetime as dt

    from stockledger.operators import calendar

    cal = calendar.calendar_between(spark.createDataFrame([("2023-01-01", "2024-01-06")], "lo string, hi string"), "iso_calendar")
    day = lambda *d: (dt.date(*d) - dt.date(1970, 1, 1)).days
    web = spark.createDataFrame([], CH.format(p="ws_"))
    one = Decimal("1.00")
    first = [(1, i, day(2023, 1, 1), 1, one, None) for i in (1, 2, 3)] + [(1, 9, day(2023, 12, 24), 1, one, None)]
    inv = spark.createDataFrame([], schemas.INVENTORY)
    daily_t, weekly_t = jobs.daily_table(spark, shared_dir(spark, "iso_daily")), jobs.weekly_table(spark, shared_dir(spark, "iso_weekly"))
    for rows in (first, [*first, (1, 8, day(2023, 12, 27), 1, one, None)]):
        jobs.run_daily_sales(spark.createDataFrame(rows, CH.format(p="cs_")), web, cal, daily_t)
        jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    assert sorted((r.item_sk, r.sold_wk_sk) for r in weekly_t.read().collect()) == [
        (1, day(2023, 1, 1)), (2, day(2023, 1, 1)), (3, day(2023, 1, 1)), (8, day(2023, 1, 1)), (9, day(2023, 12, 24))]


def test_weekly_run_without_a_live_week_drops_the_last_slice(spark):
    from stockledger.operators import calendar

    cal = _cal(spark)
    web = spark.createDataFrame([], CH.format(p="ws_"))
    sun = 19729
    rows = [(1, 1, sun + d, 1, Decimal("1.00"), None) for d in (1, 8)]
    daily_t, weekly_t = jobs.daily_table(spark, shared_dir(spark, "d")), jobs.weekly_table(spark, shared_dir(spark, "w"))
    jobs.run_daily_sales(spark.createDataFrame(rows, CH.format(p="cs_")), web, cal, daily_t)
    inv = spark.createDataFrame([], schemas.INVENTORY)
    jobs.run_weekly_sales_inventory(daily_t, inv, cal, weekly_t)
    old = calendar.calendar_between(spark.createDataFrame([("2023-12-03", "2023-12-09")], "lo string, hi string"))
    r = jobs.run_weekly_sales_inventory(daily_t, inv, old, weekly_t)
    assert "dropped" in r.note and {x.sold_wk_sk for x in weekly_t.read().collect()} == {sun}


@pytest.mark.parametrize("torn", ["", '{"schema": {"ty', "[1]"])
def test_a_commit_cut_short_counts_as_not_published(spark, torn):
    schema = schemas.INVENTORY
    table = VersionedTable(spark, shared_dir(spark, "test_torn"), schema)
    table.write(spark.createDataFrame([(1, 1, 1, 1)], schema))
    with open(f"{table.root.removeprefix('file:')}/_commits/00000002", "w") as f:
        f.write(torn)
    assert [r[0] for r in table.read().collect()] == [1] and [r[0] for r in open_table(spark, table.root).collect()] == [1]
    assert table.write(spark.createDataFrame([(3, 3, 3, 3)], schema)) == 3
    assert table.write(spark.createDataFrame([(4, 4, 4, 4)], schema)) == 4
    assert [r[0] for r in open_table(spark, table.root).collect()] == [4]
    # nothing but commits is left under their folder
    assert [x for x in list_names(spark, f"{table.root}/_commits") if x.endswith(".tmp")] == []


def test_the_first_commit_cut_short(spark):
    table = sliced(spark)
    log = table.log
    import os

    os.makedirs(f"{table.root.removeprefix('file:')}/_commits")
    with open(f"{table.root.removeprefix('file:')}/_commits/00000001", "w") as f:
        f.write("{")
    assert log.latest() == (0, {}) and table.last_slice() is None
    table.replace_slice(None, spark.createDataFrame([(1, 10)], NUMS))
    assert content(table) == [(1, 10)]


def test_stored_tables_by_name_in_sql(spark):
    table = sliced(spark)
    table.replace_slice(None, spark.createDataFrame([(1, 10), (40, 20)], NUMS))
    sql_view(spark, "test_nums", table.root)
    count = "SELECT count(*), max(v) FROM test_nums" if "v" in table.schema.names else f"SELECT count(*), max({table.schema.names[1]}) FROM test_nums"
    assert tuple(spark.sql(count).first()) == (2, 20)
    table.replace_slice(40, spark.createDataFrame([(41, 30), (42, 31)], NUMS))
    assert tuple(spark.sql(count).first()) == (2, 20)  # the state that it was made for
    sql_view(spark, "test_nums", table.root)
    assert tuple(spark.sql(count).first()) == (3, 31)
    empty = VersionedTable(spark, shared_dir(spark, "test_view"), schemas.INVENTORY)
    with pytest.raises(ValueError):
        sql_view(spark, "test_none", empty.root)
    empty.truncate()
    sql_view(spark, "test_none", empty.root)
    assert spark.table("test_none").schema.names == schemas.INVENTORY.names and spark.table("test_none").count() == 0
