"""Checks taken by the write, stacked probes, ranged raw tables, day marks, bitmaps, rows without a key."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockledger import schemas
from stockledger.operators import calendar, customers, explore, quality, sales, weekly
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources.raw import RawTable
from stockledger.sources.storage import VersionedTable, open_table, session_conf

CH = ("{p}warehouse_sk bigint, {p}item_sk bigint, {p}sold_date_sk bigint, {p}quantity bigint, "
      "{p}sales_price decimal(12,2), {p}net_profit decimal(18,4)")
SUN = 19729


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def channel(spark, p, rows):
    return spark.createDataFrame([(1, i, d, q, Decimal("2.00"), None) for i, d, q in rows], CH.format(p=p))


@pytest.fixture(scope="module")
def cal(spark):
    return calendar.calendar_between(spark.createDataFrame([("2024-01-07", "2024-06-29")], "lo string, hi string"))


# --- checks by the write


@pytest.mark.parametrize("n", [0, 1, 500])
def test_verdicts_of_the_write_equal_those_of_a_scan(spark, n):
    df = spark.range(n).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 40).alias("k"), (F.col("id") % 9).alias("v"), F.lit("x").alias("_check_9")
    )
    parent = spark.createDataFrame([(i,) for i in range(30)] * 2 + [(None,)], "p bigint")
    watch = quality.Watch(df).not_null("a", "k").unique("b", ["k", "v"]).relationship("c", "k", parent, "p").accepted_values("d", "v", [1, 2, 3])
    table = VersionedTable(spark, shared_dir(spark, "test_watch"), df.schema)
    table.write(watch.frame())
    found = {r.check_name: (r.n_failing, r.passed) for r in watch.verdicts().collect()}
    plain = quality.verdicts(
        ("a", quality.not_null(df, "k")), ("b", quality.unique(df, ["k", "v"])), ("c", quality.relationship(df, "k", parent, "p")), ("d", quality.accepted_values(df, "v", [1, 2, 3]))
    )
    assert found == {r.check_name: (r.n_failing, r.passed) for r in plain.collect()}
    assert sorted(map(str, table.read().collect())) == sorted(map(str, df.collect()))  # the checks change no row


# --- probes


def test_stacked_probes_equal_single_ones_in_one_scan(spark):
    rows = [(i % 11 if i % 5 else None, 3 if i % 3 else i, i // 4, i) for i in range(300)]
    root = shared_dir(spark, "test_probe")
    spark.createDataFrame(rows, "a bigint, b bigint, o bigint, l bigint").write.parquet(root)
    fact = spark.read.parquet(root)
    da = spark.createDataFrame([(i, f"d{i}") for i in range(2, 9)] + [(4, "again"), (None, "none")], "ka bigint, t string")
    db = spark.createDataFrame([(3, 1.5), (6, 2.5), (999, 3.5)], "kb bigint, x double")
    none = spark.createDataFrame([], "kc bigint")
    pairs = [("a", "a", da, "ka"), ("b", "b", db, "kb"), ("none", "a", none, "kc")]
    got = explore.key_probes(fact, pairs, ["o", "l"], 4).collect()
    for name, key, dim, dim_key in pairs:
        own = [r for r in got if r.probe == name]
        assert [r.value for r in own if r.kind == "count"] == [explore.key_probe_count(fact, key, dim, dim_key).first()[0]]
        single = explore.key_probe_preview(fact, key, dim, dim_key, ["o", "l"], 4).collect()
        assert sorted((r.value, r.o, r.l) for r in own if r.kind == "sample") == sorted((r[key], r.o, r.l) for r in single)
    counts = explore.key_probes(fact, pairs, ["o", "l"], 4).where("kind = 'count'")
    counts.collect()
    assert len(re.findall(r"FileScan parquet", plan_of(counts).split("== Initial Plan ==")[0])) <= 1


# --- raw tables in day ranges


def test_a_second_run_opens_only_new_ranges(spark, cal):
    cs = RawTable(spark, shared_dir(spark, "raw_cs"), channel(spark, "cs_", []).schema, "cs_sold_date_sk")
    ws = RawTable(spark, shared_dir(spark, "raw_ws"), channel(spark, "ws_", []).schema, "ws_sold_date_sk")
    early, late = [(1, SUN + d, 1) for d in range(60)] + [(9, None, 1)], [(2, SUN + d, 1) for d in range(59, 120)]
    assert cs.read().count() == 0
    cs.append(channel(spark, "cs_", early))
    ws.append(channel(spark, "ws_", []))
    table = jobs.daily_table(spark, shared_dir(spark, "raw_daily"))
    jobs.run_daily_from_raw(cs, ws, cal, table)
    cs.append(channel(spark, "cs_", late))
    wm = table.last_slice()
    scan = cs.read(wm)
    plan = plan_of(scan)
    assert re.search(r"PartitionFilters: \[[^\]]*_range#\d+ >= %d" % (wm // 32), plan), plan
    opened = {r[0] for r in scan.select(F.input_file_name()).distinct().collect()}
    assert opened and all(int(re.search(r"_range=(\d+)", f)[1]) >= wm // 32 for f in opened)
    jobs.run_daily_from_raw(cs, ws, cal, table)
    whole = sales.daily_sales(sales.sales_union(channel(spark, "cs_", early + late), channel(spark, "ws_", [])), cal)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, whole.collect()))
    assert cs.read().count() == len(early + late)


def test_live_stock_prunes_folders_at_run_time(spark, cal):
    rows = [(SUN + d, i, 5, 1) for d in range(150) for i in (1, 2)]
    inv = RawTable(spark, shared_dir(spark, "raw_inv"), schemas.INVENTORY, "inv_data_sk", width=7)
    inv.append(spark.createDataFrame(rows, schemas.INVENTORY))
    root = shared_dir(spark, "raw_cal")
    cal.write.parquet(root)
    since = SUN + 100
    live = jobs.live_stock(inv, spark.read.parquet(root), since)
    assert "dynamicpruning" in plan_of(live).lower()
    first = weekly.live_weeks(cal, since).agg(F.min("_first")).first()[0]
    assert sorted(r.inv_data_sk for r in live.collect()) == sorted(d for d, *_ in rows if d >= first)


# --- marks of days


def test_marks_name_the_days_that_changed_behind_the_watermark(spark, cal):
    rows = [(i, SUN + d, 1 + i) for d in range(6) for i in range(4)]
    none = channel(spark, "ws_", [])
    table, marks = jobs.daily_table(spark, shared_dir(spark, "m_daily")), jobs.marks_table(spark, shared_dir(spark, "m_marks"))
    assert jobs.late_day_report(channel(spark, "cs_", rows), none, table, marks).count() == 0
    jobs.run_daily_with_marks(channel(spark, "cs_", rows), none, cal, table, marks)
    assert jobs.late_day_report(channel(spark, "cs_", rows[::-1]), none, table, marks).count() == 0
    changed = [r for r in rows if r[:2] != (1, SUN + 1)]  # one lost
    changed += [(7, SUN + 2, 5)]  # one added
    changed = [(i, d, 3 if (i, d) == (0, SUN + 3) else 0 if (i, d) == (2, SUN + 3) else q) for i, d, q in changed]  # two changed, same count
    changed += [(7, SUN - 1, 5), (7, SUN + 5, 5), (7, SUN + 9, 5)]  # a day before all, the watermark's day, a new one
    got = {r.sold_date_sk - SUN: (r.n_stored, r.n_source) for r in jobs.late_day_report(channel(spark, "cs_", changed), none, table, marks).collect()}
    assert got == {-1: (0, 1), 1: (4, 3), 2: (4, 5), 3: (4, 4)}
    jobs.run_daily_with_marks(channel(spark, "cs_", changed), none, cal, table, marks)
    assert marks.last_slice() == table.last_slice() == SUN + 9
    assert {r.sold_date_sk - SUN for r in jobs.late_day_report(channel(spark, "cs_", changed), none, table, marks).collect()} == {-1, 1, 2, 3}


# --- the daily job in SQL


def test_the_sql_job_equals_the_job(spark, cal):
    cal.createOrReplaceTempView("t_cal")
    rows = [(i % 3, SUN + d, 1 + i) for d in range(5) for i in range(4)] + [(1, None, 1), (2, SUN, None)]
    a, b = (jobs.daily_table(spark, shared_dir(spark, "sql_daily")) for _ in range(2))
    for part in (rows[:9], rows, rows[:4]):
        cs, ws = channel(spark, "cs_", part), channel(spark, "ws_", part[::2])
        cs.createOrReplaceTempView("t_cs")
        ws.createOrReplaceTempView("t_ws")
        assert jobs.run_daily_sql(spark, "t_cs", "t_ws", "t_cal", a).watermark == jobs.run_daily_sales(cs, ws, cal, b).watermark
        assert sorted(map(str, a.read().collect())) == sorted(map(str, b.read().collect()))


def test_the_sql_job_deals_a_larger_batch_to_more_tasks(spark, cal, monkeypatch):
    cal.createOrReplaceTempView("t_cal")
    rows = [(i, SUN + i % 5, 1) for i in range(100)]
    channel(spark, "cs_", rows).createOrReplaceTempView("t_cs")
    channel(spark, "ws_", rows[:20]).createOrReplaceTempView("t_ws")
    table, seen, names = jobs.daily_table(spark, shared_dir(spark, "sql_daily")), [], ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    write = table.replace_slice
    table.replace_slice = lambda *a: (seen.append([spark.conf.get(n, None) for n in names]), write(*a))
    before = [spark.conf.get(n, None) for n in names]
    jobs.run_daily_sql(spark, "t_cs", "t_ws", "t_cal", table)
    monkeypatch.setattr(jobs, "LINES_A_TASK", 3)
    jobs.run_daily_sql(spark, "t_cs", "t_ws", "t_cal", table)
    assert seen == [[before[0], "16m"], ["8", "16m"]]  # 120 lines, then the 24 of the watermark's day
    monkeypatch.setattr(jobs, "LINES_A_TASK", 2)
    jobs.run_daily_sql(spark, "t_cs", "t_ws", "t_cal", table)
    assert seen[2] == ["12", "16m"] and [spark.conf.get(n, None) for n in names] == before
    assert table.read().count() == 100


# --- bitmaps


def test_bitmaps_of_slices_add_up_to_distinct_counts(spark):
    df = spark.createDataFrame([(i % 4, i * 7919 % 100_003) for i in range(3000)] + [(1, 5)] * 50 + [(1, None), (None, 3), (2, 0), (3, 32_768), (0, 32_767)], "s bigint, v bigint")
    maps = explore.distinct_bitmaps(df, "s", "v")
    held = df.where("s is not null and v is not null")
    assert explore.distinct_of_bitmaps(maps).first()[0] == held.select("v").distinct().count()
    some = maps.where("slice in (1, 2)")
    assert explore.distinct_of_bitmaps(some).first()[0] == held.where("s in (1, 2)").select("v").distinct().count()
    assert explore.distinct_of_bitmaps(maps.where("false")).first()[0] == 0


# --- rows without a key


def test_rows_without_a_key_spread_in_a_shuffled_join(spark):
    left = spark.range(30_000).select(F.col("id").alias("c_customer_sk"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"))
    right = spark.range(30_000).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("twice"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    with session_conf(spark, conf):
        joined = customers._left_join(left, "k", right, "rk")
        assert "SortMergeJoin" in plan_of(joined)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]
    rows = joined.collect()
    assert len(rows) == 30_000 and all(r.twice == (None if r.k is None else 2 * r.k) for r in rows) and joined.columns == ["c_customer_sk", "k", "rk", "twice"]


def test_open_table_reads_a_bucketed_history(spark):
    from stockledger.sources.bucketed import BucketedHistory

    history = BucketedHistory(spark, shared_dir(spark, "test_open"), strict=True, buckets=2)
    assert history.read().count() == history.open_versions().count() == 0
    load = spark.createDataFrame([tuple(None if c != "c_customer_sk" else 1 for c in schemas.CUSTOMER_COLUMNS)], schemas.CUSTOMER)
    history.run(load, "2024-01-01")
    assert open_table(spark, history.root).count() == 1
