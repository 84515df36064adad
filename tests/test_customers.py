"""SCD2 history: literal quirks (R10) and the strict mode."""

from __future__ import annotations

import pytest

from stockledger import schemas
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources.bucketed import BucketedHistory
from stockledger.sources.storage import list_names, session_conf


def cust(spark, rows):
    """rows: (sk, salutation, cdemo) - the other attributes are fixed non-NULL values."""
    full = []
    for sk, sal, cdemo in rows:
        vals = {
            "c_salutation": sal, "c_preferred_cust_flag": "Y", "c_first_sales_date_sk": None,
            "c_customer_sk": sk, "c_login": f"l{sk}", "c_current_cdemo_sk": cdemo, "c_first_name": "F",
            "c_current_hdemo_sk": 1, "c_current_addr_sk": sk, "c_last_name": "L", "c_customer_id": f"C{sk}",
            "c_last_review_date_sk": None, "c_birth_month": 1, "c_birth_country": "X", "c_birth_year": 1970,
            "c_birth_day": 1, "c_email_address": "e", "c_first_shipto_date_sk": None,
        }
        full.append(tuple(vals[c] for c in schemas.CUSTOMER_COLUMNS))
    return spark.createDataFrame(full, schemas.CUSTOMER)


def history(spark, loads, strict=False):
    """Apply the loads as the job does: each version is stored, cutting the lineage."""
    table = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    for i, rows in enumerate(loads):
        jobs.run_customer_snapshot(cust(spark, rows), table, f"2024-01-0{i + 1}", strict=strict)
    snap = table.read()
    return sorted(
        ((r.c_customer_sk, r.c_salutation, r.start_date.day, r.end_date.day if r.end_date else None)
         for r in snap.collect()),
        key=lambda x: (x[0], x[2], str(x[1])),
    )


def test_change_closes_and_inserts(spark):
    h = history(spark, [[(1, "A", 5)], [(1, "B", 5)]])
    assert h == [(1, "A", 1, 2), (1, "B", 2, None)]


def test_a_b_a_leaves_no_open_version_literally(spark):
    h = history(spark, [[(1, "A", 5)], [(1, "B", 5)], [(1, "A", 5)]])
    # A matches the stored (closed) A, so it is not inserted; B is closed.
    assert [x for x in h if x[3] is None] == []
    s = history(spark, [[(1, "A", 5)], [(1, "B", 5)], [(1, "A", 5)]], strict=True)
    assert [x for x in s if x[3] is None] == [(1, "A", 3, None)]


def test_null_in_plain_column_reinserts_and_is_not_closed(spark):
    h = history(spark, [[(1, "A", 5)], [(1, None, 5)], [(1, None, 5)]])
    # value -> NULL: "!=" is NULL so A stays open; the NULL row never matches, so it is added every run
    assert h == [(1, "A", 1, None), (1, None, 2, None), (1, None, 3, None)]


def test_null_equals_zero_in_coalesced_columns(spark):
    h = history(spark, [[(1, "A", 0)], [(1, "A", None)]])
    assert h == [(1, "A", 1, None)]
    s = history(spark, [[(1, "A", 0)], [(1, "A", None)]], strict=True)
    assert s == [(1, "A", 1, 2), (1, "A", 2, None)]


def test_closed_versions_are_reclosed_literally(spark):
    h = history(spark, [[(1, "A", 5)], [(1, "B", 5)], [(1, "C", 5)]])
    # A was closed on day 2 and is closed again on day 3 (its attributes differ from C)
    assert h == [(1, "A", 1, 3), (1, "B", 2, 3), (1, "C", 3, None)]
    s = history(spark, [[(1, "A", 5)], [(1, "B", 5)], [(1, "C", 5)]], strict=True)
    assert s == [(1, "A", 1, 2), (1, "B", 2, 3), (1, "C", 3, None)]


def test_missing_customers_stay_open(spark):
    h = history(spark, [[(1, "A", 5), (2, "A", 5)], [(1, "A", 5)]])
    assert h == [(1, "A", 1, None), (2, "A", 1, None)]


def test_duplicate_source_key_is_refused(spark):
    snap = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    with pytest.raises(ValueError):
        jobs.run_customer_snapshot(cust(spark, [(1, "A", 5), (1, "B", 5)]), snap, "2024-01-01")


def test_stored_history_versions(spark):
    snap = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    assert snap.read().count() == 0
    assert jobs.run_customer_snapshot(cust(spark, [(1, "A", 5)]), snap, "2024-01-01") == 1
    assert jobs.run_customer_snapshot(cust(spark, [(1, "B", 5)]), snap, "2024-01-02") == 2
    assert snap.read().count() == 2
    assert snap.read(1).count() == 1  # old versions stay readable


def test_strict_ignores_exact_duplicates(spark):
    snap = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    jobs.run_customer_snapshot(cust(spark, [(1, "A", 5), (1, "A", 5)]), snap, "2024-01-01", strict=True)
    assert snap.read().count() == 1
    with pytest.raises(ValueError):
        jobs.run_customer_snapshot(cust(spark, [(1, "A", 5), (1, "A", 5)]), snap, "2024-01-02")


def test_open_closed_layout_equals_full_rewrite(spark):
    from stockledger.sources.history import OpenClosedHistory

    loads = [[(1, "A", 5), (2, "A", 5), (3, "A", None)], [(1, "B", 5), (2, "A", 5), (3, "A", 0)],
             [(1, "A", 5), (3, "C", 0)], [(1, "A", 5), (3, "C", 0)]]
    full = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    split = OpenClosedHistory(spark, shared_dir(spark, "test_history"))
    for i, rows in enumerate(loads):
        day = f"2024-01-0{i + 1}"
        jobs.run_customer_snapshot(cust(spark, rows), full, day, strict=True)
        jobs.run_customer_history_strict(cust(spark, rows), split, day)
    a = sorted(map(tuple, full.read().collect()), key=str)
    b = sorted(map(tuple, split.read().collect()), key=str)
    assert a == b and len(a) == 7
    # only open versions are rewritten: the last open version holds one row per customer
    assert split.open_versions().count() == 3


def test_open_closed_history_is_complete_at_each_moment(spark, monkeypatch):
    """A run that dies before it publishes changes nothing; what it wrote is never read."""
    from stockledger.sources.history import OpenClosedHistory
    from stockledger.sources.storage import CommitLog

    split = OpenClosedHistory(spark, shared_dir(spark, "test_history"))
    jobs.run_customer_history_strict(cust(spark, [(1, "A", 5)]), split, "2024-01-01")
    before = history_rows(split.read())

    def dies(self, base, state):
        assert history_rows(split.read()) == before  # a reader between the write and the commit
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "publish", dies)
        with pytest.raises(RuntimeError, match="executor lost"):
            jobs.run_customer_history_strict(cust(spark, [(1, "B", 5)]), split, "2024-01-02")
    assert history_rows(split.read()) == before
    jobs.run_customer_history_strict(cust(spark, [(1, "B", 5)]), split, "2024-01-02")
    assert history_rows(split.read()) == [(1, "A", 1, 2), (1, "B", 2, None)]


def history_rows(df):
    return sorted(
        ((r.c_customer_sk, r.c_salutation, r.start_date.day, r.end_date.day if r.end_date else None)
         for r in df.collect()),
        key=lambda x: (x[0], x[2]),
    )


# --- history in buckets of the customer key ------------------------------------


def bucketed(spark, loads, strict=False, buckets=4):
    table = BucketedHistory(spark, shared_dir(spark, "test_buckets"), strict, buckets)
    for i, rows in enumerate(loads):
        table.run(cust(spark, rows), f"2024-01-0{i + 1}")
    return table


LOADS = [
    [(1, "A", 5), (2, "A", None), (3, None, 1), (4, "A", 1), (None, "N", 1)],
    [(1, "B", 5), (2, "A", 0), (3, None, 1), (5, "A", 1), (None, "N", 1)],
    [(1, "A", 5), (2, None, 0), (3, "C", 1), (4, "A", 1), (5, "B", 2)],
    [(1, "A", 5), (2, "A", 0), (4, "A", 2), (6, None, None), (None, "M", 1)],
]


@pytest.mark.parametrize("strict", [False, True])
def test_buckets_hold_what_the_plain_history_holds(spark, strict):
    plain = jobs.customer_snapshot_table(spark, shared_dir(spark, "test_snapshot"))
    table = bucketed(spark, [], strict)
    for i, rows in enumerate(LOADS):
        jobs.run_customer_snapshot(cust(spark, rows), plain, f"2024-01-0{i + 1}", strict=strict)
        table.run(cust(spark, rows), f"2024-01-0{i + 1}")
        assert sorted(map(str, table.read().collect())) == sorted(map(str, plain.read().collect()))
    open_ = plain.read().where("end_date IS NULL")
    assert sorted(map(str, table.open_versions().collect())) == sorted(map(str, open_.collect()))
    assert list_names(spark, f"{table.root}/loads") == []


@pytest.mark.parametrize("strict", [False, True])
def test_a_run_moves_no_stored_row(spark, strict):
    table = bucketed(spark, LOADS, strict)
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        staged, _, _ = table.stage(cust(spark, LOADS[0]))
        plan = table.plan(staged, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
        groups = staged.groupBy("c_customer_sk").count()._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.split("\n") if "Exchange" in x]
    # strict: rows without a key alone, which match null-safely
    assert len(moved) == (2 if strict else 0) and "SortMergeJoin" in plan, plan
    assert "Exchange" not in groups


def test_buckets_refuse_two_rows_for_a_customer_and_keep_the_table(spark):
    table = bucketed(spark, LOADS[:1])
    before = sorted(map(str, table.read().collect()))
    with pytest.raises(ValueError):
        table.run(cust(spark, [(1, "A", 5), (1, "B", 5)]), "2024-01-02")
    assert sorted(map(str, table.read().collect())) == before
    strict = bucketed(spark, [[(1, "A", 5), (1, "A", 5)]], strict=True)
    assert strict.read().count() == 1
