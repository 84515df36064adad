"""Property tests: Spark operators against brute-force Python on random inputs."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockledger import schemas
from stockledger.operators import calendar, customers, sales, weekly
from stockledger.plans import jobs
from stockledger.session import shared_dir
from stockledger.sources import csv_ingest

SUN = 19729  # 2024-01-07
EPOCH = dt.date(1970, 1, 1)
CH = ("{p}warehouse_sk bigint, {p}item_sk bigint, {p}sold_date_sk bigint, {p}quantity bigint, "
      "{p}sales_price decimal(12,2), {p}net_profit decimal(18,4)")

line = st.tuples(
    st.sampled_from([None, 1, 2]),
    st.sampled_from([1, 2]),
    st.sampled_from([None, SUN, SUN + 1, SUN + 8]),
    st.sampled_from([None, 0, 1, 3]),
    st.sampled_from([None, Decimal("1.25"), Decimal("2.00")]),
    st.sampled_from([None, Decimal("0.5000"), Decimal("-0.2500")]),
)

FAST = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _week(day_sk: int) -> tuple[int, int]:
    d = EPOCH + dt.timedelta(days=day_sk)
    sunday = d - dt.timedelta(days=(d.weekday() + 1) % 7)
    return (sunday.timetuple().tm_yday - 1) // 7 + 1, sunday.year


def brute_daily(rows, since):
    groups = defaultdict(lambda: [0, Decimal(0), None])
    for wh, item, day, qty, price, profit in rows:
        if day is None or day < (since or 0) or qty is None or price is None:
            continue
        g = groups[(wh, item, day)]
        g[0] += qty
        g[1] += price * qty
        if profit is not None:
            g[2] = (g[2] or Decimal(0)) + profit
    out = set()
    for (wh, item, day), (q, amt, prof) in groups.items():
        wk, yr = _week(day)
        out.add((wh, item, day, wk, yr, q, float(amt), None if prof is None else float(prof)))
    return out


@FAST
@given(cat=st.lists(line, max_size=12), web=st.lists(line, max_size=12), since=st.sampled_from([None, SUN + 1]))
def test_daily_matches_brute_force(spark, cat, web, since):
    cs = spark.createDataFrame(cat, CH.format(p="cs_"))
    ws = spark.createDataFrame(web, CH.format(p="ws_"))
    bounds = spark.createDataFrame([(dt.date(2024, 1, 7), dt.date(2024, 1, 20))], "lo date, hi date")
    d = sales.daily_sales(sales.sales_union(cs, ws, since), calendar.calendar_between(bounds))
    got = {tuple(r) for r in d.collect()}
    assert got == brute_daily(cat + web, since)


# --- SCD2 ---------------------------------------------------------------------

KEY = "c_customer_sk"


def _row(sk, sal, cdemo):
    vals = dict.fromkeys(schemas.CUSTOMER_COLUMNS)
    vals.update(c_customer_sk=sk, c_salutation=sal, c_current_cdemo_sk=cdemo, c_preferred_cust_flag="Y",
                c_login=f"l{sk}", c_first_name="F", c_current_addr_sk=sk, c_last_name="L",
                c_customer_id=f"C{sk}", c_birth_country="X", c_email_address="e")
    return vals


def brute_literal(hist, source, run):
    def match(t, s):
        return all(t[c] is not None and s[c] is not None and t[c] == s[c] for c in customers.PLAIN_COLUMNS) and all(
            (t[c] or 0) == (s[c] or 0) for c in customers.COALESCED_COLUMNS)

    def changed(t, s):  # three-valued OR: true only if some comparison is definitely true
        return any(t[c] is not None and s[c] is not None and t[c] != s[c]
                   for c in customers.PLAIN_COLUMNS if c != KEY) or any(
            (t[c] or 0) != (s[c] or 0) for c in customers.COALESCED_COLUMNS)

    by_key = {s[KEY]: s for s in source}
    kept = [dict(t, end_date=run if t[KEY] in by_key and changed(t, by_key[t[KEY]]) else t["end_date"])
            for t in hist]
    new = [dict(s, start_date=run, end_date=None) for s in source if not any(match(t, s) for t in hist)]
    return kept + new


def brute_strict(hist, source, run):
    cols = schemas.CUSTOMER_COLUMNS
    by_key = {s[KEY]: s for s in source}
    kept = [dict(t, end_date=run if t["end_date"] is None and t[KEY] in by_key
                 and any(t[c] != by_key[t[KEY]][c] for c in cols if c != KEY) else t["end_date"]) for t in hist]
    new = [dict(s, start_date=run, end_date=None) for s in source
           if not any(t["end_date"] is None and all(t[c] == s[c] for c in cols) for t in hist)]
    return kept + new


load = st.dictionaries(st.sampled_from([1, 2, 3]),
                       st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([0, 1, None])),
                       max_size=3)


@FAST
@given(loads=st.lists(load, min_size=1, max_size=4), strict=st.booleans())
def test_scd2_matches_brute_force(spark, loads, strict):
    table = jobs.customer_snapshot_table(spark, shared_dir(spark, "prop_snapshot"))
    hist: list[dict] = []
    for i, ld in enumerate(loads):
        day = dt.datetime(2024, 1, i + 1)
        source = [_row(sk, sal, cd) for sk, (sal, cd) in sorted(ld.items())]
        df = spark.createDataFrame([tuple(r[c] for c in schemas.CUSTOMER_COLUMNS) for r in source], schemas.CUSTOMER)
        jobs.run_customer_snapshot(df, table, day.date().isoformat(), strict=strict)
        hist = (brute_strict if strict else brute_literal)(hist, source, day)

    def key(r):
        return (r[KEY], r["c_salutation"], r["c_current_cdemo_sk"], r["start_date"], r["end_date"])

    got = sorted((key(r.asDict()) for r in table.read().collect()), key=repr)
    assert got == sorted((key(r) for r in hist), key=repr)


# --- weekly fact ----------------------------------------------------------------

DAILY = ("warehouse_sk bigint, item_sk bigint, sold_date_sk bigint, sold_wk_num bigint, sold_yr_num bigint, "
         "daily_qty bigint, daily_sales_amt double, daily_net_profit double")
Q6 = Decimal("0.000001")


def brute_weekly(daily, inv, since):
    days = {SUN + i: _week(SUN + i) for i in range(-7, 28)}
    sundays = defaultdict(list)
    for sk, wy in days.items():
        if (EPOCH + dt.timedelta(days=sk)).weekday() == 6:
            sundays[wy].append(sk)
    weeks = {}
    for wh, item, day, wk, yr, qty, amt, prof in daily:
        if wk is None:
            continue
        g = weeks.setdefault((wh, item, wk, yr), [day, 0, Decimal(0), Decimal(0)])
        g[0] = min(g[0], day)
        g[1] += qty
        g[2] += Decimal(repr(amt)).quantize(Decimal("0.0001"))
        g[3] += Decimal(repr(prof)).quantize(Decimal("0.0001"))
    inv_w = [(d, i, q, w, *days[d]) for d, i, q, w in inv if d in days]
    out = {}
    for (wh, item, wk, yr), (first, q, a, p) in weeks.items():
        if first < (since or 0):
            continue
        for sunday in sundays.get((wk, yr), []):
            matches = [x for x in inv_w if x[4] == wk and x[5] == yr and x[1] == item and x[3] == wh] or [None]
            for m in matches:
                o = out.setdefault((wh, item, wk, yr), [sunday, 0, Decimal(0), Decimal(0), 0])
                o[0] = min(o[0], sunday)
                o[1] += q
                o[2] += a
                o[3] += p
                o[4] += (m[2] or 0) if m else 0
    rows = set()
    for (wh, item, wk, yr), (sk, q, a, p, iq) in out.items():
        if q <= 0:
            continue
        avg = (Decimal(q) / 7).quantize(Q6, ROUND_HALF_UP)
        wks = (Decimal(iq) / Decimal(q)).quantize(Q6, ROUND_HALF_UP)
        rows.add((wh, item, sk, wk, yr, q, float(a), float(p), avg, iq, wks, bool(avg > 0 and avg > iq)))
    return rows


daily_row = st.builds(
    lambda wh, item, off, qty, amt, prof: (wh, item, SUN + off, *_week(SUN + off), qty, amt, prof),
    st.sampled_from([None, 1, 2]), st.sampled_from([1, 2]), st.integers(0, 20),
    st.sampled_from([0, 1, 4, 9]), st.sampled_from([0.0, 12.5, 3.25]), st.sampled_from([0.0, 1.1, -0.75]),
)
inv_row = st.tuples(st.integers(SUN - 3, SUN + 24), st.sampled_from([1, 2]),
                    st.sampled_from([None, 0, 7, 30]), st.sampled_from([1, 2]))


@FAST
@given(daily=st.lists(daily_row, max_size=14, unique_by=lambda r: (r[0], r[1], r[2])),
       inv=st.lists(inv_row, max_size=10), since=st.sampled_from([None, SUN + 7]))
def test_weekly_matches_brute_force(spark, daily, inv, since):
    d = spark.createDataFrame(daily, DAILY)
    i = spark.createDataFrame(inv, schemas.INVENTORY)
    bounds = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 2, 3))], "lo date, hi date")
    got = {tuple(r) for r in weekly.weekly_sales_inventory(d, i, calendar.calendar_between(bounds), since).collect()}
    assert got == brute_weekly(daily, inv, since)


# --- CSV ingest -----------------------------------------------------------------

token = st.sampled_from(["1", "23", "-4", "", "x", "7a", '"5"', '""', " 8", "2147483648"])


def brute_csv(lines):
    good = []
    for line in lines:
        fields = [f[1:-1] if len(f) >= 2 and f[0] == f[-1] == '"' else f for f in line.split(",")]
        if len(fields) != 4:
            continue
        vals = []
        for f in fields:
            f = f.strip()
            if f == "":
                vals.append(None)
            else:
                try:
                    v = int(Decimal(f).quantize(Decimal(1), ROUND_HALF_UP))
                except (ArithmeticError, ValueError):
                    break
                if not -2**63 <= v < 2**63:
                    break
                vals.append(v)
        else:
            if None not in (vals[0], vals[1], vals[3]):
                good.append(tuple(vals))
    return sorted(good, key=repr)


@FAST
@given(lines=st.lists(st.lists(token, min_size=3, max_size=5).map(",".join), min_size=1, max_size=15))
def test_csv_matches_brute_force(spark, lines):
    path = shared_dir(spark, "prop_csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    load = csv_ingest.read_csv_drop(spark, path)
    want = brute_csv(lines)
    assert sorted(map(tuple, load.good.collect()), key=repr) == want
    assert load.good.count() == len(want)  # column pruning does not change the verdict
    assert load.good.count() + load.rejected.count() == len(lines)
