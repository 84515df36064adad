"""Summarise the physical plan of every registered query (writes PLANS.md).

For each query: number of hash-partitioning exchanges (shuffles), broadcast
and sort-merge joins, and the filters pushed into Parquet scans. Plans are
taken with AQE off (the static plan AQE starts from) and with the broadcast
threshold off, i.e. as if every input were large: what remains broadcast is
what the code broadcasts explicitly (the few keys of a preview).

    python -m stockledger.checks.plan_report /root/testdata/sf0.01 PLANS.md
"""

from __future__ import annotations

import re
import sys

from stockledger.plans.queries import registry
from stockledger.session import get_session
from stockledger.sources.storage import session_conf


def summarise(plan: str) -> dict:
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_sorts": len(re.findall(r"Exchange rangepartitioning", plan)),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "pushed": pushed,
    }


def main(sf_dir: str, out_path: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        "Generated by `python -m stockledger.checks.plan_report`. Static plans with",
        "AQE and the broadcast size threshold off, as if every input were large.",
        "Queries over stored tables (incremental runs, SCD2 versions, CSV loads, copies)",
        "show the plan of reading the final table; their jobs' plans are the daily,",
        "weekly, merge and ingest plans listed for the lazy queries.",
        "",
        "| query | shuffles | range sorts | broadcast joins | sort-merge joins | filters pushed to Parquet |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for name, q in sorted(registry().items()):
            df = q(spark, sf_dir)
            s = summarise(df._jdf.queryExecution().executedPlan().toString())
            pushed = "; ".join(p[:90] for p in s["pushed"]) or "-"
            lines.append(
                f"| {name} | {s['shuffles']} | {s['range_sorts']} | {s['broadcast_joins']} | "
                f"{s['sort_merge_joins']} | {pushed} |"
            )
    lines += ["", *job_section(spark, sf_dir)]
    with open(out_path, "w") as f:
        f.write("\n".join(lines) + "\n")


def job_section(spark, sf_dir: str) -> list[str]:
    """Plans of the scheduled jobs' batches: what a run computes before it writes."""
    from stockledger.operators import customers
    from stockledger.plans import jobs
    from stockledger.plans.queries import stored
    from stockledger.session import shared_dir
    from stockledger.sources import csv_ingest
    from stockledger.sources import fixtures as fx
    from stockledger.sources.tables import Tables

    t = Tables(spark, sf_dir)
    cal = stored(spark, fx.date_dim(t), "date_dim")
    inv = stored(spark, fx.inventory_with_gaps(t), "inventory")
    daily = jobs.daily_table(spark, shared_dir(spark, "plan_daily"))
    weekly_t = jobs.weekly_table(spark, shared_dir(spark, "plan_weekly"))
    snap = jobs.customer_snapshot_table(spark, shared_dir(spark, "plan_snapshot"))
    drop = shared_dir(spark, "plan_csv")
    fx.inventory_csv_lines(inv).write.text(drop)
    out = [
        "## Job batches",
        "",
        "What a run computes; its write adds one `rebalance` shuffle on the slice range (daily, weekly) or none.",
        "",
        "| job batch | shuffles | broadcast joins | sort-merge joins | files read | filters pushed to Parquet |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    static = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def row(label, df):
        with session_conf(spark, static):
            s = summarise(df._jdf.queryExecution().executedPlan().toString())
            pushed = "; ".join(p[:90] for p in s["pushed"]) or "-"
            out.append(f"| {label} | {s['shuffles']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | {len(df.inputFiles())} | {pushed} |")

    with session_conf(spark, static):
        _, batch = jobs.plan_daily_sales(fx.catalog_sales(t), fx.web_sales(t), cal, daily)
    row("daily, full load", batch)
    jobs.run_daily_sales(fx.catalog_sales(t), fx.web_sales(t), cal, daily)
    jobs.run_weekly_sales_inventory(daily, inv, cal, weekly_t)
    with session_conf(spark, static):
        _, batch = jobs.plan_weekly_sales_inventory(daily, inv, cal, weekly_t)
    row(f"weekly, incremental (the daily table holds {len(daily.slices())} days in {len(daily.log.latest()[1]['parts'])} folders)", batch)
    jobs.run_customer_snapshot(fx.customer_load(t, 0), snap, fx.CUSTOMER_LOAD_DATES[0])
    for strict in (False, True):
        with session_conf(spark, static):
            merged = customers.scd2_merge(snap.read(), fx.customer_load(t, 1), fx.CUSTOMER_LOAD_DATES[1], strict=strict)
        row(f"customer history merge ({'strict' if strict else 'literal'})", merged)
    row("CSV ingest, good rows", csv_ingest.read_csv_drop(spark, drop).good)
    out += ["", "The incremental weekly batch opens only the folders of the weeks that can",
            "still qualify, and the inventory scan gets the oldest live day pushed down."]
    return out


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
