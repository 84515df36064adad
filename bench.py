"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver). Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockledger.plans.queries import registry  # noqa: E402
from stockledger.session import get_session  # noqa: E402

# The flagship first, then the rest of the mart in job order.
HEADLINE = (
    "weekly_sales_inventory",
    "daily_sales",
    "sales_union",
    "inventory_with_week",
    "weekly_missing_sunday",
    "daily_sales_incremental",
    "weekly_sales_incremental",
    "weekly_incremental_iso_calendar",
    "daily_late_rows",
    "daily_vanished_slice",
    "daily_late_report",
    "daily_sales_sql",
    "weekly_from_raw",
    "explore_cardinality_by_day",
    "ingest_to_weekly",
    "customer_scd2",
    "customer_scd2_strict",
    "customer_dim_current",
    "csv_ingest_skip_bad",
    "csv_full_refresh",
    "csv_rejected_lines",
    "csv_truncate_reload",
    "dim_snapshot_copy",
    "dq_not_null",
    "dq_unique",
    "dq_relationship",
    "dq_accepted_values",
    "dq_orphan_key",
    "explore_date_bounds",
    "explore_daily_arrivals",
    "explore_fk_probe",
    "explore_sales_preview",
    "explore_inventory_counts",
    "explore_item_days",
    "explore_distinct_items",
    "explore_distinct_customers",
    "explore_cardinality",
    "customer_null_key_count",
    "explore_calendar_head",
    "explore_calendar_day",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="stockledger-bench-")
    spark = get_session(
        f"local[{cpus}]",
        app_name="stockledger-bench",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "16g", "spark.local.dir": scratch},
    )
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoint"))
    reg = registry()
    names = [n for n in HEADLINE if n in reg] + sorted(set(reg) - set(HEADLINE))
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    # Warm-up (untimed): JVM start, JIT compilation and class loading are not
    # query time. One run of the flagship exercises the same operators.
    reg["weekly_sales_inventory"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        try:
            reg[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # report the failure, keep benchmarking the rest
            failed[name] = repr(e)[:300]
            continue
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
