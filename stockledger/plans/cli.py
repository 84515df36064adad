"""Command-line entry for the scheduled jobs, so any scheduler can run them.

    python -m stockledger.plans.cli daily --catalog-sales P --web-sales P --date-dim P --target P [--explain]
    python -m stockledger.plans.cli weekly --daily P --inventory P --date-dim P --target P [--explain]
    python -m stockledger.plans.cli customers --customer P --snapshot P --run-date 2024-01-03 [--strict]
    python -m stockledger.plans.cli customer-dim --snapshot P --address P --demographics P \
        --household P --income-band P --target P
    python -m stockledger.plans.cli ingest --csv P --target P [--rejects P]
    python -m stockledger.plans.cli copy --source P --target P
    python -m stockledger.plans.cli checks --weekly P --item-dim P --customer-dim P \
        --customer P --customer-demographics P

Inputs are roots of stored tables (read through their newest commit) or plain
Parquet paths, the CSV drop excepted. Stored outputs use the layouts of
:mod:`stockledger.sources.storage`; ``checks`` prints one verdict row per test. Each command prints a one-line JSON summary.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from functools import partial

from pyspark.sql import types as T

from stockledger import schemas
from stockledger.operators import quality
from stockledger.plans import jobs
from stockledger.session import get_session
from stockledger.sources import csv_ingest
from stockledger.operators.customers import customer_dimension
from stockledger.operators.quality import ACCEPTED_WAREHOUSES
from stockledger.sources.bucketed import BucketedHistory
from stockledger.sources.storage import VersionedTable, copy_table, empty_frame, open_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stockledger")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily", help="incremental daily sales aggregate")
    for a in ("--catalog-sales", "--web-sales", "--date-dim", "--target"):
        d.add_argument(a, required=True)
    d.add_argument("--explain", action="store_true", help="print the batch's physical plan, write nothing")

    w = sub.add_parser("weekly", help="incremental weekly sales x inventory fact")
    for a in ("--daily", "--inventory", "--date-dim", "--target"):
        w.add_argument(a, required=True)
    w.add_argument("--explain", action="store_true", help="print the batch's physical plan, write nothing")

    c = sub.add_parser("customers", help="apply one customer load to the history")
    for a in ("--customer", "--snapshot", "--run-date"):
        c.add_argument(a, required=True)
    c.add_argument("--strict", action="store_true",
                   help="null-safe, open-versions-only merge; history kept as open + append-only closed versions")

    cd = sub.add_parser("customer-dim", help="rebuild the current-customer dimension")
    for a in ("--snapshot", "--address", "--demographics", "--household", "--income-band", "--target"):
        cd.add_argument(a, required=True)
    cd.add_argument("--strict", action="store_true", help="the snapshot was built with customers --strict")

    i = sub.add_parser("ingest", help="full refresh of the inventory from a CSV drop")
    i.add_argument("--csv", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--rejects", default=None)

    cp = sub.add_parser("copy", help="copy a table (clone)")
    cp.add_argument("--source", required=True)
    cp.add_argument("--target", required=True)

    ch = sub.add_parser("checks", help="the five data-quality tests")
    for a in ("--weekly", "--item-dim", "--customer-dim", "--customer", "--customer-demographics"):
        ch.add_argument(a, required=True)
    return p


def main(argv: Sequence[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(args.master, app_name=f"stockledger-{args.cmd}")
    read = partial(open_table, spark)
    out: dict = {"command": args.cmd}
    if args.cmd == "daily":
        inputs = (read(args.catalog_sales), read(args.web_sales), read(args.date_dim),
                  jobs.daily_table(spark, args.target))
        if args.explain:
            wm, batch = jobs.plan_daily_sales(*inputs)
            batch.explain("formatted")
            out["watermark"] = wm
        else:
            out["watermark"] = jobs.run_daily_sales(*inputs).watermark
    elif args.cmd == "weekly":
        inputs = (jobs.daily_table(spark, args.daily), read(args.inventory), read(args.date_dim),
                  jobs.weekly_table(spark, args.target))
        if args.explain:
            wm, batch = jobs.plan_weekly_sales_inventory(*inputs)
            if batch is not None:
                batch.explain("formatted")
            out["watermark"] = wm
        else:
            r = jobs.run_weekly_sales_inventory(*inputs)
            out.update(watermark=r.watermark, note=r.note)
    elif args.cmd == "customers":
        out["version"] = BucketedHistory(spark, args.snapshot, args.strict).run(read(args.customer), args.run_date)
    elif args.cmd == "customer-dim":
        snap = BucketedHistory(spark, args.snapshot, args.strict)
        address, demo, house, band = (read(args.address), read(args.demographics), read(args.household),
                                      read(args.income_band))
        schema = customer_dimension(empty_frame(spark, schemas.CUSTOMER_SNAPSHOT), address, demo, house, band).schema
        out["version"] = jobs.run_customer_dimension(snap, address, demo, house, band,
                                                     VersionedTable(spark, args.target, schema))
    elif args.cmd == "ingest":
        rejects = None
        if args.rejects:
            raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.INVENTORY.fields]
                               + [T.StructField(csv_ingest.CORRUPT, T.StringType())])
            rejects = VersionedTable(spark, args.rejects, raw)
        target = VersionedTable(spark, args.target, schemas.INVENTORY)
        out["version"] = csv_ingest.full_refresh(spark, args.csv, target, rejects=rejects)
    elif args.cmd == "copy":
        copy_table(spark, read(args.source), args.target)
    elif args.cmd == "checks":
        weekly = read(args.weekly)
        v = quality.verdicts(
            ("not_null customer_dim.c_customer_sk", quality.not_null(read(args.customer_dim), "c_customer_sk")),
            ("unique weekly(warehouse_sk,item_sk,sold_wk_sk)",
             quality.unique(weekly, ["warehouse_sk", "item_sk", "sold_wk_sk"])),
            ("relationship weekly.item_sk->item_dim.i_item_sk",
             quality.relationship(weekly, "item_sk", read(args.item_dim), "i_item_sk")),
            ("accepted_values weekly.warehouse_sk",
             quality.accepted_values(weekly, "warehouse_sk", ACCEPTED_WAREHOUSES)),
            ("orphan customer.c_current_cdemo_sk",
             quality.orphan_key(read(args.customer), "c_current_cdemo_sk", read(args.customer_demographics),
                                "cd_demo_sk")),
        )
        out["checks"] = [r.asDict() for r in v.collect()]
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
