"""The command-line jobs end to end on Parquet inputs derived from the test tables."""

from __future__ import annotations

from stockledger.plans import cli
from stockledger.session import shared_dir
from stockledger.sources import fixtures as fx
from stockledger.sources.storage import open_table
from stockledger.sources.tables import Tables


def test_cli_jobs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "test_cli")
    inputs = {
        "cs": fx.catalog_sales(t), "ws": fx.web_sales(t), "cal": fx.date_dim(t), "inv": fx.inventory(t),
        "cust": fx.customer_load(t, 0), "addr": fx.customer_address(t), "cd": fx.customer_demographics(t),
        "hd": fx.household_demographics(t), "ib": fx.income_band(t), "item": fx.item(t),
    }
    for name, df in inputs.items():
        df.write.parquet(f"{root}/{name}")
    p = {k: f"{root}/{k}" for k in inputs}
    out = cli.main(["daily", "--catalog-sales", p["cs"], "--web-sales", p["ws"], "--date-dim", p["cal"],
                    "--target", f"{root}/daily"])
    assert out["watermark"] is None
    assert cli.main(["daily", "--catalog-sales", p["cs"], "--web-sales", p["ws"], "--date-dim", p["cal"],
                     "--target", f"{root}/daily"])["watermark"] is not None
    cli.main(["weekly", "--daily", f"{root}/daily", "--inventory", p["inv"], "--date-dim", p["cal"],
              "--target", f"{root}/weekly"])
    explained = cli.main(["weekly", "--explain", "--daily", f"{root}/daily", "--inventory", p["inv"],
                          "--date-dim", p["cal"], "--target", f"{root}/weekly"])
    assert explained["watermark"] is not None  # planned against the stored table, nothing written
    assert cli.main(["customers", "--customer", p["cust"], "--snapshot", f"{root}/snap",
                     "--run-date", "2024-01-01"])["version"] == 1
    cli.main(["customer-dim", "--snapshot", f"{root}/snap", "--address", p["addr"], "--demographics", p["cd"],
              "--household", p["hd"], "--income-band", p["ib"], "--target", f"{root}/dim"])
    assert cli.main(["customers", "--strict", "--customer", p["cust"], "--snapshot", f"{root}/hist",
                     "--run-date", "2024-01-01"])["version"] == 1
    cli.main(["customer-dim", "--strict", "--snapshot", f"{root}/hist", "--address", p["addr"],
              "--demographics", p["cd"], "--household", p["hd"], "--income-band", p["ib"],
              "--target", f"{root}/dim_strict"])
    cli.main(["copy", "--source", p["item"], "--target", f"{root}/item_dim"])
    checks = cli.main(["checks", "--weekly", f"{root}/weekly", "--item-dim", f"{root}/item_dim",
                       "--customer-dim", f"{root}/dim", "--customer", p["cust"],
                       "--customer-demographics", p["cd"]])["checks"]
    assert len(checks) == 5 and all(c["passed"] for c in checks), checks
    drop = f"{root}/inventory_csv"
    fx.inventory_csv_lines(inputs["inv"]).write.text(drop)
    assert cli.main(["ingest", "--csv", drop, "--target", f"{root}/raw_inv", "--rejects", f"{root}/rejects"])["version"] == 1
    good = open_table(spark, f"{root}/raw_inv").count()
    bad = open_table(spark, f"{root}/rejects").count()
    assert good + bad == inputs["inv"].count() + 1 and bad > 1  # + the header line
    a = open_table(spark, f"{root}/dim").count()
    assert a == open_table(spark, f"{root}/dim_strict").count() > 0
    # a second ingest of the same drop, the weekly job on the stored root: nothing doubles
    weekly = ["weekly", "--daily", f"{root}/daily", "--inventory", f"{root}/raw_inv", "--date-dim", p["cal"], "--target"]
    cli.main([*weekly, f"{root}/weekly_1"])
    assert cli.main(["ingest", "--csv", drop, "--target", f"{root}/raw_inv"])["version"] == 2
    cli.main([*weekly, f"{root}/weekly_2"])
    one, two = (sorted(map(tuple, open_table(spark, f"{root}/weekly_{i}").collect()), key=str) for i in (1, 2))
    assert one == two and one
    # a copy of a stored table takes its newest version, and a second copy replaces the first
    for _ in range(2):
        cli.main(["copy", "--source", f"{root}/raw_inv", "--target", f"{root}/inv_copy"])
    assert open_table(spark, f"{root}/inv_copy").count() == good
