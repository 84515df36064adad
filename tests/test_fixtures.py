"""Invariants of the retail views derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger import schemas
from stockledger.sources import fixtures as fx
from stockledger.sources.tables import Tables


def test_channels_cover_all_lines(spark, sf_dir):
    t = Tables(spark, sf_dir)
    assert fx.catalog_sales(t).count() + fx.web_sales(t).count() == t.lineitem.count()


def test_preview_is_repeatable(spark, sf_dir):
    # (order, line) is not unique in the test data: the preview orders by every column
    from stockledger.operators import explore

    cs = fx.catalog_sales(Tables(spark, sf_dir))
    assert cs.select("cs_order_number", "cs_line_number").distinct().count() < cs.count()
    a = explore.preview(cs, ["cs_order_number", "cs_line_number"], 50).collect()
    b = explore.preview(cs.repartition(7, "cs_item_sk"), ["cs_order_number", "cs_line_number"], 50).collect()
    assert a == b


def test_channels_carry_defects(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cs = fx.catalog_sales(t).unionByName(
        fx.web_sales(t).select([F.col(c).alias("cs_" + c[3:]) for c in fx.web_sales(t).columns]))
    nulls = cs.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in
                     ("cs_warehouse_sk", "cs_sold_date_sk", "cs_quantity", "cs_sales_price")]).first()
    assert all(v > 0 for v in nulls)
    assert {r[0] for r in cs.select("cs_warehouse_sk").distinct().collect()} <= {None, 1, 2, 3, 4, 5, 6}


def test_inventory_shape(spark, sf_dir):
    t = Tables(spark, sf_dir)
    inv = fx.inventory(t)
    assert [(f.name, f.dataType) for f in inv.schema] == [(f.name, f.dataType) for f in schemas.INVENTORY]
    assert inv.count() == inv.select("inv_data_sk", "inv_item_sk", "inv_warehouse_sk").distinct().count()
    dows = {r[0] for r in inv.select(F.pmod(F.col("inv_data_sk") + 4, 7)).distinct().collect()}
    assert dows <= {2, 4}  # Tuesday snapshots, Thursday extras
    assert inv.where(F.col("inv_quantity_on_hand").isNull()).count() > 0


def test_customer_loads(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = t.customer.count()
    loads = [fx.customer_load(t, k) for k in range(3)]
    assert loads[2].count() == n
    assert loads[0].count() < n and loads[1].count() < n
    for df in loads:
        assert df.columns == list(schemas.CUSTOMER_COLUMNS)
        assert df.select("c_customer_sk").distinct().count() == df.count()
    assert loads[1].where(F.col("c_salutation") == "CHANGED").count() > 0
    assert loads[1].where(F.col("c_salutation").isNull()).count() > 0
