"""Properties of the results that hold whatever the data."""

from pyspark.sql import functions as F

from conftest import SF0001
from stockpilot import registry
from stockpilot.plans.stages import Inputs, Stages


def test_units_and_quantities_are_never_negative(spark):
    st = registry.stages(spark, SF0001)
    assert st.recommended.where("recomended_order_qty < 0 OR recomended_order_qty IS NULL").count() == 0
    assert st.recommendations.where("recomended_order_units < 0").count() == 0
    assert st.store_need.where("replenishment_order_qty < 0").count() == 0


def test_missing_and_present_split_the_request(spark):
    st = registry.stages(spark, SF0001)
    requested = {r.sku for r in st.expanded.select("sku").distinct().collect()}
    missing = {r.sku for r in st.missing_skus.collect()}
    present = {r.parent_sku for r in st.inventory.select("parent_sku").distinct().collect()}
    recommended = {r.parent_sku for r in st.recommendations.select("parent_sku").distinct().collect()}
    assert missing | present == requested
    assert not missing & present
    assert not recommended & missing


def test_period_split_adds_up(spark):
    st = registry.stages(spark, SF0001)
    totals = st.warehouse_per_position.where("has_window").groupBy("parent_sku", "input_source_store").agg(
        (F.sum("early_ordered") - F.sum("early_received") + F.sum("late_ordered")).alias("total")
    )
    pos = st.warehouse_position.where("copies = 1").join(totals, ["parent_sku", "input_source_store"])
    bad = pos.where(
        F.col("first_period_short_term_oo") + F.col("second_period_short_term_oo") != F.col("total") * F.col("ppk_qty")
    )
    assert bad.count() == 0


def test_row_order_does_not_matter(spark):
    st = registry.stages(spark, SF0001)
    i = st.inputs

    def shuffled(df, seed):
        return df.repartition(5).sortWithinPartitions(F.rand(seed))

    other = Inputs(*(shuffled(df, n) for n, df in enumerate(
        (i.request, i.catalog, i.inventory, i.warehouse_orders, i.store_orders, i.forecast))))
    a = sorted(tuple(r) for r in st.recommendations.collect())
    b = sorted(tuple(r) for r in Stages(other, st.cfg).recommendations.collect())
    assert a == b
