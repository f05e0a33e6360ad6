"""Plan checks: no Python in the plan, no cross products, pushdown reaches the scan."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockpilot import registry
from stockpilot.operators import positions
from stockpilot.plans.stages import Inputs, Stages
from stockpilot.sources.fixtures import AS_OF

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lazy_flagship_plan_is_jvm_only(spark):
    st = registry.stages(spark, SF0001, materialize=False)
    plan = _plan(st.recommendations) + _plan(st.missing_skus)
    for node in FORBIDDEN:
        assert node not in plan, node


def test_staged_flagship_plans_are_jvm_only(spark):
    st = registry.stages(spark, SF0001)
    for df in (st.warehouse_position, st.store_position, st.store_forecast, st.recommended, st.recommendations):
        plan = _plan(df)
        for node in FORBIDDEN:
            assert node not in plan, node


def test_columns_reach_the_scan(spark):
    plan = _plan(registry.stages(spark, SF0001, materialize=False).warehouse_orders)
    # lineitem is read with the eight columns the order views use, not all of them.
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double," in plan
    assert "l_extendedprice" not in plan


def test_forecast_bounds_are_scan_filters(spark, tmp_path):
    st = registry.stages(spark, SF0001)
    path = str(tmp_path / "forecast")
    st.inputs.forecast.write.parquet(path)
    i = st.inputs
    stored = Inputs(i.request, i.catalog, i.inventory, i.warehouse_orders, i.store_orders, spark.read.parquet(path))
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        plan = _plan(Stages(stored, st.cfg).forecast)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "forecast" in x and "cal_date" in x)
    filters = scan.partition("DataFilters:")[2].partition("Format:")[0]
    assert "first_day" in filters and "max_coverage_date" in filters


def test_orders_are_reduced_below_the_first_exchange(spark):
    """With broadcasting off, a SKU's staged order rows are combined where they are read."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(positions.order_buckets(registry.stages(spark, SF0001).warehouse_orders, "input_source_store"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "partial_sum" in below


def test_a_run_reads_each_source_once(spark):
    """The checks and both branches read the staged extracts."""
    st = registry.stages(spark, SF0001)
    st.prepare()
    for df in (st.warehouse_rows, st.store_rows, st.missing_skus):
        plan = _plan(df)
        assert "lineitem" not in plan and "part.parquet" not in plan


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_a_sku_with_a_third_of_all_rows(spark, broadcast):
    """A hot SKU in the orders and on hand changes no other SKU's result."""
    st = registry.stages(spark, SF0001)
    want = Counter(tuple(r) for r in st.recommendations.collect())
    i, hot = st.inputs, st.skus.agg(F.min("sku")).first()[0]
    n = i.warehouse_orders.count() // 2
    orders = i.warehouse_orders.unionByName(
        spark.range(n).select(
            F.lit(hot).alias("sku"), F.lit(1).alias("store"), F.lit(1).alias("ord_units"), F.lit(0).alias("rcvd_units"),
            F.lit(AS_OF).alias("first_ship_date"), F.lit(None).cast("date").alias("transit_date"), F.col("id").cast("string").alias("promo_fl"),
        )
    )
    stocked = i.inventory.unionByName(
        spark.range(i.inventory.count() // 2).select(
            F.lit(1).alias("input_source_store"), (F.col("id") % 5).cast("int").alias("store"), F.lit(hot).alias("parent_sku"),
            F.lit(hot).alias("baby_sku"), F.lit(5).cast("bigint").alias("parent_oh"), F.lit(3).cast("bigint").alias("baby_oh"),
            (F.col("id") % 9).alias("store_oh"), F.lit(2).cast("bigint").alias("ppk_qty"), F.lit(9.0).alias("lt_days"),
            F.lit(5).cast("bigint").alias("sks_ord_level"),
        )
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        skewed = Stages(Inputs(i.request, i.catalog, stocked, orders, i.store_orders, i.forecast), st.cfg).recommendations
        got = Counter(tuple(r) for r in skewed.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    others = lambda c: {k: v for k, v in c.items() if k[1] != hot}
    without_counts = lambda c: Counter({(*k[:4], k[5]): v for k, v in others(c).items()})
    assert without_counts(got) == without_counts(want)
    assert any(k[1] == hot for k in got)
