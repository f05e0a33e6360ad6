"""Fixture tables and stage sizes agree with FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from stockpilot import registry
from stockpilot.oracle.compare import duckdb_rows
from stockpilot.sources.fixtures import fixture_tables

VIEW_ROWS = {
    SF0001: dict(request=53, catalog=200, inventory=1556, warehouse_orders=2501, store_orders=3499, forecast=26005,
                 warehouse_feed=2577, store_feed=3590),
    SF001: dict(request=343, catalog=2000, inventory=14872, warehouse_orders=25701, store_orders=34299, forecast=248846,
                warehouse_feed=26352, store_feed=35174),
}


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_view_rows(spark, sf):
    ft = fixture_tables(spark, sf)
    got = {name: getattr(ft, name).count() for name in VIEW_ROWS[sf]}
    assert got == VIEW_ROWS[sf]


def test_stage_rows_sf0001(spark):
    st = registry.stages(spark, SF0001)
    assert st.expanded.count() == 57
    assert st.missing_skus.count() == 5
    assert st.missing_skus.where(F.col("sku").isNull()).count() == 1
    assert st.inventory.count() == 460
    assert st.warehouse_position.agg(F.sum("copies")).first()[0] == 311
    assert st.store_position.agg(F.sum("copies")).first()[0] == 192
    assert st.store_forecast.count() == 167
    assert st.store_need.where("replenishment_order_qty > 0").count() == 115
    rec = st.recommendations
    assert rec.count() == 297
    assert rec.where("recomended_order_units > 0").count() == 24
    assert rec.agg(F.sum("recomended_order_units")).first()[0] == 1330


def test_final_rows_sf001(spark):
    rec = registry.stages(spark, SF001).recommendations
    assert rec.count() == 3709
    assert rec.where("recomended_order_units > 0").count() == 554
    assert rec.agg(F.sum("recomended_order_units")).first()[0] == 18718


def test_final_rows_sf01(spark):
    st = registry.stages(spark, "/root/testdata/sf0.1")
    assert st.expanded.count() == 18612
    assert st.missing_skus.count() == 1875
    assert st.store_forecast.count() == 56062
    rec = st.recommendations
    assert rec.count() == 95770
    assert rec.where("recomended_order_units > 0").count() == 13889
    assert rec.agg(F.sum("recomended_order_units")).first()[0] == 410647


@pytest.mark.parametrize("sf, rows, most", [(SF0001, 10, 9), (SF001, 270, 7)])
def test_warehouse_positions_without_orders_in_any_window(spark, sf, rows, most):
    """The zero-fill of warehouses, and its rows repeated once per order row."""
    position = registry.stages(spark, sf).warehouse_position
    zero = position.where("first_period_short_term_oo = 0 and second_period_short_term_oo = 0")
    assert position.agg(F.max("copies")).first()[0] == most
    assert zero.count() >= rows and registry.ENTRIES["jn_semi"].query(spark, sf).count() >= rows


def test_every_query_has_rows(spark):
    """What compares nothing with nothing tests nothing."""
    sql = registry.oracle_sql()
    empty = [key for key in sorted(sql) if not duckdb_rows(sql[key], SF0001)[1]]
    assert not empty


def test_feeds_read_each_order_line_once(spark):
    """The repeated rows of a feed come from the same scan."""
    plan = fixture_tables(spark, SF0001).warehouse_feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_linenumber") and plan.count("FileScan") == 4
