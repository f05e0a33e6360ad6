"""Hand-worked examples H1-H3 of FIXTURES.md section 4."""

import datetime as dt

from stockpilot import schemas
from stockpilot.config import Quirks, RunConfig
from stockpilot.plans.stages import Inputs, Stages

AS_OF = dt.date(2024, 1, 1)
D = dt.date


def _orders(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDERS)


def _inputs(spark, inventory_rows, warehouse_rows):
    request = spark.createDataFrame(
        [("ST", "RED", "2024-01-10", 10), ("XX", "RED", "2024-01-10", 10)], schemas.REQUEST
    )
    catalog = spark.createDataFrame([("ST", "RED", 100, 1000), ("ST", "RED", 101, 1010)], schemas.CATALOG)
    inventory = spark.createDataFrame(inventory_rows, schemas.INVENTORY)
    warehouse = _orders(spark, [(100, 1, u, r, s, t, "N") for (u, r, s, t) in warehouse_rows])
    store = _orders(spark, [(100, 11, 3, 1, D(2024, 1, 3), None, "N"), (100, 11, 5, 0, D(2024, 1, 16), None, "N")])
    days = [(D(2024, 1, 2), 3.5), (D(2024, 1, 14), 1.0), (D(2024, 1, 15), 9.0),
            (D(2024, 1, 16), 60.0), (D(2024, 1, 25), 5.0), (D(2024, 1, 26), 7.0)]
    stocked = {(r[3], r[1]) for r in inventory_rows}
    forecast = spark.createDataFrame([(b, s, d, f) for (b, s) in sorted(stocked) for (d, f) in days], schemas.FORECAST)
    return Inputs(request, catalog, inventory, warehouse, store, forecast)


H1_WAREHOUSE = [(10, 4, D(2024, 1, 5), None), (6, 0, D(2024, 1, 1), D(2024, 1, 12)), (8, 0, D(2024, 1, 22), None)]
H3_WAREHOUSE = [(10, 4, D(2024, 2, 5), None), (6, 0, D(2024, 1, 1), D(2024, 2, 12)), (8, 0, D(2024, 1, 22), None)]


def _inv(store, baby, baby_oh, store_oh):
    # input_source_store, store, parent, baby, parent_oh, baby_oh, store_oh, ppk, lt_days, level
    return (1, store, 100, baby, 5, baby_oh, store_oh, 2, 5.0, 8)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_h1(spark):
    st = Stages(_inputs(spark, [_inv(11, 100, 5, 6), _inv(12, 100, 5, 1)], H1_WAREHOUSE), RunConfig(AS_OF, "h1"))
    wp = st.warehouse_position.collect()
    assert [(r.first_period_short_term_oo, r.second_period_short_term_oo, r.copies) for r in wp] == [(12, 12, 1)]
    sp = st.store_position.collect()
    # Store 12 has no in-window order while store 11 does: it is dropped.
    assert [(r.store, r.first_period_store_oo, r.second_period_store_oo) for r in sp] == [(11, 4, 0)]
    f = st.store_forecast.first()
    assert (f.first_period_total_forecast, f.second_period_total_forecast) == (4.5, 65.0)
    need = st.store_need.first()
    assert (need.expected_demand, need.replenishment_order, need.replenishment_order_qty) == (4.0, "Y", 2.0)
    rec = st.recommended.first()
    assert (rec.total_projected_warehouse_oh, rec.recomended_order_qty) == (15.0, 38.0)
    assert _rows(st.recommendations) == [(1, 100, 100, 19, 2, D(2024, 1, 25), "h1")]
    assert _rows(st.missing_skus.fillna(-1, ["sku"])) == [(-1, "h1"), (101, "h1")]


def test_h2(spark):
    inv = [_inv(11, 201, 5, 6), _inv(11, 202, 0, 6)]
    st = Stages(_inputs(spark, inv, H1_WAREHOUSE), RunConfig(AS_OF, "h2"))
    wp = sorted((r.baby_sku, r.first_period_short_term_oo, r.second_period_short_term_oo) for r in st.warehouse_position.collect())
    assert wp == [(201, 24, 24), (202, 24, 24)]
    assert {r.first_period_store_oo for r in st.store_position.collect()} == {8}
    assert {r.replenishment_order_qty for r in st.store_need.collect()} == {0.0}
    q = sorted((r.baby_sku, r.total_projected_warehouse_oh, r.recomended_order_qty) for r in st.recommended.collect())
    assert q == [(201, 29.0, 12.0), (202, 24.0, 17.0)]
    assert [r.recomended_order_units for r in st.recommendations.collect()] == [8, 8]


def test_h3_zero_fill_counts_each_order_row(spark):
    inputs = _inputs(spark, [_inv(11, 100, 5, 6)], H3_WAREHOUSE)
    st = Stages(inputs, RunConfig(AS_OF, "h3"))
    wp = st.warehouse_position.collect()
    assert [(r.first_period_short_term_oo, r.copies) for r in wp] == [(0, 3)]
    rec = st.recommended.first()
    assert (rec.total_projected_warehouse_oh, rec.recomended_order_qty) == (9.0, 56.0)
    assert [r.recomended_order_units for r in st.recommendations.collect()] == [28]

    fixed = Stages(inputs, RunConfig(AS_OF, "h3", Quirks(dedupe_zero_fill=True)))
    rec = fixed.recommended.first()
    assert (rec.total_projected_warehouse_oh, rec.recomended_order_qty) == (3.0, 62.0)
    assert [r.recomended_order_units for r in fixed.recommendations.collect()] == [31]


def test_lazy_and_staged_plans_agree(spark):
    inputs = _inputs(spark, [_inv(11, 201, 5, 6), _inv(11, 202, 0, 6)], H1_WAREHOUSE)
    cfg = RunConfig(AS_OF, "h2")
    assert _rows(Stages(inputs, cfg, materialize=False).recommendations) == _rows(Stages(inputs, cfg).recommendations)
