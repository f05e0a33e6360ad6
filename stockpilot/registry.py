"""

Each entry pairs a Spark query ``(spark, sf_dir) -> DataFrame`` over the
fixture tables derived from ``sf_dir`` with the SQL select that computes the
same rows from the same base tables in DuckDB (see ``stockpilot.oracle``).
Column names agree between the two.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpilot.config import Quirks, RunConfig
from stockpilot.functions import blank_to, first_period, second_period, to_day, to_int
from stockpilot.functions.expressions import NO
from stockpilot.operators import aggregates, forecast, joins, packs, positions, projection, quality, replenishment
from stockpilot.oracle import sql as oracle
from stockpilot.plans.materialize import materialize
from stockpilot.plans.stages import Inputs, Stages
from stockpilot.session import scratch_path, spread
from stockpilot.sources import extracts, sinks
from stockpilot.sources.fixtures import AS_OF, REQUEST_ID, fixture_tables, slashed_request, text_key_tables

Query = Callable[[SparkSession, str], DataFrame]

ROW_DROP = ("in_window",)


@dataclass(frozen=True)
class Entry:
    query: Query
    sql: str | None


def stages(spark: SparkSession, sf_dir: str, quirks: Quirks | None = None, materialize: bool = True) -> Stages:
    ft = fixture_tables(spark, sf_dir)
    inputs = Inputs(
        request=ft.request,
        catalog=ft.catalog,
        inventory=ft.inventory,
        warehouse_orders=ft.warehouse_orders,
        store_orders=ft.store_orders,
        forecast=ft.forecast,
    )
    return Stages(inputs, RunConfig(as_of=AS_OF, request_id=REQUEST_ID, quirks=quirks or Quirks()), materialize)


def _st(attr: str) -> Query:
    return lambda spark, sf: getattr(stages(spark, sf), attr)


def _warehouse_order_rows(st: Stages) -> DataFrame:
    return positions.order_rows(st.warehouse_onhand, st.warehouse_orders, st.expanded, positions.WAREHOUSE, st.quirks)


def _store_order_rows(st: Stages) -> DataFrame:
    return positions.order_rows(st.inventory, st.store_orders, st.expanded, positions.STORE, st.quirks)


def _distinct_store_positions(st: Stages) -> DataFrame:
    # Spread first: hardly any row repeats, so that combining them before costs memory only.
    return spread(st.store_position.select(*forecast.POSITION_COLUMNS), "baby_sku", "store").distinct()


# ---- sources and sinks -----------------------------------------------------
def q_src_request(spark: SparkSession, sf: str) -> DataFrame:
    ft = fixture_tables(spark, sf)
    path = extracts.write_request_csv(ft.request, scratch_path(spark, "request-csv"))
    return extracts.read_request(spark, path)


def q_src_request_formats(spark: SparkSession, sf: str) -> DataFrame:
    """The request as a spreadsheet writes it: quoted names, month/day/year dates and
    missing values in words, through a CSV file."""
    path = extracts.write_request_csv(slashed_request(fixture_tables(spark, sf).request), scratch_path(spark, "request-csv"))
    read = extracts.read_request(spark, path)
    return read.select("style", "color", to_day("provided_date").alias("provided_date"), "coverage_day")


def q_src_catalog_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ft = fixture_tables(spark, sf)
    return extracts.lookup_skus(ft.catalog, ft.request)


def q_src_inventory(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return extracts.extract_inventory(st.inputs.inventory, st.skus)


def q_stage_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.stage(stages(spark, sf).expanded, scratch_path(spark, "expanded"))


def q_sink_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    df = stages(spark, sf).recommendations
    return sinks.read_back(df, sinks.write_recommendations(df, scratch_path(spark, "recommendations")))


def q_sink_missing_skus(spark: SparkSession, sf: str) -> DataFrame:
    df = stages(spark, sf).missing_skus
    return sinks.read_back(df, sinks.write_missing(df, scratch_path(spark, "missing")))


# ---- data quality ------------------------------------------------------------
def q_dq_null_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(fixture_tables(spark, sf).warehouse_feed)


def q_dq_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    feed = fixture_tables(spark, sf).warehouse_feed
    return quality.duplicate_rows(feed, materialize(quality.repeated_digests(feed), "repeated-digests"))


def q_dq_duplicate_gate(spark: SparkSession, sf: str) -> DataFrame:
    feed = fixture_tables(spark, sf).warehouse_feed
    return quality.duplicate_summary(feed, materialize(quality.repeated_digests(feed), "repeated-digests"))


# ---- projections and filters ---------------------------------------------------
def q_prj_shape(spark: SparkSession, sf: str) -> DataFrame:
    return projection.shape(
        fixture_tables(spark, sf).inventory,
        drop=["lead_time"],
        select=["input_source_store", "store", "parent_sku", "baby_sku", "store_oh"],
        rename={"input_source_store": "warehouse"},
    )


def q_prj_left_wins(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return joins.join_left_wins(st.inputs.catalog, st.expanded, ["sku"], "left")


def q_prj_cast_int(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_tables(spark, sf).inventory.select(
        "input_source_store", "store", "parent_sku", "baby_sku", to_int("lt_days").alias("lt_days")
    )


def q_prj_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_tables(spark, sf).request.select("style", "color", to_day("provided_date").alias("provided_date"))


def q_prj_coverage_dates(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    df = positions.with_coverage_dates(positions.with_sku_attributes(st.warehouse_onhand, st.expanded))
    return df.select("input_source_store", "parent_sku", "baby_sku", "lt_days", "provided_date", "coverage_day", "received_date", "coverage_date")


def q_prj_blank_to_n(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_tables(spark, sf).warehouse_orders.withColumn("promo_fl", blank_to("promo_fl", NO))


def q_prj_effective_date(spark: SparkSession, sf: str) -> DataFrame:
    return _warehouse_order_rows(stages(spark, sf)).drop(*ROW_DROP)


def q_prj_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return joins.enrich(st.warehouse_position, st.warehouse_need, replenishment.WAREHOUSE_ITEM, fill={"total_replenishment_order_qty": 0.0})


def q_prj_clamp_zero(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return replenishment.projected_rows(st.warehouse_position, st.warehouse_need)


def q_prj_round_even(spark: SparkSession, sf: str) -> DataFrame:
    return stages(spark, sf).store_need.select(
        "parent_sku", "baby_sku", "store", "input_source_store", "first_period_total_forecast", "expected_demand"
    )


def q_prj_replen_flag(spark: SparkSession, sf: str) -> DataFrame:
    return stages(spark, sf).store_need.select(
        "parent_sku", "baby_sku", "store", "input_source_store", "store_oh", "expected_demand", "sks_ord_level", "replenishment_order"
    )


def q_prj_pack_units(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.in_window_positions(st.warehouse_per_position, positions.WAREHOUSE).select(*positions.WAREHOUSE.output_columns)


def q_prj_request_id(spark: SparkSession, sf: str) -> DataFrame:
    return projection.with_request_id(stages(spark, sf).expanded, REQUEST_ID)


def q_flt_warehouse_window(spark: SparkSession, sf: str) -> DataFrame:
    return _warehouse_order_rows(stages(spark, sf)).where(F.col("in_window")).drop(*ROW_DROP)


def q_flt_store_window(spark: SparkSession, sf: str) -> DataFrame:
    return _store_order_rows(stages(spark, sf)).where(F.col("in_window")).drop(*ROW_DROP)


def q_flt_first_period(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    rows = forecast.attach_forecast(_distinct_store_positions(st), st.forecast)
    return rows.where(first_period("cal_date", AS_OF, "received_date"))


def q_flt_second_period(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    rows = forecast.attach_forecast(_distinct_store_positions(st), st.forecast)
    return rows.where(second_period("cal_date", "received_date", "coverage_date"))


# ---- joins -------------------------------------------------------------------
def q_jn_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    ft = fixture_tables(spark, sf)
    return joins.full_outer_by_parts(extracts.lookup_skus(ft.catalog, ft.request), ft.request, ["style", "color"])


def q_jn_attribute_lookup(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.lookup_attributes(st.inventory, st.expanded)


def q_jn_left_orders(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.attach_orders(st.warehouse_onhand, st.warehouse_orders, "input_source_store")


def q_jn_inner_request(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.requested_orders(st.warehouse_onhand, st.warehouse_orders, st.expanded, "input_source_store")


def q_jn_left_forecast(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return forecast.attach_forecast(forecast.weighted_positions(st.store_position), st.forecast)


def q_jn_both_periods(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    totals = forecast.period_totals(st.store_position, st.forecast, AS_OF, st.quirks)
    return totals.where((F.col("first_period_rows") > 0) & (F.col("second_period_rows") > 0)).select(
        "parent_sku", "baby_sku", "store", "first_period_total_forecast", "second_period_total_forecast"
    )


def q_jn_anti(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return joins.without(st.expanded.select("sku").distinct(), st.inventory, "sku", "parent_sku")


def q_jn_semi(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    rows = _warehouse_order_rows(st)
    parents = aggregates.distinct_keys(rows, ["parent_sku"])
    covered = aggregates.distinct_keys(rows.where(F.col("in_window")), ["parent_sku"])
    lacking = joins.without(parents, covered, "parent_sku")
    return joins.only(rows, lacking, "parent_sku").drop(*ROW_DROP)


# ---- aggregates --------------------------------------------------------------
def q_agg_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_keys(stages(spark, sf).inventory, ["baby_sku"])


def q_agg_store_count(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return aggregates.store_counts(extracts.extract_inventory(st.inputs.inventory, st.skus))


def q_agg_distinct_positions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _warehouse_order_rows(stages(spark, sf)).where(F.col("in_window"))
    return aggregates.distinct_positions(rows, positions.WAREHOUSE.columns)


def q_agg_drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return aggregates.drop_daily(forecast.attach_forecast(_distinct_store_positions(st), st.forecast))


def q_agg_warehouse_open_orders(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.open_order_totals(st.warehouse_per_position, positions.WAREHOUSE)


def q_agg_store_open_orders(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return positions.open_order_totals(st.store_per_position, positions.STORE)


def q_agg_period_forecast(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return forecast.period_totals(st.store_position, st.forecast, AS_OF, st.quirks)


def q_agg_warehouse_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return replenishment.warehouse_forecast(stages(spark, sf).store_forecast)


def q_agg_parent_max(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return packs.pack_stats(st.recommended, packs.pack_scope(st.quirks)).drop("single_baby")


def q_agg_single_baby(spark: SparkSession, sf: str) -> DataFrame:
    st = stages(spark, sf)
    return packs.pack_stats(st.recommended, packs.pack_scope(st.quirks)).select("parent_sku", "single_baby")


FIXED = Quirks(
    store_extra_lead=False,
    include_received_day=True,
    require_both_periods=False,
    pack_max_scope="warehouse",
    zero_fill_grain="position",
    dedupe_zero_fill=True,
)


def q_recommend_orders_text_keys(spark: SparkSession, sf: str) -> DataFrame:
    ft = text_key_tables(fixture_tables(spark, sf))
    inputs = Inputs(ft.request, ft.catalog, ft.inventory, ft.warehouse_orders, ft.store_orders, ft.forecast)
    return Stages(inputs, RunConfig(as_of=AS_OF, request_id=REQUEST_ID)).recommendations


def q_recommend_orders_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return stages(spark, sf, FIXED).recommendations


_P1 = f"cal_date >= {oracle.AS_OF} AND cal_date < received_date"
_P2 = "cal_date > received_date AND cal_date <= coverage_date"

ENTRIES: dict[str, Entry] = {
    # sources and sinks
    "src_request": Entry(q_src_request, "SELECT style, color, provided_date, coverage_day FROM request"),
    "src_request_formats": Entry(q_src_request_formats, """
        SELECT style || ' 5" "POT"' AS style, CASE WHEN coverage_day = 28 THEN NULL ELSE color END AS color,
               CAST(provided_date AS DATE) AS provided_date, CASE WHEN coverage_day = 35 THEN NULL ELSE coverage_day END AS coverage_day
        FROM request"""),
    "src_catalog_lookup": Entry(q_src_catalog_lookup, "SELECT * FROM looked_up"),
    "src_warehouse_orders": Entry(_st("warehouse_orders"), "SELECT * FROM wo"),
    "src_store_orders": Entry(_st("store_orders"), "SELECT * FROM so"),
    "src_inventory": Entry(q_src_inventory, "SELECT * FROM inv0"),
    "src_forecast": Entry(_st("forecast"), "SELECT * FROM fc"),
    "stage_parquet": Entry(q_stage_parquet, "SELECT * FROM isku"),
    "sink_recommendations": Entry(q_sink_recommendations, "SELECT * FROM recommendations"),
    "sink_missing_skus": Entry(q_sink_missing_skus, "SELECT * FROM missing_skus"),
    # data quality
    "dq_null_check": Entry(q_dq_null_check, "SELECT "
        + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in
                    ("sku", "store", "ord_units", "rcvd_units", "first_ship_date", "transit_date", "promo_fl"))
        + " FROM warehouse_feed"),
    "dq_duplicate_rows": Entry(q_dq_duplicate_rows, """
        SELECT *, count(*) - 1 AS extra_copies FROM warehouse_feed GROUP BY ALL HAVING count(*) > 1"""),
    "dq_duplicate_gate": Entry(q_dq_duplicate_gate, """
        SELECT count(*) AS duplicate_groups, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS extra_rows
        FROM (SELECT *, count(*) AS c FROM warehouse_feed GROUP BY ALL HAVING count(*) > 1)"""),
    # projections and filters
    "prj_shape": Entry(q_prj_shape, "SELECT input_source_store AS warehouse, store, parent_sku, baby_sku, store_oh FROM inventory"),
    "prj_left_wins": Entry(q_prj_left_wins, """
        SELECT c.style, c.color, c.sku, c.item_id, i.provided_date, i.coverage_day
        FROM catalog c LEFT JOIN isku i ON i.sku = c.sku"""),
    "prj_cast_int": Entry(q_prj_cast_int, """
        SELECT input_source_store, store, parent_sku, baby_sku, CAST(trunc(lt_days) AS INTEGER) AS lt_days FROM inventory"""),
    "prj_to_date": Entry(q_prj_to_date, "SELECT style, color, CAST(provided_date AS DATE) AS provided_date FROM request"),
    "prj_coverage_dates": Entry(q_prj_coverage_dates, """
        SELECT h.input_source_store, h.parent_sku, h.baby_sku, CAST(trunc(h.lt_days) AS INTEGER) AS lt_days,
               i.provided_date, i.coverage_day,
               i.provided_date + CAST(trunc(h.lt_days) AS INTEGER) AS received_date,
               i.provided_date + CAST(trunc(h.lt_days) AS INTEGER) + i.coverage_day AS coverage_date
        FROM whse_oh h JOIN isku i ON i.sku = h.parent_sku"""),
    "prj_blank_to_n": Entry(q_prj_blank_to_n, """
        SELECT * REPLACE (CASE WHEN promo_fl = '' THEN 'N' ELSE promo_fl END AS promo_fl) FROM warehouse_orders"""),
    "prj_effective_date": Entry(q_prj_effective_date, "SELECT * FROM whx_d"),
    "prj_zero_fill": Entry(q_prj_zero_fill, "SELECT * EXCLUDE (projected_warehouse_oh) FROM proj_rows"),
    "prj_clamp_zero": Entry(q_prj_clamp_zero, "SELECT * FROM proj_rows"),
    "prj_round_even": Entry(q_prj_round_even, """
        SELECT parent_sku, baby_sku, store, input_source_store, first_period_total_forecast, expected_demand FROM need"""),
    "prj_replen_flag": Entry(q_prj_replen_flag, """
        SELECT parent_sku, baby_sku, store, input_source_store, store_oh, expected_demand, sks_ord_level, replenishment_order
        FROM need"""),
    "prj_pack_units": Entry(q_prj_pack_units, "SELECT * FROM wh_in"),
    "prj_request_id": Entry(q_prj_request_id, f"SELECT *, '{REQUEST_ID}' AS request_id FROM isku"),
    "flt_warehouse_window": Entry(q_flt_warehouse_window, "SELECT * FROM whx_in"),
    "flt_store_window": Entry(q_flt_store_window, "SELECT * FROM stx_in"),
    "flt_first_period": Entry(q_flt_first_period, f"""
        SELECT DISTINCT {oracle.ST_POS_OO}, cal_date, forecast FROM sp_rows WHERE {_P1}"""),
    "flt_second_period": Entry(q_flt_second_period, f"""
        SELECT DISTINCT {oracle.ST_POS_OO}, cal_date, forecast FROM sp_rows WHERE {_P2}"""),
    # joins
    "jn_full_outer": Entry(q_jn_full_outer, """
        SELECT COALESCE(c.style, r.style) AS style, COALESCE(c.color, r.color) AS color, c.sku, c.item_id,
               r.provided_date, r.coverage_day
        FROM looked_up c FULL OUTER JOIN request r ON c.style = r.style AND c.color = r.color"""),
    "jn_attribute_lookup": Entry(q_jn_attribute_lookup, """
        SELECT v.*, i.item_id, i.style, i.color, v.parent_sku AS sku FROM inv v LEFT JOIN isku i ON i.sku = v.parent_sku"""),
    "jn_left_orders": Entry(q_jn_left_orders, "SELECT * FROM whse_oo"),
    "jn_inner_request": Entry(q_jn_inner_request, "SELECT * FROM whx"),
    "jn_left_forecast": Entry(q_jn_left_forecast, f"""
        SELECT p.*, f.cal_date, f.forecast
        FROM (SELECT {oracle.ST_POS_OO}, CAST(sum(copies) AS BIGINT) AS weight FROM store_position
              GROUP BY {oracle.ST_POS_OO}) p
        LEFT JOIN fc f ON f.sku = p.baby_sku AND f.store = p.store"""),
    "jn_both_periods": Entry(q_jn_both_periods, """
        SELECT f1.parent_sku, f1.baby_sku, f1.store, f1.first_period_total_forecast, f2.second_period_total_forecast
        FROM f1 JOIN f2 ON f2.parent_sku = f1.parent_sku AND f2.baby_sku = f1.baby_sku AND f2.store = f1.store"""),
    "jn_left_enrich": Entry(_st("inventory"), "SELECT * FROM inv"),
    "jn_anti": Entry(q_jn_anti, "SELECT sku FROM missing"),
    "jn_semi": Entry(q_jn_semi, """
        SELECT * FROM whx_d d WHERE NOT EXISTS (SELECT 1 FROM whx_in w WHERE w.parent_sku = d.parent_sku)"""),
    # aggregates
    "agg_distinct_keys": Entry(q_agg_distinct_keys, "SELECT DISTINCT baby_sku FROM inv0 WHERE baby_sku IS NOT NULL"),
    "agg_store_count": Entry(q_agg_store_count, "SELECT * FROM store_counts"),
    "agg_first_per_key": Entry(_st("warehouse_onhand"), "SELECT * FROM whse_oh"),
    "agg_distinct_positions": Entry(q_agg_distinct_positions, f"""
        SELECT DISTINCT {oracle.WH_POS} FROM whx_in WHERE {oracle._not_null(oracle.WH_POS)}"""),
    "agg_drop_duplicates": Entry(q_agg_drop_duplicates, f"SELECT DISTINCT {oracle.ST_POS_OO} FROM sp_rows"),
    "agg_warehouse_open_orders": Entry(q_agg_warehouse_open_orders, """
        SELECT sku AS parent_sku, input_source_store, first_units AS first_period_units, second_units AS second_period_units
        FROM wh_tot"""),
    "agg_store_open_orders": Entry(q_agg_store_open_orders, """
        SELECT sku AS parent_sku, store, first_units AS first_period_units, second_units AS second_period_units
        FROM st_tot"""),
    "agg_period_forecast": Entry(q_agg_period_forecast, f"""
        SELECT parent_sku, baby_sku, store,
               COALESCE(sum(CASE WHEN {_P1} THEN copies * forecast END), 0) AS first_period_total_forecast,
               count(CASE WHEN {_P1} THEN 1 END) AS first_period_rows,
               COALESCE(sum(CASE WHEN {_P2} THEN copies * forecast END), 0) AS second_period_total_forecast,
               count(CASE WHEN {_P2} THEN 1 END) AS second_period_rows
        FROM sp_rows GROUP BY parent_sku, baby_sku, store"""),
    "agg_warehouse_rollup": Entry(q_agg_warehouse_rollup, "SELECT * FROM wfc"),
    "agg_max_coverage": Entry(_st("max_coverage"), "SELECT * FROM max_cov"),
    "agg_parent_max": Entry(q_agg_parent_max, """
        SELECT parent_sku, max(recomended_order_qty) AS max_order_qty, max(ppk_qty) AS max_ppk_qty
        FROM recommended GROUP BY parent_sku"""),
    "agg_single_baby": Entry(q_agg_single_baby, """
        SELECT parent_sku, count(DISTINCT baby_sku) = 1 AS single_baby FROM recommended GROUP BY parent_sku"""),
    # set operation
    "set_union_zero_fill": Entry(_st("warehouse_position"), "SELECT * FROM warehouse_position"),
    # composite operators
    "expand_request": Entry(_st("expanded"), "SELECT * FROM isku"),
    "warehouse_position": Entry(_st("warehouse_position"), "SELECT * FROM warehouse_position"),
    "store_position": Entry(_st("store_position"), "SELECT * FROM store_position"),
    "store_period_forecast": Entry(_st("store_forecast"), "SELECT * FROM spf"),
    "store_replenishment": Entry(_st("store_need"), "SELECT * FROM need"),
    "warehouse_replenishment": Entry(_st("warehouse_need"), "SELECT * FROM wneed"),
    "projected_on_hand": Entry(_st("projection"), "SELECT * FROM projection"),
    "recommended_quantity": Entry(_st("recommended"), "SELECT * FROM recommended"),
    "pack_conversion": Entry(_st("packed"), "SELECT * FROM packed"),
    "recommend_orders": Entry(_st("recommendations"), "SELECT * FROM recommendations"),
    "missing_skus": Entry(_st("missing_skus"), "SELECT * FROM missing_skus"),
    # the flagship on SKUs that are zero-padded text
    "recommend_orders_text_keys": Entry(q_recommend_orders_text_keys, "SELECT * FROM recommendations"),
    # the flagship with every reference behaviour switched to its fix
    "recommend_orders_fixed": Entry(q_recommend_orders_fixed, "SELECT * FROM recommendations"),
}

QUIRKS = {"recommend_orders_fixed": FIXED}
TEXT_KEYS = {"recommend_orders_text_keys"}


def queries() -> dict[str, Query]:
    return {k: e.query for k, e in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        k: oracle.with_ctes(e.sql, QUIRKS.get(k), text_keys=k in TEXT_KEYS) for k, e in ENTRIES.items() if e.sql is not None
    }
