"""Store need, warehouse roll-ups, projected stock and the recommended
quantity (CMP-5..8, AGG-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.functions import clamp0, replen_flag, round_even
from stockpilot.functions.expressions import YES
from stockpilot.operators.aggregates import first_per_key
from stockpilot.operators.joins import enrich
from stockpilot.session import spread

WAREHOUSE_ITEM = ("parent_sku", "baby_sku", "input_source_store")
PROJECTION_KEYS = ("parent_sku", "baby_sku", "ppk_qty", "input_source_store", "num_of_store", "coverage_date")


def store_replenishment(store_forecast: DataFrame) -> DataFrame:
    """CMP-5: expected demand = first-period forecast rounded half to even;
    flag 'Y' when ``store_oh - expected < sks_ord_level``; need =
    ``level - (store_oh + first_period_store_oo - expected)`` when flagged,
    else 0, never below 0."""
    expected = F.col("expected_demand")
    need = F.when(
        F.col("replenishment_order") == YES,
        F.col("sks_ord_level") - (F.col("store_oh") + F.col("first_period_store_oo") - expected),
    ).otherwise(F.lit(0.0))
    return (
        store_forecast.withColumn("expected_demand", round_even("first_period_total_forecast"))
        .withColumn("replenishment_order", replen_flag("store_oh", "expected_demand", "sks_ord_level"))
        .withColumn("replenishment_order_qty", clamp0(need))
    )


def warehouse_replenishment(need: DataFrame) -> DataFrame:
    """CMP-6: one need per (parent, baby, warehouse, store), summed over the
    warehouse's stores."""
    per_store = first_per_key(need, WAREHOUSE_ITEM + ("store",), ("replenishment_order_qty",))
    return per_store.groupBy(*WAREHOUSE_ITEM).agg(
        F.sum("replenishment_order_qty").alias("total_replenishment_order_qty")
    )


def projected_rows(warehouse_positions: DataFrame, replenishment: DataFrame) -> DataFrame:
    """PRJ-8 + PRJ-9 per listed warehouse row: store need attached (0 when
    none) and ``projected_warehouse_oh = max(0, baby_oh + first-period
    on-order - need)``.  The positions are spread: the sums, joins and groupings by
    warehouse item that follow run in the same tasks."""
    df = enrich(spread(warehouse_positions, *WAREHOUSE_ITEM), replenishment, WAREHOUSE_ITEM, fill={"total_replenishment_order_qty": 0.0})
    projected = clamp0(F.col("baby_oh") + F.col("first_period_short_term_oo") - F.col("total_replenishment_order_qty"))
    return df.withColumn("projected_warehouse_oh", projected)


def projected_on_hand(warehouse_positions: DataFrame, replenishment: DataFrame) -> DataFrame:
    """CMP-7: projected on-hand and second-period on-order summed by
    projection key, each row counted as often as the reference lists it
    (``copies``)."""
    copies = F.col("copies")
    return (
        projected_rows(warehouse_positions, replenishment)
        .dropna(subset=list(PROJECTION_KEYS))
        .groupBy(*PROJECTION_KEYS)
        .agg(
            F.sum(F.col("second_period_short_term_oo") * copies).alias("total_second_period_short_term_oo"),
            F.sum(F.col("projected_warehouse_oh") * copies).alias("total_projected_warehouse_oh"),
        )
    )


def warehouse_forecast(store_forecast: DataFrame) -> DataFrame:
    """AGG-9: second-period store on-order and (unrounded) second-period
    forecast summed to the warehouse."""
    return store_forecast.groupBy(*WAREHOUSE_ITEM).agg(
        F.sum("second_period_store_oo").alias("second_period_store_oo"),
        F.sum("second_period_total_forecast").alias("second_period_total_forecast"),
    )


def recommended_quantity(projection: DataFrame, store_forecast: DataFrame) -> DataFrame:
    """CMP-8: ``max(0, (f2 - store_oo2) - (warehouse_oo2 + projected_oh))``;
    a warehouse item with no store forecast gets 0."""
    df = enrich(projection, warehouse_forecast(store_forecast), WAREHOUSE_ITEM)
    q = (F.col("second_period_total_forecast") - F.col("second_period_store_oo")) - (
        F.col("total_second_period_short_term_oo") + F.col("total_projected_warehouse_oh")
    )
    return df.withColumn("recomended_order_qty", clamp0(q))
