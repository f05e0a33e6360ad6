"""Store demand over the two periods (CMP-4: JN-5, FLT-3/4, AGG-8, JN-6, AGG-5).

Plan.  Store positions carry a ``weight`` (the number of times the
reference lists each).  They join the daily forecast
on (baby_sku, store), the largest join of the job; the per-position sums, the
per-(parent, baby, store) window totals and the both-periods filter all run on
that join's hash partitioning, so nothing shuffles again.  Columns that follow from the SKU are
left out of the join and looked up in the expanded request afterwards.  A (parent, baby,
store) group holds one distinct position per warehouse, so its window
partition stays small however skewed the forecast is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpilot.config import Quirks
from stockpilot.functions import first_period, second_period
from stockpilot.operators.positions import SKU_COLUMNS, STORE, with_sku_attributes
from stockpilot.session import spread

STORE_KEYS = ("parent_sku", "baby_sku", "store")
POSITION_COLUMNS = STORE.columns + (STORE.first_col, STORE.second_col)
#: What tells positions apart: all but what follows from ``parent_sku``.
OWN_COLUMNS = tuple(c for c in POSITION_COLUMNS if c not in SKU_COLUMNS)
TOTAL_COLUMNS = ("first_period_total_forecast", "second_period_total_forecast")


def weighted_positions(store_positions: DataFrame) -> DataFrame:
    """Store positions with ``weight``, the number of times the reference
    lists each.  ``positions`` emits one row per position (in-window and
    zero-filled positions are disjoint), so this is its ``copies`` column; no
    shuffle is spent re-grouping."""
    return store_positions.select(*POSITION_COLUMNS, F.col("copies").alias("weight"))


def attach_forecast(positions: DataFrame, forecast: DataFrame) -> DataFrame:
    """JN-5: positions left-joined to the forecast on baby_sku = sku and store."""
    fc = forecast.select(F.col("sku").alias("baby_sku"), "store", "cal_date", "forecast")
    return spread(positions, "baby_sku", "store").join(fc, ["baby_sku", "store"], "left")


def period_sums(joined: DataFrame, as_of: dt.date, quirks: Quirks, keys: tuple[str, ...]) -> DataFrame:
    """Per row of ``keys``: forecast sum and row count in each period."""
    p1 = first_period("cal_date", as_of, "received_date")
    p2 = second_period("cal_date", "received_date", "coverage_date", quirks.include_received_day)
    return joined.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(p1, F.col("forecast"))), F.lit(0.0)).alias("first_sum"),
        F.count(F.when(p1, F.lit(1))).alias("first_rows"),
        F.coalesce(F.sum(F.when(p2, F.col("forecast"))), F.lit(0.0)).alias("second_sum"),
        F.count(F.when(p2, F.lit(1))).alias("second_rows"),
    )


def period_totals(positions: DataFrame, forecast: DataFrame, as_of: dt.date, quirks: Quirks) -> DataFrame:
    """AGG-8: forecast per (parent, baby, store) in each period, summed over
    every listed position row (weights included), with the rows behind each
    total.  A view of this single step: the job takes the same totals in a window
    over ``period_sums``."""
    sums = period_sums(attach_forecast(weighted_positions(positions), forecast), as_of, quirks, POSITION_COLUMNS + ("weight",))
    w = F.col("weight")
    return sums.groupBy(*STORE_KEYS).agg(
        F.sum(w * F.col("first_sum")).alias("first_period_total_forecast"),
        F.sum("first_rows").alias("first_period_rows"),
        F.sum(w * F.col("second_sum")).alias("second_period_total_forecast"),
        F.sum("second_rows").alias("second_period_rows"),
    )


def store_period_forecast(positions: DataFrame, forecast: DataFrame, expanded: DataFrame, as_of: dt.date, quirks: Quirks) -> DataFrame:
    """CMP-4: each distinct store position with its two period totals.

    A (parent, baby, store) without forecast rows in either period drops out
    (JN-6) unless ``quirks.require_both_periods`` is off, which gives the
    empty period a zero total.
    """
    own = weighted_positions(positions).drop(*SKU_COLUMNS)
    sums = period_sums(attach_forecast(own, forecast), as_of, quirks, OWN_COLUMNS + ("weight",))
    group = Window.partitionBy(*STORE_KEYS)
    w = F.col("weight")
    out = sums.select(
        *OWN_COLUMNS,
        F.sum(w * F.col("first_sum")).over(group).alias("first_period_total_forecast"),
        F.sum(w * F.col("second_sum")).over(group).alias("second_period_total_forecast"),
        F.sum("first_rows").over(group).alias("first_period_rows"),
        F.sum("second_rows").over(group).alias("second_period_rows"),
    )
    if quirks.require_both_periods:
        out = out.where((F.col("first_period_rows") > 0) & (F.col("second_period_rows") > 0))
    return with_sku_attributes(out, expanded).select(*POSITION_COLUMNS, *TOTAL_COLUMNS)
