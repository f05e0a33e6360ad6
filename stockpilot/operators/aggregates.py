"""Keyed aggregates (AGG-1..5, AGG-10).

Every aggregate here is combinable: Spark computes a partial result on the map
side before the shuffle, so a key that holds a large share of the rows arrives
at its reducer already reduced.  No aggregate gathers a group's rows into a
list or set.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, cols: Sequence[str], drop_null: bool = True) -> DataFrame:
    """AGG-1: distinct key tuples."""
    out = df.select(*cols)
    if drop_null:
        out = out.dropna(subset=list(cols))
    return out.distinct()


def store_counts(inventory: DataFrame) -> DataFrame:
    """AGG-2: distinct selling stores per warehouse over the whole extract.

    Planned as group by (warehouse, store) then count, both with map-side
    combine; warehouses are few, so no step may gather one warehouse's rows.
    """
    return inventory.groupBy("input_source_store").agg(F.count_distinct("store").alias("num_of_store"))


def with_store_count(inventory: DataFrame, counts: DataFrame) -> DataFrame:
    """AGG-2 joined back (JN-7).

    The count table has one row per warehouse.  Written out, its size is known
    to the planner, which broadcasts it while it is small."""
    return inventory.join(counts, "input_source_store", "left")


def first_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """AGG-3: one row per key; rows with a NULL key drop out.

    The reference takes the first non-NULL value in file order, which is not
    deterministic when a value varies within a key.  Here it is the smallest
    non-NULL value, the same whenever the value is constant per key.
    """
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.min(v).alias(v) for v in values])
    )


def distinct_positions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-4: collapse rows to one per position; NULL keys drop out.  A view of this
    single step: the job's ``per_position`` aggregate does it with the sums."""
    return df.select(*cols).dropna(subset=list(cols)).distinct()


def drop_daily(df: DataFrame, daily: Sequence[str] = ("cal_date", "forecast")) -> DataFrame:
    """AGG-5: distinct rows once the daily columns are removed.  A view of this
    single step: the job never makes the daily rows (see ``forecast``)."""
    return df.drop(*daily).distinct()


def max_coverage(rows: DataFrame) -> DataFrame:
    """AGG-10: the largest coverage date as a one-row frame (never collected)."""
    return rows.agg(F.max("coverage_date").alias("max_coverage_date"))


def first_day_needed(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """The first day that falls in any period, as a one-row frame."""
    return rows.agg(F.least(F.lit(as_of), F.min("received_date")).alias("first_day"))
