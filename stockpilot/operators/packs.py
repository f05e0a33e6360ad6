"""Units to parent packs (CMP-9: AGG-11, AGG-12, PRJ-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.config import Quirks
from stockpilot.functions import round_even


def pack_scope(quirks: Quirks) -> tuple[str, ...]:
    return ("parent_sku",) if quirks.pack_max_scope == "parent" else ("parent_sku", "input_source_store")


def pack_stats(rec: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """AGG-11 and AGG-12 in one aggregate: largest quantity and pack size, and
    whether there is exactly one distinct baby SKU (min == max over the non-NULL
    ones: combinable, with no set to grow)."""
    return rec.groupBy(*scope).agg(
        (F.min("baby_sku") == F.max("baby_sku")).alias("single_baby"),
        F.max("recomended_order_qty").alias("max_order_qty"),
        F.max("ppk_qty").alias("max_ppk_qty"),
    )


def pack_conversion(rec: DataFrame, quirks: Quirks) -> DataFrame:
    """CMP-9: a parent with one baby SKU orders ``round(q / ppk_qty)`` packs;
    otherwise every baby row of the parent gets ``round(max q / max ppk_qty)``
    over the parent's rows.  Rounding is half to even; a zero pack size gives
    NULL.  The per-parent figures are one combinable aggregate joined back."""
    scope = list(pack_scope(quirks))
    stats = pack_stats(rec, tuple(scope))
    own = round_even(F.try_divide(F.col("recomended_order_qty"), F.col("ppk_qty")))
    shared = round_even(F.try_divide(F.col("max_order_qty"), F.col("max_ppk_qty")))
    units = F.when(F.coalesce(F.col("single_baby"), F.lit(False)), own).otherwise(shared)
    return rec.join(stats, scope, "inner").withColumn("recomended_order_units", units.cast("bigint"))
