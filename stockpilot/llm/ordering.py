"""Ranks of rows in a given order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpilot.llm.text import staged

PART_BITS = 33  # monotonically_increasing_id: partition number above, place below


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``rank`` (from 0) within their group and ``total``, the rows of
    the group.  ``group`` is a column without nulls.

    One range partitioning by group and order spreads the rows of a group over as
    many partitions as they fill; the position of a row is its place in the
    partition plus the number of rows in the partitions before it."""
    in_order = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = staged(in_order.withColumn("place", F.monotonically_increasing_id()), "order")
    part, within = F.shiftright("place", PART_BITS), F.col("place").bitwiseAND((1 << PART_BITS) - 1)
    # One row for each partition.
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n_part").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.withColumn("part", part).join(before, "part").withColumn("at", F.col("before") + within)
    groups = numbered.groupBy(group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("total"))
    return numbered.join(groups, group).withColumn("rank", F.col("at") - F.col("first")).drop("place", "part", "before", "at", "first")
