"""Open-order positions by period (CMP-2 warehouse, CMP-3 store).

One function serves both grains; a ``Grain`` names the location column that
ties orders to on-hand rows, the position columns and the window rule.

Reference semantics kept on purpose (see ``Quirks``): order totals are taken
per (sku, location) after the join that repeats each order once per on-hand
row of that SKU and location, so a parent with three babies counts each order
three times; positions of SKUs without any in-window order are zero-filled
once per matched order row.

Plan.  Orders are first reduced to one row per (sku, location, arrival base
day) with their unit sums and row count, before any join; a SKU holding a large
share of the orders is thus reduced map-side.  Store on-hand rows that agree in
every column used here are likewise reduced to one with their number
(``onhand_rows``).  The reduced orders join the on-hand rows on (parent_sku,
location), and the per-position aggregate runs on that join's hash partitioning
without another shuffle.  Columns that follow from the SKU (``SKU_COLUMNS``) are
neither shuffled nor grouped by: they are looked up in the expanded request, which
is unique by SKU, once the positions are made.  The per-(sku, location)
totals are a combinable aggregate of the (written) per-position frame with one
row per key, joined back to it; the zero-fill test needs only the in-window
SKUs' distinct keys.  Zero-filled rows carry their repeat count in ``copies``
instead of being emitted several times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.config import Quirks
from stockpilot.functions import add_days, arrival_date, in_window, pack_units, to_int, zero
from stockpilot.operators.aggregates import first_per_key
from stockpilot.operators.joins import without
from stockpilot.session import spread


@dataclass(frozen=True)
class Grain:
    name: str
    location: str
    columns: tuple[str, ...]
    first_col: str
    second_col: str
    extra_lead: bool

    @property
    def output_columns(self) -> tuple[str, ...]:
        return self.columns + (self.first_col, self.second_col, "copies")


WAREHOUSE = Grain(
    name="warehouse",
    location="input_source_store",
    columns=(
        "input_source_store", "parent_sku", "baby_sku", "parent_oh", "baby_oh", "ppk_qty", "lt_days",
        "num_of_store", "sku", "style", "color", "coverage_date",
    ),
    first_col="first_period_short_term_oo",
    second_col="second_period_short_term_oo",
    extra_lead=False,
)

STORE = Grain(
    name="store",
    location="store",
    columns=(
        "input_source_store", "parent_sku", "baby_sku", "sku", "style", "color", "store", "sks_ord_level",
        "store_oh", "ppk_qty", "provided_date", "received_date", "coverage_date", "num_of_store",
    ),
    first_col="first_period_store_oo",
    second_col="second_period_store_oo",
    extra_lead=True,
)

#: Position columns that the expanded request gives for ``parent_sku``.
SKU_COLUMNS = ("sku", "style", "color", "provided_date")

WAREHOUSE_ONHAND_KEYS = ("input_source_store", "parent_sku", "baby_sku", "parent_oh", "baby_oh")
WAREHOUSE_ONHAND_VALUES = ("ppk_qty", "lt_days", "num_of_store")


def order_buckets(orders: DataFrame, location: str) -> DataFrame:
    """Orders per (sku, location, base day): unit sums and order-row count.

    The base day is the transit date when known, else the first ship date; it
    may be NULL, and such rows still count as order rows."""
    return orders.groupBy(
        "sku", location, F.coalesce("transit_date", "first_ship_date").alias("base_date")
    ).agg(
        F.sum("ord_units").alias("ord_units"),
        F.sum("rcvd_units").alias("rcvd_units"),
        F.count(F.lit(1)).alias("order_rows"),
    )


def with_sku_attributes(onhand: DataFrame, expanded: DataFrame) -> DataFrame:
    """JN-2 + JN-4: attach style, color, item_id, provided date and coverage
    days by ``parent_sku``; ``sku = parent_sku``.  On-hand rows of SKUs that
    were not requested drop out.  ``sku`` is unique in the expanded request."""
    attrs = expanded.where(F.col("sku").isNotNull()).select(
        F.col("sku").alias("parent_sku"), "style", "color", "item_id", "provided_date", "coverage_day"
    )
    return onhand.join(attrs, "parent_sku", "inner").withColumn("sku", F.col("parent_sku"))


def with_coverage_dates(df: DataFrame) -> DataFrame:
    """PRJ-3 + PRJ-5: lead time truncated to whole days once, then
    ``received_date = provided_date + lead`` and
    ``coverage_date = received_date + coverage_day``."""
    return (
        df.withColumn("lt_days", to_int("lt_days"))
        .withColumn("received_date", add_days("provided_date", "lt_days"))
        .withColumn("coverage_date", add_days("received_date", "coverage_day"))
    )


def counted_onhand(onhand: DataFrame, grain: Grain) -> DataFrame:
    """On-hand rows that agree in every column the positions read, as one row with
    their number ``onhand_rows``.  Rows that repeat are combined where they are read: a
    SKU and location holding a third of them leaves each task as one row."""
    read = [c for c in onhand.columns if c in (*grain.columns, "lt_days")]
    return onhand.groupBy(*read).agg(F.count(F.lit(1)).alias("onhand_rows"))


def position_rows(onhand: DataFrame, orders: DataFrame, expanded: DataFrame, grain: Grain, quirks: Quirks) -> DataFrame:
    """On-hand rows x requested SKU x reduced orders, with the window flags.

    One row per (on-hand row, order base day); ``order_rows`` is NULL where
    the on-hand row has no order at all (left join).  A row without
    ``onhand_rows`` (see ``counted_onhand``) stands for itself alone."""
    if "onhand_rows" not in onhand.columns:
        onhand = onhand.withColumn("onhand_rows", F.lit(1).cast("bigint"))
    base = with_coverage_dates(with_sku_attributes(onhand, expanded)).drop(*SKU_COLUMNS, "item_id", "coverage_day")
    buckets = order_buckets(orders, grain.location).withColumnRenamed("sku", "parent_sku")
    extra = "lt_days" if (grain.extra_lead and quirks.store_extra_lead) else None
    return (
        spread(base, "parent_sku", grain.location)
        .join(buckets, ["parent_sku", grain.location], "left")
        .withColumn("calculated_date", add_days("base_date", "lt_days"))
        .withColumn("in_window", in_window("calculated_date", "coverage_date", extra))
        .withColumn("by_received", F.coalesce(F.col("calculated_date") <= F.col("received_date"), F.lit(False)))
    )


def per_position(rows: DataFrame, expanded: DataFrame, grain: Grain) -> DataFrame:
    """One row per position: whether any order is in the window, the
    in-window unit sums split at the received date, and the number of
    (on-hand x order) rows behind it."""
    win, times = F.col("in_window"), F.col("onhand_rows")
    early = win & F.col("by_received")
    late = win & ~F.col("by_received")
    sums = {
        "has_window": F.bool_or(win),
        "early_ordered": F.sum(F.when(early, F.col("ord_units") * times)),
        "early_received": F.sum(F.when(early, F.col("rcvd_units") * times)),
        "late_ordered": F.sum(F.when(late, F.col("ord_units") * times)),
        "copies": F.sum(F.coalesce(F.col("order_rows"), F.lit(1)) * times),
    }
    grouped = rows.groupBy(*[c for c in grain.columns if c not in SKU_COLUMNS]).agg(*[v.alias(c) for c, v in sums.items()])
    return with_sku_attributes(grouped, expanded).select(*grain.columns, *sums)


def open_order_totals(positions: DataFrame, grain: Grain) -> DataFrame:
    """AGG-6 / AGG-7: per (sku, location), A - B and C where A and B are the
    ordered and received units arriving by the received date and C the ordered
    units arriving after it, all within the window.  Empty sums are 0."""
    def total(c: str) -> F.Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return positions.where(F.col("has_window")).groupBy("parent_sku", grain.location).agg(
        (total("early_ordered") - total("early_received")).alias("first_period_units"),
        total("late_ordered").alias("second_period_units"),
    )


def with_zero_positions(in_window_rows: DataFrame, zero_rows: DataFrame, grain: Grain) -> DataFrame:
    """SET-1: UNION ALL by name of the in-window positions and the zero-filled
    ones."""
    cols = list(grain.output_columns)
    filled = zero_rows.withColumn(grain.first_col, zero()).withColumn(grain.second_col, zero())
    return in_window_rows.select(*cols).unionByName(filled.select(*cols))


def _valid(per_pos: DataFrame, grain: Grain) -> DataFrame:
    """Positions with an in-window order and no NULL position column."""
    return per_pos.where(F.col("has_window")).dropna(subset=list(grain.columns))


def in_window_positions(per_pos: DataFrame, grain: Grain) -> DataFrame:
    """AGG-4 + PRJ-12: positions with at least one in-window order, one row
    each, with the (sku, location) totals in units (x ``ppk_qty``).  Rows with
    a NULL position column drop out."""
    totals = open_order_totals(per_pos, grain)
    return (
        _valid(per_pos, grain)
        .join(totals, ["parent_sku", grain.location], "inner")
        .withColumn(grain.first_col, pack_units("first_period_units", "ppk_qty"))
        .withColumn(grain.second_col, pack_units("second_period_units", "ppk_qty"))
        .withColumn("copies", F.lit(1).cast("bigint"))
    )


def zero_positions(per_pos: DataFrame, grain: Grain, quirks: Quirks) -> DataFrame:
    """Positions to zero-fill: by default every position of a SKU with no
    in-window position anywhere (JN-8 on ``parent_sku``), each with the number
    of rows the reference lists for it.  Every valid in-window position has a
    totals row, so the in-window SKUs are read off the positions directly."""
    if quirks.zero_fill_grain == "sku":
        # A valid position's own SKU is among those that ``without`` drops: it need not be
        # shuffled for that.
        valid = F.coalesce(F.col("has_window"), F.lit(False))
        for c in grain.columns:
            valid &= F.col(c).isNotNull()
        rows = without(per_pos.where(~valid), _valid(per_pos, grain), "parent_sku")
    else:
        rows = per_pos.where(~F.col("has_window"))
    if quirks.dedupe_zero_fill:
        rows = rows.withColumn("copies", F.lit(1).cast("bigint"))
    return rows


def positions(per_pos: DataFrame, grain: Grain, quirks: Quirks) -> DataFrame:
    """CMP-2 / CMP-3 from ``per_position``: each position with its first- and
    second-period open orders in units, and ``copies``, the number of times
    the reference lists the row."""
    in_win = in_window_positions(per_pos, grain)
    return with_zero_positions(in_win, zero_positions(per_pos, grain, quirks), grain)


def attach_orders(onhand: DataFrame, orders: DataFrame, location: str) -> DataFrame:
    """JN-3: on-hand rows left-joined to raw order rows on
    (parent_sku = sku, location); one row per matching order.  The rows are spread: the
    join sorts them in one task.  A view of this single step: the job joins orders already
    reduced by ``order_buckets``."""
    return spread(onhand, "parent_sku", location).join(orders.withColumnRenamed("sku", "parent_sku"), ["parent_sku", location], "left")


def lookup_attributes(df: DataFrame, expanded: DataFrame) -> DataFrame:
    """JN-2: fill ``item_id``, ``style`` and ``color`` from the expanded
    request by ``parent_sku`` (NULL when not requested); ``sku = parent_sku``.  A view
    of this single step: the job takes these columns in ``with_sku_attributes``."""
    attrs = expanded.where(F.col("sku").isNotNull()).select(
        F.col("sku").alias("parent_sku"), "item_id", "style", "color"
    )
    return df.join(attrs, "parent_sku", "left").withColumn("sku", F.col("parent_sku"))


def requested_orders(onhand: DataFrame, orders: DataFrame, expanded: DataFrame, location: str) -> DataFrame:
    """JN-3 + JN-4: on-hand rows with their order rows and the columns of the requested
    SKU.  The SKU is looked up before the on-hand rows are multiplied by the orders, so the
    many joined rows are neither shuffled nor sorted again."""
    asked = with_sku_attributes(onhand, expanded)
    added = [c for c in asked.columns if c not in onhand.columns]
    rows = attach_orders(asked, orders, location)
    return rows.select(*[c for c in rows.columns if c not in added], *added)


def order_rows(onhand: DataFrame, orders: DataFrame, expanded: DataFrame, grain: Grain, quirks: Quirks) -> DataFrame:
    """Row-level form of ``position_rows``: one row per (on-hand row, order
    row) with dates, arrival date (PRJ-7) and the window flag.  Used to show
    single steps; the job itself runs on the reduced form."""
    extra = "lt_days" if (grain.extra_lead and quirks.store_extra_lead) else None
    return (
        with_coverage_dates(requested_orders(onhand, orders, expanded, grain.location))
        .withColumn("calculated_date", arrival_date("transit_date", "first_ship_date", "lt_days"))
        .withColumn("in_window", in_window("calculated_date", "coverage_date", extra))
    )


def warehouse_onhand(inventory: DataFrame) -> DataFrame:
    """AGG-3 at warehouse grain: one row per (warehouse, parent, baby,
    parent_oh, baby_oh)."""
    return first_per_key(inventory, WAREHOUSE_ONHAND_KEYS, WAREHOUSE_ONHAND_VALUES)
