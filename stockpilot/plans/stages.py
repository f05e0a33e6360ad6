"""The whole job (CMP-10 recommendations, CMP-11 missing SKUs).

``Stages`` names every intermediate result so queries, tests and the runner
can pick any of them.  The reused intermediates listed in ``STAGED`` are
written to the shared folder as they are first used (see
``plans.materialize``); everything between two boundaries is one lazy plan,
inside which Spark reuses shared shuffle output (``ReusedExchange``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.config import RunConfig
from stockpilot.operators import aggregates, forecast, packs, positions, projection, replenishment, request
from stockpilot.plans.materialize import materialize
from stockpilot.session import discard
from stockpilot.sources import extracts

# Stages written to the shared folder by default.
# The expanded request is small (one buyer's styles); written out, its size is
# visible to the planner, so the semi joins that cut the large order and
# on-hand tables down to the requested SKUs are broadcast joins and those
# tables are filtered where they are read, not shuffled.  The three extracts are
# what is left of the large tables: each of these is read once, and the checks
# and both branches read the extract.  Where the request is too large to be
# broadcast, nothing but the write follows the extract's semi join, so adaptive
# execution may split a SKU that holds a large share of the orders; reduced by
# ``order_buckets`` it then leaves each task as a row per location and day.
STAGED = frozenset({
    "matched", "expanded", "warehouse-orders", "store-orders", "inventory", "store-counts", "warehouse-per-position",
    "store-per-position", "store-forecast", "recommended",
})


@dataclass(frozen=True)
class Inputs:
    request: DataFrame
    catalog: DataFrame
    inventory: DataFrame
    warehouse_orders: DataFrame
    store_orders: DataFrame
    forecast: DataFrame


class Stages:
    """Every stage of one run, built on first use.

    With ``materialize`` (the default) the reused intermediates are written to
    the shared folder once and read back (see ``plans.materialize``); that
    runs one job per boundary as the stage is first used.  Without it the
    whole run stays one lazy plan.
    """

    def __init__(self, inputs: Inputs, cfg: RunConfig, materialize: bool | frozenset[str] = True) -> None:
        self.inputs = inputs
        self.cfg = cfg
        self.quirks = cfg.quirks
        if materialize is True:
            materialize = STAGED
        self.staged = frozenset(materialize or ())
        self.written: list[str] = []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.written) if name in self.staged else df

    def close(self) -> None:
        """Remove the staged folders; no stage may be read any more."""
        while self.written:
            discard(self.inputs.request.sparkSession, self.written.pop())

    # -- extracts ----------------------------------------------------------
    @cached_property
    def expanded(self) -> DataFrame:
        matched = self._keep(request.matched_skus(self.inputs.catalog, self.inputs.request), "matched")
        expanded = self._keep(request.expand_request(self.inputs.catalog, self.inputs.request, matched), "expanded")
        request.assert_no_repeats(expanded)
        return expanded

    @cached_property
    def skus(self) -> DataFrame:
        return extracts.sku_keys(self.expanded)

    @cached_property
    def warehouse_orders(self) -> DataFrame:
        return self._keep(extracts.extract_warehouse_orders(self.inputs.warehouse_orders, self.skus), "warehouse-orders")

    @cached_property
    def store_orders(self) -> DataFrame:
        return self._keep(extracts.extract_store_orders(self.inputs.store_orders, self.skus), "store-orders")

    @cached_property
    def inventory_extract(self) -> DataFrame:
        return self._keep(extracts.extract_inventory(self.inputs.inventory, self.skus), "inventory")

    @cached_property
    def inventory(self) -> DataFrame:
        extract = self.inventory_extract
        return aggregates.with_store_count(extract, self._keep(aggregates.store_counts(extract), "store-counts"))

    def _together(self, *names: str) -> None:
        """Write independent extracts at the same time: Spark runs jobs submitted
        from several threads side by side."""
        if not self.staged:
            return
        _ = self.expanded, self.skus  # what all of them read
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            for done in [pool.submit(getattr, self, name) for name in names]:
                done.result()

    def extract_all(self) -> None:
        self._together("inventory", "warehouse_orders", "store_orders")

    # -- positions ---------------------------------------------------------
    @cached_property
    def warehouse_onhand(self) -> DataFrame:
        return positions.warehouse_onhand(self.inventory)

    @cached_property
    def warehouse_rows(self) -> DataFrame:
        self._together("inventory", "warehouse_orders")
        return positions.position_rows(self.warehouse_onhand, self.warehouse_orders, self.expanded, positions.WAREHOUSE, self.quirks)

    @cached_property
    def warehouse_per_position(self) -> DataFrame:
        return self._keep(positions.per_position(self.warehouse_rows, self.expanded, positions.WAREHOUSE), "warehouse-per-position")

    @cached_property
    def warehouse_position(self) -> DataFrame:
        return positions.positions(self.warehouse_per_position, positions.WAREHOUSE, self.quirks)

    @cached_property
    def store_rows(self) -> DataFrame:
        self._together("inventory", "store_orders")
        onhand = positions.counted_onhand(self.inventory, positions.STORE)
        return positions.position_rows(onhand, self.store_orders, self.expanded, positions.STORE, self.quirks)

    @cached_property
    def store_per_position(self) -> DataFrame:
        return self._keep(positions.per_position(self.store_rows, self.expanded, positions.STORE), "store-per-position")

    @cached_property
    def store_position(self) -> DataFrame:
        return positions.positions(self.store_per_position, positions.STORE, self.quirks)

    # -- forecast ----------------------------------------------------------
    @cached_property
    def max_coverage(self) -> DataFrame:
        # Every store row is behind some position, so the per-position frame
        # has the same largest coverage date.
        return aggregates.max_coverage(self.store_per_position)

    @cached_property
    def forecast(self) -> DataFrame:
        # Every on-hand row of a requested SKU is behind one store position,
        # so the positions hold exactly the on-hand extract's baby SKUs; read
        # from the written positions, the key set has a known size.
        babies = aggregates.distinct_keys(self.store_per_position, ["baby_sku"])
        first_day = aggregates.first_day_needed(self.store_per_position, self.cfg.as_of)
        return extracts.extract_forecast(self.inputs.forecast, babies, first_day, self.max_coverage)

    @cached_property
    def store_forecast(self) -> DataFrame:
        spf = forecast.store_period_forecast(self.store_position, self.forecast, self.expanded, self.cfg.as_of, self.quirks)
        return self._keep(spf, "store-forecast")

    # -- replenishment -----------------------------------------------------
    @cached_property
    def store_need(self) -> DataFrame:
        return replenishment.store_replenishment(self.store_forecast)

    @cached_property
    def warehouse_need(self) -> DataFrame:
        return replenishment.warehouse_replenishment(self.store_need)

    @cached_property
    def projection(self) -> DataFrame:
        return replenishment.projected_on_hand(self.warehouse_position, self.warehouse_need)

    def prepare(self) -> None:
        """Write the staged intermediates: the three extracts at the same time, then
        the two independent branches (warehouse positions, and store positions then
        store forecast), which share the executors instead of queueing."""
        if not self.staged:
            return
        self.extract_all()
        with ThreadPoolExecutor(max_workers=2) as pool:
            branches = [pool.submit(lambda: self.warehouse_per_position), pool.submit(lambda: self.store_forecast)]
            for b in branches:
                b.result()

    @cached_property
    def recommended(self) -> DataFrame:
        self.prepare()
        rec = replenishment.recommended_quantity(self.projection, self.store_forecast)
        return self._keep(rec, "recommended")

    @cached_property
    def packed(self) -> DataFrame:
        return packs.pack_conversion(self.recommended, self.quirks)

    # -- outputs -----------------------------------------------------------
    @cached_property
    def recommendations(self) -> DataFrame:
        columns = self.packed.select(
            "input_source_store",
            "parent_sku",
            "baby_sku",
            "recomended_order_units",
            "num_of_store",
            F.col("coverage_date").alias("next_ship_date"),
        )
        return projection.with_request_id(columns, self.cfg.request_id)

    @cached_property
    def missing_skus(self) -> DataFrame:
        # Only the extract's parent SKUs matter here, not the store counts.
        return request.missing_skus(self.expanded, self.inventory_extract, self.cfg.request_id)


def recommend_orders(inputs: Inputs, cfg: RunConfig, materialize: bool = True) -> DataFrame:
    """CMP-10: recommended order units per warehouse, parent and baby SKU."""
    return Stages(inputs, cfg, materialize).recommendations


def missing_skus(inputs: Inputs, cfg: RunConfig, materialize: bool = True) -> DataFrame:
    """CMP-11: requested SKUs no active store carries."""
    return Stages(inputs, cfg, materialize).missing_skus
