"""Expanding the request to SKUs (CMP-1) and the missing-SKU report (CMP-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.functions import to_day
from stockpilot.operators.joins import without
from stockpilot.operators.projection import with_request_id

EXPANDED_COLUMNS = ("style", "color", "sku", "item_id", "provided_date", "coverage_day")


class RepeatedRequestError(RuntimeError):
    """A requested SKU comes up more than once; the run must stop."""


def request_days(request: DataFrame) -> DataFrame:
    return request.select("style", "color", to_day("provided_date").alias("provided_date"), "coverage_day")


def matched_skus(catalog: DataFrame, request: DataFrame) -> DataFrame:
    """SRC-2 with the request's columns: catalog rows of the requested pairs."""
    return catalog.join(request_days(request), ["style", "color"], "inner").select(*EXPANDED_COLUMNS)


def assert_no_repeats(expanded: DataFrame) -> None:
    """Stop the run when a SKU comes from two request rows: its open orders and
    forecasts would count twice.  Reads one pair back to the driver."""
    repeated = (
        expanded.where(F.col("sku").isNotNull())
        .groupBy("sku")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("style", "color")).alias("pair"))
        .where("n > 1")
        .limit(1)
        .collect()
    )
    if repeated:
        pair = repeated[0]["pair"]
        raise RepeatedRequestError(f"the request asks for style {pair['style']!r}, color {pair['color']!r} more than once")


def expand_request(catalog: DataFrame, request: DataFrame, matched: DataFrame | None = None) -> DataFrame:
    """CMP-1: every catalog SKU of each requested (style, color), with the
    request's provided date and coverage days; a pair the catalog lacks keeps
    one row with a NULL ``sku``.

    The reference fetches the matching catalog rows, then full-outer-joins them
    with the request.  As every fetched row matches, that equals the inner join
    plus the unmatched request rows; both parts are joins adaptive execution can
    split when one (style, color) holds a large share of the catalog.  With the
    ``matched`` rows written out before, the catalog is read once.
    """
    if matched is None:
        matched = matched_skus(catalog, request)
    pairs = matched.select("style", "color").distinct()
    unmatched = request_days(request).join(pairs, ["style", "color"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True).select(*EXPANDED_COLUMNS)


def missing_skus(expanded: DataFrame, inventory: DataFrame, request_id: str) -> DataFrame:
    """CMP-11: requested SKUs that are no parent SKU of the on-hand extract,
    i.e. no active store carries them.  An unmatched request contributes one
    NULL ``sku``."""
    skus = expanded.select("sku").distinct()
    return with_request_id(without(skus, inventory, "sku", "parent_sku"), request_id)
