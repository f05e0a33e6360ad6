"""The job's six input tables, derived from the TPC-H-style test tables.

The reference ships no data.  These definitions (see FIXTURES.md section 3) use
integer arithmetic only, so the DuckDB oracle in ``stockpilot.oracle`` derives
the same rows.  Every view reads whole tables and grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpilot import schemas
from stockpilot.session import spread

# Fixed values of the fixture definition.
AS_OF = dt.date(1998, 6, 1)
EPOCH = dt.date(1995, 1, 1)
REQUEST_DAY = dt.date(1998, 6, 15)
UNMATCHED_REQUEST = ("no such style", "Brand#0", "1998-06-15", 28)
FORECAST_WEEKS = 18
PROMO_TYPE = "PROMO"
REQUEST_ID = "fixture_run"
# Order lines of every RESENT-th part appear twice in the order feeds, as an
# extract that overlaps the one before would hold them.
RESENT = 40
# Orders of every LATE-th part (from LATE_FROM on) arrive LATE_DAYS later, past any
# coverage date: their warehouse positions have no order in any window.
LATE, LATE_FROM, LATE_DAYS = 20, 7, 400


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def request_view(spark: SparkSession, part: DataFrame) -> DataFrame:
    """One request row per (name, brand) of parts with size <= 10, plus one row
    no catalog entry matches."""
    k = F.col("k")
    derived = (
        part.where(F.col("p_size") <= 10)
        .groupBy(F.col("p_name").alias("style"), F.col("p_brand").alias("color"))
        .agg(F.min("p_partkey").alias("k"))
        .select(
            "style",
            "color",
            F.date_format(F.date_add(F.lit(REQUEST_DAY), (7 * (k % 3)).cast("int")), "yyyy-MM-dd").alias("provided_date"),
            (28 + 7 * (k % 4)).cast("int").alias("coverage_day"),
        )
    )
    unmatched = spark.createDataFrame([UNMATCHED_REQUEST], schemas.REQUEST)
    return derived.unionByName(unmatched)


def catalog_view(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_name").alias("style"),
        F.col("p_brand").alias("color"),
        F.col("p_partkey").alias("sku"),
        (F.col("p_partkey") * 10).alias("item_id"),
    )


def inventory_view(part: DataFrame, nation: DataFrame) -> DataFrame:
    """part x nation x j, kept where (partkey + nationkey) % 4 = 0.

    The modulus condition is an equi-join on the residue class, so no part row
    meets every nation; nation is read from a file whose size the planner sees.
    The parts are spread first: a file of parts with one row group is read by one task,
    which would make, and write or group, all on-hand rows.
    """
    parts = part.where(F.col("p_partkey") % 10 != 0).select(
        "p_partkey",
        "p_size",
        (F.col("p_type") == PROMO_TYPE).alias("promo"),
        ((4 - F.col("p_partkey") % 4) % 4).cast("int").alias("residue"),
    )
    p = (
        spread(parts, "p_partkey")
        .withColumn("j", F.explode(F.when(F.col("promo"), F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))))
    )
    n = nation.select("n_nationkey", "n_regionkey", (F.col("n_nationkey") % 4).cast("int").alias("residue"))
    k, r, s, j = F.col("p_partkey"), F.col("n_regionkey"), F.col("n_nationkey"), F.col("j")
    promo = F.col("promo")
    rows = p.join(n, "residue").select(
        r.alias("input_source_store"),
        s.alias("store"),
        k.alias("parent_sku"),
        F.when(promo, 1000000 + k * 10 + j).otherwise(k).alias("baby_sku"),
        ((k * 7 + r * 13) % 50).alias("parent_oh"),
        ((k * 3 + j * 11 + r * 5) % 40).alias("baby_oh"),
        ((k + s * 3 + j) % 20).alias("store_oh"),
        F.when(promo, F.lit(12)).otherwise(1 + F.col("p_size") % 3).alias("ppk_qty"),
        (7 + 2 * r).alias("lt_days"),
        (5 + k % 11).alias("sks_ord_level"),
    )
    return schemas.conform(rows, schemas.INVENTORY)


def order_lines(lineitem: DataFrame, orders: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Line items with their order date and the supplier's nation/region.  Units, transit
    date and flag are made before the join with the orders: they are narrower than what
    they come from.  The lines are spread: what follows sorts and groups them in one task."""
    rf = F.col("l_returnflag")
    li = lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("ord_units"),
        F.when(F.col("l_linestatus") == "F", (F.col("l_quantity") / 2).cast("int")).otherwise(F.lit(0)).alias("rcvd_units"),
        F.when(rf == "N", F.lit(None).cast("date")).otherwise(_shifted("l_shipdate")).alias("transit_date"),
        F.when(rf == "A", F.lit("Y")).when(rf == "R", F.lit("")).when(rf == "N", F.lit("N")).alias("promo_fl"),
    )
    o = orders.select("o_orderkey", "o_orderdate")
    s = supplier.select("s_suppkey", "s_nationkey")
    n = nation.select("n_nationkey", "n_regionkey")
    return (
        spread(li, "l_orderkey")
        .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    )


def _shifted(day_col: str) -> F.Column:
    days = F.datediff(F.to_date(F.col(day_col)), F.lit(EPOCH))
    late = F.when(F.col("l_partkey") % LATE == LATE_FROM, LATE_DAYS).otherwise(0)
    return F.date_add(F.lit(AS_OF), days % 120 - 30 + late)


def order_feed(lines: DataFrame, odd: int, location_col: str) -> DataFrame:
    """Even line numbers are warehouse orders, odd ones store orders."""
    rows = lines.where(F.col("l_linenumber") % 2 == odd).select(
        F.col("l_partkey").alias("sku"),
        F.col(location_col).alias("store"),
        "ord_units",
        "rcvd_units",
        _shifted("o_orderdate").alias("first_ship_date"),
        "transit_date",
        "promo_fl",
    )
    times = F.when(F.col("sku") % RESENT == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return schemas.conform(rows.withColumn("sent", F.explode(times)), schemas.ORDERS)


def forecast_view(inventory: DataFrame, sku: str = "baby_sku") -> DataFrame:
    """Weekly forecast for every stocked (baby, store), with some weeks left out; the column
    ``sku`` becomes its SKU.  Dealt by that, the rows stay where they are in the extract's
    semi join when that is no broadcast join."""
    k = F.col("k")
    key_sum = F.col("baby_sku") + F.col("store")
    omitted = ((key_sum % 13 == 0) & (k < 5)) | ((key_sum % 17 == 0) & (k >= 3))
    rows = (
        spread(inventory.select(*dict.fromkeys((sku, "baby_sku", "store"))), sku)
        .distinct()
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(FORECAST_WEEKS - 1))))
        .where(~omitted)
        .select(
            F.col(sku).alias("sku"),
            "store",
            F.date_add(F.lit(AS_OF), 7 * k).alias("cal_date"),
            ((F.col("baby_sku") + F.col("store") * 3 + k) % 9).cast("double") * F.lit(2.5),
        )
        .toDF("sku", "store", "cal_date", "forecast")
    )
    return schemas.conform(rows, schemas.FORECAST)


@dataclass(frozen=True)
class FixtureTables:
    request: DataFrame
    catalog: DataFrame
    inventory: DataFrame
    # The flows read the feeds without their repeated rows.
    warehouse_orders: DataFrame
    store_orders: DataFrame
    forecast: DataFrame
    warehouse_feed: DataFrame
    store_feed: DataFrame


def slashed_request(request: DataFrame) -> DataFrame:
    """The request as a buyer's spreadsheet may write it."""
    day = F.to_date("provided_date")
    return request.select(
        F.concat("style", F.lit(' 5" "POT"')).alias("style"),
        F.when(F.col("coverage_day") == 28, F.lit("N/A")).otherwise(F.col("color")).alias("color"),
        F.date_format(day, "M/d/yyyy").alias("provided_date"),
        F.when(F.col("coverage_day") == 35, F.lit("NaN")).otherwise(F.col("coverage_day").cast("string")).alias("coverage_day"),
    )


def text_key_tables(ft: FixtureTables) -> FixtureTables:
    """The same tables with SKUs as zero-padded text."""

    def text(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumns({k: F.lpad(F.col(k).cast("string"), 12, "0") for k in keys})

    return FixtureTables(
        ft.request,
        text(ft.catalog, "sku"),
        text(ft.inventory, "parent_sku", "baby_sku"),
        text(ft.warehouse_orders, "sku"),
        text(ft.store_orders, "sku"),
        # Made from text and not turned into it: it is dealt by what the joins compare.
        forecast_view(text(ft.inventory.withColumn("sku", F.col("baby_sku")), "sku"), "sku"),
        text(ft.warehouse_feed, "sku"),
        text(ft.store_feed, "sku"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    def t(name: str) -> DataFrame:
        return read_table(spark, sf_dir, name)

    part, nation = t("part"), t("nation")
    lines = order_lines(t("lineitem"), t("orders"), t("supplier"), nation)
    inventory = inventory_view(part, nation)
    warehouse_feed, store_feed = order_feed(lines, 0, "n_regionkey"), order_feed(lines, 1, "n_nationkey")
    return FixtureTables(
        request=request_view(spark, part),
        catalog=catalog_view(part),
        inventory=inventory,
        warehouse_orders=warehouse_feed.distinct(),
        store_orders=store_feed.distinct(),
        forecast=forecast_view(inventory),
        warehouse_feed=warehouse_feed,
        store_feed=store_feed,
    )
