"""Reading the request and extracting the rows the job needs (SRC-1..7).

The reference pastes key lists into SQL text and stages each result through
parquet into one Python process.  Here each extract is a semi join against a
one-column key frame, so the keys never pass through the driver and Catalyst
can push the filter down (runtime bloom filters, dynamic pruning).  For a JDBC
source, which a semi join is not pushed into, pass ``spark.read.jdbc`` a
subquery instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpilot import schemas


# The texts that the reference's CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)


def read_request(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: the buyer's CSV, every column read as text and picked by header
    name; a quote inside a quoted value is doubled, usual spellings of a missing
    value are NULL, ``coverage_day`` becomes an int (a bad value is an error) and
    ``first_ship_date`` is renamed ``provided_date``."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path)
    missing = [c for c in schemas.REQUEST_CSV.fieldNames() if c not in raw.columns]
    if missing:
        raise ValueError(f"request file lacks columns {missing}")

    def value(c: str) -> Column:
        return F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c))

    return raw.select(
        value("style").alias("style"),
        value("color").alias("color"),
        value("first_ship_date").alias("provided_date"),
        value("coverage_day").cast("int").alias("coverage_day"),
    )


def write_request_csv(request: DataFrame, path: str) -> str:
    """Write a request frame in the buyer's CSV layout."""
    (
        request.select(
            "style",
            "color",
            F.col("provided_date").alias("first_ship_date"),
            F.col("coverage_day").cast("string").alias("coverage_day"),
        )
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return path


def lookup_skus(catalog: DataFrame, request: DataFrame) -> DataFrame:
    """SRC-2: catalog rows whose (style, color) is one of the requested pairs.  A
    view of this single step: the job takes it together with the request's columns
    in ``request.matched_skus``."""
    return catalog.join(request.select("style", "color"), ["style", "color"], "left_semi")


def sku_keys(expanded: DataFrame) -> DataFrame:
    """The non-null requested SKUs as a one-column frame for the semi joins
    below.  A semi join ignores repeated keys, so no distinct (and no shuffle)
    is spent on them."""
    return expanded.select("sku").where(F.col("sku").isNotNull())


def extract_warehouse_orders(orders: DataFrame, skus: DataFrame) -> DataFrame:
    """SRC-3: warehouse orders for the requested SKUs; ``store`` is the
    warehouse and is renamed ``input_source_store``."""
    return orders.join(skus, "sku", "left_semi").withColumnRenamed("store", "input_source_store")


def extract_store_orders(orders: DataFrame, skus: DataFrame) -> DataFrame:
    """SRC-4: selling-store orders for the requested SKUs."""
    return orders.join(skus, "sku", "left_semi")


def extract_inventory(inventory: DataFrame, skus: DataFrame) -> DataFrame:
    """SRC-5: on-hand rows of the requested parent SKUs, without ``lead_time``."""
    keys = skus.select(F.col("sku").alias("parent_sku"))
    return inventory.join(keys, "parent_sku", "left_semi").drop("lead_time")


def extract_forecast(forecast: DataFrame, babies: DataFrame, first_day: DataFrame, max_coverage: DataFrame) -> DataFrame:
    """SRC-6: forecast of the stocked baby SKUs, from the first day that any
    period can count to the largest coverage date.

    Both bounds are one-row, one-column frames; they enter as scalar subqueries,
    evaluated once and pushed to the scan as runtime filters.
    """
    keys = babies.select(F.col("baby_sku").alias("sku"))
    day = F.col("cal_date")
    return forecast.join(keys, "sku", "left_semi").where((day >= first_day.scalar()) & (day <= max_coverage.scalar()))


def stage(df: DataFrame, path: str) -> DataFrame:
    """SRC-7: materialise to parquet (overwrite) and read back: it cuts lineage at a
    point that must survive executor loss."""
    df.write.mode("overwrite").parquet(path)
    # The declared schema keeps an empty result readable.
    return df.sparkSession.read.schema(df.schema).parquet(path)
