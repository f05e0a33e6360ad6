"""Loading the job's inputs with their declared schemas.

Each source is a parquet folder (a name containing ``/``) or a table name;
either way the columns are checked against ``stockpilot.schemas``, keys must
have one type throughout, and a ``lead_time`` column on the on-hand snapshot is
dropped.  For a database
source, read it with ``spark.read.jdbc`` first and pass the frame to
``Inputs`` directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockpilot import schemas
from stockpilot.plans.stages import Inputs
from stockpilot.sources.extracts import read_request


def read_source(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def load_inputs(
    spark: SparkSession,
    request_csv: str,
    catalog: str,
    inventory: str,
    warehouse_orders: str,
    store_orders: str,
    forecast: str,
) -> Inputs:
    inputs = Inputs(
        request=schemas.conform(read_request(spark, request_csv), schemas.REQUEST),
        catalog=schemas.conform(read_source(spark, catalog), schemas.CATALOG),
        inventory=schemas.conform(read_source(spark, inventory).drop("lead_time"), schemas.INVENTORY),
        warehouse_orders=schemas.conform(read_source(spark, warehouse_orders), schemas.ORDERS),
        store_orders=schemas.conform(read_source(spark, store_orders), schemas.ORDERS),
        forecast=schemas.conform(read_source(spark, forecast), schemas.FORECAST),
    )
    schemas.check_keys(
        catalog=inputs.catalog,
        inventory=inputs.inventory,
        warehouse_orders=inputs.warehouse_orders,
        store_orders=inputs.store_orders,
        forecast=inputs.forecast,
    )
    return inputs
