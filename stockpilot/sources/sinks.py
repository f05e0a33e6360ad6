"""Writing the two results (SNK-1, SNK-2).

A target containing ``/`` is a parquet folder, anything else a table name.
Rows are appended by default: each run's rows carry its ``request_id`` and are
picked out by it afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockpilot import schemas


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _write(df: DataFrame, target: str, mode: str, single_file: bool, by_request: bool) -> str:
    # Only the write runs in one task, not the stage before it.
    out = df.repartition(1) if single_file else df
    if by_request:
        _replace_request(out, target)
    elif "/" in target:
        out.write.mode(mode).parquet(target)
    else:
        out.write.mode(mode).saveAsTable(target)
    return target


def _replace_request(df: DataFrame, target: str) -> None:
    """One partition per run id; only the partitions being written are replaced,
    so a re-run of a request replaces its rows and no others."""
    spark = df.sparkSession
    if "/" in target:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request_id").parquet(target)
    elif not spark.catalog.tableExists(target):
        df.write.partitionBy("request_id").saveAsTable(target)
    else:
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            # By position: the partition column is the last one, as in the table.
            df.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
        finally:
            spark.conf.set(OVERWRITE_MODE, before)


def write_recommendations(
    df: DataFrame, target: str, mode: str = "append", single_file: bool = False, by_request: bool = False
) -> str:
    """SNK-1.  ``single_file`` only suits small results: one task writes them.  ``by_request`` makes the write idempotent per run id."""
    return _write(schemas.conform(df, schemas.RECOMMENDATIONS), target, mode, single_file, by_request)


def write_missing(
    df: DataFrame, target: str, mode: str = "append", single_file: bool = False, by_request: bool = False
) -> str:
    """SNK-2.  The schema is declared, so an empty report still writes."""
    return _write(schemas.conform(df, schemas.MISSING_SKUS), target, mode, single_file, by_request)


def read_back(df: DataFrame, target: str) -> DataFrame:
    spark = df.sparkSession
    return spark.read.parquet(target) if "/" in target else spark.table(target)
