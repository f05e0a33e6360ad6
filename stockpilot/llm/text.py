"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import stockpilot
from stockpilot.session import discard, scratch_path

# ASCII white space as the contracts name it: [\x20\x09-\x0D].  bytes.split()
# without arguments splits on exactly these.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 of ``text`` with A-Z lower-cased; null gives no bytes."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """``docs`` with every column inside one struct ``row``, so that working
    columns never clash with the columns of the input."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is
    cut by files that every executor can read."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Staged tables of one run that later steps stop reading."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = scratch_path(self.spark, f"llm-{name}")
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def remove(self, *names: str) -> None:
        """Nothing reads these tables from now on."""
        for name in names:
            discard(self.spark, self.paths.pop(name))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows for the Python functions of jobs run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def with_fields(df: DataFrame, column: str, ddl: str) -> StructType:
    """The schema of ``column`` of ``df`` and the fields of ``ddl`` after it."""
    return StructType([df.schema[column], *StructType.fromDDL(ddl)])


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, for
    sessions that got it neither from ``--py-files`` nor from ``PYTHONPATH``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(stockpilot.__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def map_partitions(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | StructType) -> DataFrame:
    """``mapInArrow``: ``function`` gives dicts of columns for the batches of a partition."""
    target = arrow_schema(schema)
    on_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in function(batches):
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over single batches: ``function`` gives a dict of columns."""
    return map_partitions(df, lambda batches: map(function, batches), schema)
