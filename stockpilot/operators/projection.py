"""Column shaping (PRJ-1) and run tagging (PRJ-13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(
    df: DataFrame,
    select: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """PRJ-1: drop, then select, then rename columns.  A view of this single step:
    the job selects its columns where it reads them."""
    out = df.drop(*drop) if drop else df
    if select:
        out = out.select(*select)
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    return out


def with_request_id(df: DataFrame, request_id: str) -> DataFrame:
    """PRJ-13: tag every row with the run id.  The id is a parameter, so a
    run can be repeated with the same tag."""
    return df.withColumn("request_id", F.lit(request_id))
