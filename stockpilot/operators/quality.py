"""Data-quality checks (DQ-1..3); none collects rows.

Whole rows are counted only where a 128-bit digest of them repeats: the digests of
all rows are counted first, and in a sound table nothing but these is shuffled.  Rows
are told apart by their values; equal digests of different rows cost time, no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateRowsError(RuntimeError):
    """An order extract holds fully identical rows; the run must stop."""


def null_counts(df: DataFrame) -> DataFrame:
    """DQ-1: one row, one column per input column, holding its NULL count."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def has_nulls(df: DataFrame) -> bool:
    """True when any cell is NULL.  The reference only warns; the run goes on."""
    row = null_counts(df).first()
    return any(v for v in row) if row is not None else False


DIGEST = ("_digest_1", "_digest_2")


def with_digest(df: DataFrame) -> DataFrame:
    """The rows with two 64-bit hashes.  The hashes pass over NULLs, so a text that
    tells which columns are NULL is hashed with the values."""
    values = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return df.withColumns(dict(zip(DIGEST, (F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), *values, nulls)))))


def repeated_digests(df: DataFrame) -> DataFrame:
    """The digests that more than one row has."""
    return with_digest(df).groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*DIGEST)


def duplicate_rows(df: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """DQ-2: each row value that occurs more than once, with ``extra_copies``
    = occurrences - 1 (the 2nd and later copies).  Rows are reported, not
    dropped.

    ``repeated``: the repeated digests, if they are written already; the planner
    then sees their size and drops all other rows where they are read."""
    suspects = with_digest(df).join(repeated_digests(df) if repeated is None else repeated, list(DIGEST), "left_semi")
    return (
        suspects.groupBy(*DIGEST, *df.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(*df.columns, (F.col("copies") - 1).alias("extra_copies"))
    )


def duplicate_summary(df: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """DQ-3 as a query: number of duplicated row values and of extra rows."""
    return duplicate_rows(df, repeated).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("extra_copies"), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def assert_no_duplicates(df: DataFrame, what: str = "rows") -> None:
    """DQ-3: stop the run when ``df`` has fully identical rows.

    Whole rows are compared only when some digest repeats.  Reads at most one
    duplicated group back to the driver."""
    if repeated_digests(df).limit(1).count() > 0 and duplicate_rows(df).limit(1).count() > 0:
        raise DuplicateRowsError(f"duplicate {what} found; fix the extract and run again")
