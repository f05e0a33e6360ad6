"""Join helpers (PRJ-2, JN-1, JN-7..9).

All joins are equi-joins.  Broadcast is never forced here: adaptive execution
measures each side and broadcasts only what fits its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_left_wins(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """PRJ-2: join on same-named keys; where both sides have a non-key column
    of the same name, the left copy is kept.  The right copies are dropped
    before the join, so they are never read.  A view of this single step: the job's
    joins select the columns that they need from either side."""
    keys = set(on)
    right_cols = [c for c in right.columns if c in keys or c not in left.columns]
    return left.join(right.select(*right_cols), list(on), how)


def full_outer_by_parts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """JN-1: full outer join as matched rows plus each side's unmatched rows.

    Equal to ``left.join(right, on, "full")`` with NULL-free keys.  Each part
    is an inner or anti join, which adaptive execution can split when one key
    holds a large share of the rows; a sort-merge full outer join would keep
    all rows of such a key in one task's memory.  The anti parts only read the
    other side's distinct keys.  A view of this single step: in the job every
    catalog row that is read matches, so ``request.expand_request`` needs the inner
    part and one anti join only.
    """
    keys = list(on)
    cols = keys + [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys and c not in left.columns]
    left_keys = left.select(*keys).distinct()
    right_keys = right.select(*keys).distinct()
    matched = left.join(right, keys, "inner")
    left_only = left.join(right_keys, keys, "left_anti")
    right_only = right.join(left_keys, keys, "left_anti")
    return (
        matched.select(*cols)
        .unionByName(left_only, allowMissingColumns=True)
        .unionByName(right_only, allowMissingColumns=True)
        .select(*cols)
    )


def enrich(df: DataFrame, aggregate: DataFrame, keys: Sequence[str], fill: dict[str, object] | None = None) -> DataFrame:
    """JN-7: left join a pre-aggregated frame (one row per key) and optionally
    fill its columns where nothing matched."""
    out = df.join(aggregate, list(keys), "left")
    return out.fillna(fill) if fill else out


def without(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """JN-8: rows of ``df`` whose key is not among ``other``'s keys.  A NULL
    key in ``df`` never matches, so it is kept (NOT EXISTS, not NOT IN).

    ``other`` is reduced to its distinct keys first; with map-side partial
    aggregation a key repeated on a third of its rows arrives as one row."""
    right = other.select(F.col(other_key or key).alias(key)).distinct()
    return df.join(right, key, "left_anti")


def only(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """JN-9: rows of ``df`` whose key is in ``keys``.  A view of this single step: the
    job's zero-fill test is the anti join ``without``."""
    return df.join(keys.select(key), key, "left_semi")
