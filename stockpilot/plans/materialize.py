"""Stage boundaries: write an intermediate result once and read it back.

The job reuses several intermediates (the expanded request, the on-hand
extract, the per-position aggregates, the store forecast).  Left lazy, every
reuse repeats the whole subtree in the plan, and the repeats compound from
stage to stage.  Written as parquet in the shared folder
(``spark.checkpoint.dir``), each one becomes a leaf: the next plan is small,
its columns and filters still prune at the scan, and the lineage is cut, so a
lost executor does not recompute the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockpilot.session import scratch_path
from stockpilot.sources.extracts import stage


def materialize(df: DataFrame, name: str, written: list[str] | None = None) -> DataFrame:
    """``written`` collects the path, for whoever removes it when the run ends."""
    path = scratch_path(df.sparkSession, name)
    if written is not None:
        written.append(path)
    return stage(df, path)
