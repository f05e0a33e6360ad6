"""Print the physical plan of every job of one run, for review.

    python -m stockpilot.plans.report /root/testdata/sf0.1 > PLANS.md

For each stage boundary and each output: the tree part of
``explain("formatted")`` and a count of shuffles, broadcasts and join
strategies.  These are the plans before execution; adaptive execution may
still turn a sort-merge join into a broadcast join once it has measured a side.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql import DataFrame

from stockpilot import registry
from stockpilot.plans.stages import Stages


class _Recording(Stages):
    def __init__(self, base: Stages) -> None:
        super().__init__(base.inputs, base.cfg)
        self.recorded: list[tuple[str, DataFrame]] = []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        self.recorded.append((name, df))
        return super()._keep(df, name)


def _tree(df: DataFrame) -> str:
    """The operator tree, then for each parquet scan its pushed filters and
    read schema."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0].strip()
    scans = []
    for block in text.split("\n\n"):
        head = block.strip().split("\n")[0]
        if re.match(r"\(\d+\) Scan parquet", head):
            keep = [ln for ln in block.strip().split("\n")[1:] if ln.startswith(("PushedFilters", "ReadSchema"))]
            scans.append("\n".join([head] + keep))
    return tree + ("\n\n" + "\n".join(scans) if scans else "")


def _summary(tree: str) -> str:
    counts = {
        "shuffles": len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(", tree)),
        "broadcast hash joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "sort-merge joins": len(re.findall(r"SortMergeJoin", tree)),
        "windows": len(re.findall(r"Window \(", tree)),
    }
    return ", ".join(f"{v} {k}" for k, v in counts.items())


def main(sf_dir: str) -> None:
    st = _Recording(registry.stages(sf_dir=sf_dir, spark=_spark()))
    outputs = [("recommendations (final job)", st.recommendations), ("missing_skus", st.missing_skus)]
    print(f"# Physical plans, {sf_dir}\n")
    print("Generated by `python -m stockpilot.plans.report`; plans before adaptive re-planning.\n")
    for name, df in st.recorded + outputs:
        tree = _tree(df)
        print(f"## {name}\n\n{_summary(tree)}\n\n```\n{tree}\n```\n")


def _spark():
    from stockpilot.session import local_session

    return local_session(8)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
