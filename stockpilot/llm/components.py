"""Connected components of links, by contraction.

In each round every node points to its smallest neighbour if that is smaller,
pointers are followed to their ends by doubling, and the links are rewritten to
those ends; links inside a component vanish.  Nodes at least halve in each
round.  Neighbours are combined in each task, so a node with very many links
costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import staged


def _followed(points: DataFrame) -> DataFrame:
    """node, root: pointers (node -> to, to < node) followed to their ends."""
    points = staged(points, "component-pointers")
    while True:
        over = points.select(F.col("node").alias("at"), F.col("to").alias("next"))
        further = points.join(over, points["to"] == over["at"], "left")
        moved = staged(further.select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "component-pointers")
        points = moved.select("node", "to")
        if moved.where("moved").isEmpty():
            return points.select("node", F.col("to").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b): the root is the smallest node."""
    links = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links")
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    roots = staged(nodes.select("node", F.col("node").alias("root")), "component-roots")
    while not links.isEmpty():
        ends = _followed(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")))
        ends = ends.select(F.col("node").alias("old"), F.col("root").alias("new"))
        roots = staged(
            roots.join(ends, roots["root"] == ends["old"], "left").select("node", F.coalesce("new", "root").alias("root")),
            "component-roots",
        )
        # Every ``a`` has an end; a ``b`` may be one itself.
        left = links.join(ends, links["a"] == ends["old"]).select(F.col("new").alias("a"), "b")
        both = left.join(ends, left["b"] == ends["old"], "left").select("a", F.coalesce("new", "b").alias("b"))
        links = staged(
            both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links"
        )
    return roots
