"""Merkle manifest of a dataset, with a proof for every row.

Each row is a leaf, the digest of its fields.  Within a group the leaves stand in
order; ``FANOUT`` consecutive nodes become one, level by level, until one is left, the
group's subroot; the subroots, ordered by group, become the root in the same way.

The tree is a nested-struct rollup.  A leaf's rank is split into a block of
``FANOUT ** DEPTH`` leaves and its ``DEPTH`` digits within the block.  Grouping by all
digits but the last nests the leaves into structs of digest and children, grouping
by all but the last two nests these, and so on, one digit column less each time; all
of it runs on one shuffle by group and block.  The block digests, with the block
number as rank, are the leaves of the next round, until each group has one block.
Then each block is opened from the top: nested transforms put the siblings of every
level beside each leaf, and an explode emits them, without joins inside a block; one
join per round, on a row for each block, hands down what stands above the block.

Ranks come from one range partitioning by group and order: the rows of a group are
spread over as many partitions as they fill, and the position of a row is its place
in the partition plus the number of rows in the partitions before it.

Cases: null fields are written ``-``; a null group comes first; a null order value
comes first within its group; rows that repeat an order value stand by their leaf,
so equal rows are interchangeable; a lone leaf is its own subroot and a lone subroot
the root; an empty table gives an empty result; further columns pass through inside
``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.ordering import ranked
from stockpilot.llm.text import staged

FANOUT = 3
DEPTH = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(values: list[Column]) -> Column:
    """Digest of the values: ``-`` if null, else UTF-8 bytes, a colon, the value."""
    written = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]
    return F.sha2(F.concat(*written), 256)


def nodes_at(total: Column, level: int) -> Column:
    """How many nodes a tree of ``total`` leaves has on a level."""
    return F.ceil(total / FANOUT**level) if level else total


def roll_up(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, total, block, node: the leaves (key, total, rank, digest, load) of each
    block nested ``depth`` levels deep.  A node is (digest, grown, load or children);
    on a level where the group already has one node, nothing grows."""
    digits = [F.expr(f"rank div {FANOUT**i} % {FANOUT}").cast("int").alias(f"d{i}") for i in range(depth)]
    block = F.expr(f"rank div {FANOUT**depth}").alias("block")
    now = nodes.select("key", "total", block, *digits, F.struct("digest", F.lit(False).alias("grown"), "load").alias("node"))
    now = now.repartition("key", "block")
    for level in range(1, depth + 1):
        left = [f"d{i}" for i in range(level, depth)]
        run = F.transform(F.sort_array(F.collect_list(F.struct(f"d{level - 1}", "node"))), lambda c: c["node"])
        gathered = now.groupBy("key", "total", "block", *left).agg(run.alias("children"))
        grown = nodes_at(F.col("total"), level - 1) > 1
        joined = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256)
        digest = F.when(grown, joined).otherwise(F.col("children")[0]["digest"])
        now = gathered.select("key", "total", "block", *left, F.struct(digest.alias("digest"), grown.alias("grown"), "children").alias("node"))
    return now


def _opened(node: Column, above: Column, level: int) -> Column:
    """load, digest and steps, leaf to root, of all leaves below ``node``."""
    if level == 0:
        return F.array(F.struct(node["load"].alias("load"), node["digest"].alias("digest"), above.alias("steps")))
    others = lambda i: F.transform(F.filter(node["children"], lambda _, j: j != i), lambda c: c["digest"])
    step = lambda i: F.struct(i.cast("int").alias("at"), others(i).alias("siblings"))
    below = lambda child, i: _opened(child, F.when(node["grown"], F.concat(F.array(step(i)), above)).otherwise(above), level - 1)
    return F.flatten(F.transform(node["children"], below))


def open_blocks(blocks: DataFrame, above: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, load, digest, steps, root of the leaves of the blocks.
    above: key, block, steps, root."""
    met = blocks.join(above, ["key", "block"])
    leaves = F.explode(_opened(F.col("node"), F.col("steps"), depth)).alias("leaf")
    return met.select("key", "root", leaves).select("key", "leaf.load", "leaf.digest", "leaf.steps", "root")


def trees(nodes: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The blocks of each round, written out; the last round has one block a group."""
    rounds = []
    while True:
        blocks = staged(roll_up(nodes, depth), "merkle-blocks")
        rounds.append(blocks)
        if blocks.agg(F.max("block")).first()[0] in (0, None):
            return rounds
        total = nodes_at(F.col("total"), depth).alias("total")
        nodes = blocks.select("key", total, F.col("block").alias("rank"), F.col("node.digest").alias("digest"), F.struct("block").alias("load"))


def proofs(rounds: list[DataFrame], above: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The leaves of the first round with their steps and the root.
    above: key, steps, root of each group's subroot."""
    down = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(rounds[1:]):
        down = open_blocks(blocks, down, depth).select("key", F.col("load.block").alias("block"), "steps", "root")
    return open_blocks(rounds[0], down, depth)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", keep: dict[str, Column] | None = None, depth: int = DEPTH) -> DataFrame:
    """leaf, subroot, root and steps (at, siblings; leaf to root) for each row, with
    the columns of ``keep`` (by default the group and order columns) in ``row``."""
    keep = {group: F.col(group), order: F.col(order)} if keep is None else keep
    leaves = docs.select(
        # Orders like the group's UTF-8 bytes, nulls first.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("key"),
        F.col(order).alias("sequence"),
        leaf([F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.struct(*[c.alias(name) for name, c in keep.items()]).alias("row"),
    )
    ordered = ranked(leaves, "key", ["sequence", "digest"])
    rounds = trees(ordered.select("key", "total", "rank", "digest", F.struct("row").alias("load")), depth)
    subroots = rounds[-1].select("key", F.col("node.digest").alias("digest"))
    tops = ranked(subroots.select(F.lit("").alias("all"), "key", "digest"), "all", ["key"])
    above_rounds = trees(tops.select(F.col("all").alias("key"), "total", "rank", "digest", F.struct("key").alias("load")), depth)
    top = above_rounds[-1].select(
        "key", F.expr("cast(array() as array<struct<at:int,siblings:array<string>>>)").alias("steps"), F.col("node.digest").alias("root")
    )
    sources = proofs(above_rounds, top, depth).select(F.col("load.key").alias("key"), F.col("digest").alias("subroot"), "steps", "root")
    sources = staged(sources, "merkle-subroots")
    done = proofs(rounds, sources.select("key", "steps", "root"), depth)
    return done.join(sources.select("key", "subroot"), "key").select("load.row", F.col("digest").alias("leaf"), "subroot", "root", "steps")


def proof_digest(steps: str = "steps") -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(steps, lambda s: s["siblings"])), ""), 256)


def fold(start: Column, steps: str = "steps") -> Column:
    """The root that a leaf digest and its siblings lead to."""

    def up(digest: Column, step: Column) -> Column:
        left, right = F.slice(step["siblings"], 1, step["at"]), F.slice(step["siblings"], step["at"] + 1, FANOUT)
        return F.sha2(F.concat(F.array_join(left, ""), digest, F.array_join(right, "")), 256)

    return F.aggregate(steps, start, up)
