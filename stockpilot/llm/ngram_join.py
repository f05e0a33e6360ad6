"""Size-aware Jaccard join on word shingles.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Documents with equal sets (by a 128-bit digest) are one node from here on.

*Small sets* are joined by enumeration.  Two sets of a and b shingles are similar
when they share c(a, b) = ceil(75 (a + b) / 175) shingles, so each enumerates its
subsets of that size, and sets that meet in a subset are similar without further
check.  *Large sets* are joined over inverted lists: each set enters the lists of
a prefix of its shingles, those that are frequent in the corpus last, the others
in hash order.  A prefix of n - ceil(0.75 n) + 1 shingles misses nothing.  Of long
sets fewer are needed: hash order is random, so where cold shingles make up a
share r > 1/3 of a set, each of the first m of a similar pair is shared with a
chance above 1 - 1/(3 r), and the prefix ends where the chance that none of them
is shared is below ``MISS``.  The size where one method gives way to the other is
chosen by the rows that both would make, from the histogram of sizes; sets near
it take part in both.

Only which documents hang together is asked for, so pairs inside a component need
no check.  First each node is compared with the one list head that it shares most
lists with; the head of a list is its node with the fewest shingles of its own,
that is, the least changed of a group of copies.  Then all pairs of different
components that meet in a list are compared, the smaller side of a list against
the rest.  Where two sets meet in a list, what precedes that shingle in either is
shared no more, or they meet in an earlier list: a pair is left to that list where
the rest of either set is too short for the needed overlap.  A list whose smaller side
has more than ``LONG`` nodes is not paired at all: its nodes are listed again under
``KEYS`` keys of ``TOGETHER`` shingles each, the least ones in as many random orders.  Similar
sets agree in such a key with a chance of 0.75 to the power ``TOGETHER`` at least, so
the chance that they share none is below 1e-18, while sets that share one passage of
several hardly meet; a pair is left to the first key that it shares.  And each node carries
the parities of its shingles in ``BITS`` groups: two sets differ in at least as many
shingles as parities, so pairs that differ in too many are left out.  No similar pair of
different components is left out, and a group of copies costs a few comparisons for
each member.  Every comparison counts the whole sets.

Cases: a text without words (or null) has an empty set and is linked with nothing;
fewer than five words are one shingle; rows that repeat a ``doc_id`` are nodes by
their texts; a null ``doc_id`` names a component only where all its documents
have none; an empty table gives an empty result; further columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.byte_bpe import Recent
from stockpilot.llm.components import components
from stockpilot.llm.text import batch_rows, lower_bytes, map_batches, map_partitions, staged

WORDS = 5
PERCENT = 75
#: Chance of missing a similar pair through the end of the prefix (to the power 3/4
#: for the smaller of two sets).
MISS = 1e-24
#: Largest set that may be enumerated.
SMALL_MAX = 16
#: An entry of the inverted lists (three shuffles and its share of the comparisons)
#: costs about this many rows of subsets.
LIST_COST = 10
#: Most shingles that are kept as frequent, and how they are found: repeated within
#: so many shingles, at least so often.
HOT_MAX = 200_000
HOT_CHUNK = 1 << 21
HOT_LEAST = 3

#: Keys of several shingles for a node, and shingles in each.
KEYS, TOGETHER = 76, 3
#: Nodes outside of a list's main component beyond which its nodes are listed under
#: such keys: then that makes fewer rows than pairing the list.
LONG = KEYS

#: Parities that stand for a set where pairs are left out.
BITS = 512

#: Rows that a task hands to Python and back at once: whole texts and sets, held on both sides.
SLICE = 1000

_known = Recent(xxhash.xxh3_64_intdigest, 50_000)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted hashes of the distinct shingles."""
    words = lower_bytes(text).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(len(words), WORDS)
    held = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        held = held * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - size + 1 + i]
    return np.unique(_mixed(held))


def needed(a: int, b: int) -> int:
    """Shingles that similar sets of a and b share at least."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def partners(n: int) -> range:
    """Sizes that a set of n can be similar to."""
    return range(-(-PERCENT * n // 100), 100 * n // PERCENT + 1)


def subset_count(n: int) -> int:
    return sum(math.comb(n, needed(n, b)) for b in partners(n))


def full_prefix(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def prefix(shingles: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The shingles under which a set is listed; ``hot`` is sorted."""
    n = len(shingles)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
        is_hot = hot[at] == shingles
    else:
        is_hot = np.zeros(n, dtype=bool)
    cold, size = shingles[~is_hot], full_prefix(n)
    share = 3 * len(cold) / n
    if share > 1.05:
        size = min(size, math.ceil(math.log(1 / MISS) / math.log(share)))
    return np.concatenate((cold, shingles[is_hot]))[:size]


def parities(shingles: np.ndarray) -> np.ndarray:
    """The parities of the shingles in each of ``BITS`` groups, as whole numbers of 64."""
    odd = np.bincount((shingles % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def hot_shingles(texts: DataFrame) -> np.ndarray:
    """The most frequent shingles, at most ``HOT_MAX``, over all texts.  What they
    are decides how long the lists get, not which pairs are found."""

    def run(batches):
        held, size = [], 0

        def repeated() -> dict:
            keys, n = np.unique(np.concatenate(held or [np.empty(0, dtype=np.uint64)]), return_counts=True)
            often = n >= HOT_LEAST
            return {"s": keys[often].view(np.int64), "n": n[often]}

        for batch in batches:
            for text in batch.column("text"):
                held.append(shingle_set(text.as_py()))
                size += len(held[-1])
                if size >= HOT_CHUNK:
                    yield repeated()
                    held, size = [], 0
        yield repeated()

    counts = staged(map_partitions(texts, run, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n")), "hot-counts")
    # Quarters of powers of two: a few hundred rows at most.
    bins = counts.groupBy(F.floor(4 * F.log2("n")).alias("bin")).count().orderBy(F.desc("bin")).collect()
    total, least = 0, None
    for r in bins:
        total += r["count"]
        if total > HOT_MAX:
            break
        least = r["bin"]
    if least is None:
        return np.empty(0, dtype=np.uint64)
    found = counts.where(F.floor(4 * F.log2("n")) >= least).select("s").toPandas()["s"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), text.alias("text"), *more
    )


def described(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """doc, version, n, digest, listed, bits, whole (of small sets) for each row."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n": [], "digest": [], "listed": [], "bits": [], "whole": []}
        for text in batch.column("text"):
            shingles = shingle_set(text.as_py())
            out["n"].append(len(shingles))
            out["digest"].append(xxhash.xxh3_128_digest(shingles.tobytes()))
            out["listed"].append(prefix(shingles, hot).view(np.int64) if len(shingles) else [])
            out["bits"].append(parities(shingles))
            out["whole"].append(shingles.view(np.int64) if len(shingles) <= SMALL_MAX else None)
        return out | {c: batch.column(c) for c in ("doc", "version")}

    schema = "doc bigint, version bigint, n bigint, digest binary, listed array<bigint>, bits array<bigint>, whole array<bigint>"
    return map_batches(_texts(docs), run, schema)


def node_table(described_docs: DataFrame) -> DataFrame:
    """id, digest, n, low (smallest doc_id), doc, version (one of its rows), listed, bits, whole."""
    nodes = described_docs.where("n > 0").groupBy("digest").agg(
        F.first("n").alias("n"),
        F.min("doc").alias("low"),
        F.min(F.struct("doc", "version")).alias("place"),
        F.first("listed").alias("listed"),
        F.first("bits").alias("bits"),
        F.first("whole").alias("whole"),
    )
    return nodes.select(F.monotonically_increasing_id().alias("id"), "digest", "n", "low", "place.doc", "place.version", "listed", "bits", "whole")


def boundary(nodes: DataFrame) -> int:
    """The largest size that is enumerated, by the rows that both ways would make."""
    sizes = {r["n"]: r["count"] for r in nodes.where(F.col("n") <= SMALL_MAX).groupBy("n").count().collect()}

    def cost(most: int) -> int:
        small = sum(c * subset_count(n) for n, c in sizes.items() if n <= most)
        lists = sum(c * full_prefix(n) for n, c in sizes.items() if n >= first_listed(most))
        return small + LIST_COST * lists

    return min(range(SMALL_MAX + 1), key=cost)


def first_listed(most: int) -> int:
    """The smallest size that can be similar to a size beyond ``most``."""
    return -(-PERCENT * (most + 1) // 100)


def small_subsets(nodes: DataFrame, most: int) -> DataFrame:
    """id, n, a, b, subset: the subsets that similar sets of a and b shingles share."""

    def run(batch: pa.RecordBatch) -> dict:
        rows = []
        for node, n, whole in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "whole"))):
            for other in partners(n):
                if other <= most:
                    a, b = min(n, other), max(n, other)
                    for subset in combinations(whole, needed(n, other)):
                        rows.append((node, n, a, b, xxhash.xxh3_128_digest(np.array(subset, dtype=np.int64).tobytes())))
        return dict(zip(("id", "n", "a", "b", "subset"), zip(*rows) if rows else [[]] * 5))

    small = nodes.where(F.col("n") <= most).select("id", "n", "whole")
    return staged(map_batches(small, run, "id bigint, n bigint, a bigint, b bigint, subset binary"), "subsets")


def small_links(nodes: DataFrame, most: int) -> DataFrame:
    """Links that join the sets of at most ``most`` shingles, by shared subsets."""
    subsets = small_subsets(nodes, most)
    met = (
        subsets.groupBy("a", "b", "subset")
        .agg(F.min("id").alias("head"), F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("of"))
        .where("of > 1 and low = a and high = b")
        .select("a", "b", "subset", "head")
    )
    return subsets.join(staged(met, "shared-subsets"), ["a", "b", "subset"]).where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))


def may_be_similar(n: str, at: str, m: str, m_at: str) -> Column:
    """Whether sets of n and m, that meet at these positions first, can share enough."""
    rest = F.least(F.col(n) - F.col(at), F.col(m) - F.col(m_at))
    return (100 + PERCENT) * rest >= PERCENT * (F.col(n) + F.col(m))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, shingles (bytes) of the wanted nodes (id, doc, version), from their texts."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "shingles": [shingle_set(t.as_py()).tobytes() for t in batch.column("text")]}

    key = ["doc", "version"]
    wanted = wanted.select("id", F.col("doc").alias("of_doc"), F.col("version").alias("of_version")).hint("shuffle_hash")
    texts = _texts(docs)
    same = texts["doc"].eqNullSafe(F.col("of_doc")) & (texts["version"] == F.col("of_version"))
    found = texts.join(wanted, same).dropDuplicates(key).select("id", "text")
    return map_batches(found, run, "id bigint, shingles binary")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, shared, either: the sizes of intersection and union of whole sets."""

    def run(batch: pa.RecordBatch) -> dict:
        shared, either = [], []
        for left, right in zip(batch.column("left"), batch.column("right")):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (left, right))
            shared.append(len(np.intersect1d(x, y, assume_unique=True)))
            either.append(len(x) + len(y) - shared[-1])
        return {"a": batch.column("a"), "b": batch.column("b"), "shared": shared, "either": either}

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return map_batches(both, run, "a bigint, b bigint, shared bigint, either bigint")


def similar() -> Column:
    return 100 * F.col("shared") >= PERCENT * F.col("either")


def list_heads(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """s, head, head_n, head_at: of each list the node that has the largest share of its
    entries in lists with others.  entries: s, id, n, at; nodes: id, listed_as."""
    shares = entries.groupBy("id").agg(F.count(F.lit(1)).alias("lists")).join(nodes, "id")
    rank = F.struct((-F.col("lists") / F.col("listed_as")).alias("own"), F.xxhash64("id").alias("tie"), F.col("id"))
    ranked = entries.join(shares.select("id", rank.alias("rank")), "id")
    return ranked.groupBy("s").agg(F.min(F.struct("rank", "n", "at")).alias("head")).select(
        "s", F.col("head.rank.id").alias("head"), F.col("head.n").alias("head_n"), F.col("head.at").alias("head_at")
    )


def best_heads(entries: DataFrame, heads: DataFrame) -> DataFrame:
    """a, b: each node with the head that it shares most lists with."""
    shared = (
        entries.join(heads, "s")
        .where((F.col("id") != F.col("head")) & may_be_similar("n", "at", "head_n", "head_at"))
        .groupBy("id", "head")
        .agg(F.count(F.lit(1)).alias("lists"))
    )
    return shared.groupBy("id").agg(F.max_by("head", F.struct("lists", "head")).alias("b")).select(F.col("id").alias("a"), "b")


def labelled(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """entries with the component of each node."""
    known = roots.select(F.col("node").alias("id"), "root")
    return entries.join(known, "id", "left").select("s", "id", "n", "at", F.coalesce("root", "id").alias("part"))


def few_differences(n: str, bits: str, m: str, m_bits: str) -> Column:
    """Whether the parities of two sets of n and m allow for enough shared shingles."""
    words = [F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.get(m_bits, F.lit(i)))) for i in range(BITS // 64)]
    both = F.col(n) + F.col(m)
    return (100 + PERCENT) * (both - sum(words, F.lit(0))) >= 2 * PERCENT * both


def several_keys(shingles: np.ndarray) -> np.ndarray:
    """Keys of the least ``TOGETHER`` shingles in random orders, ``KEYS`` of them."""
    salts = _mixed(np.arange(1, KEYS * TOGETHER + 1, dtype=np.uint64))
    least = np.array([_mixed(shingles ^ salt).min() for salt in salts], dtype=np.uint64).reshape(KEYS, TOGETHER)
    held = np.zeros(KEYS, dtype=np.uint64)
    for i in range(TOGETHER):
        held = _mixed(held * np.uint64(0x9E3779B97F4A7C15) + least[:, i])
    return (held >> np.uint64(32)).astype(np.uint32)


def listed_again(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """s, id, n, at, part, bits, keys: the nodes in a list for each of their keys of
    several shingles; ``s`` is the place of the key among them and the key."""

    def run(batch: pa.RecordBatch) -> dict:
        keys = [several_keys(np.frombuffer(v.as_buffer(), dtype=np.uint64)).view(np.int32) for v in batch.column("shingles")]
        return {"id": batch.column("id"), "keys": keys}

    keyed = map_batches(nodes.select("id").join(sets, "id"), run, "id bigint, keys array<int>")
    place = nodes.join(keyed, "id").select("id", "n", F.lit(0).alias("at"), "part", "bits", "keys", F.posexplode("keys").alias("place", "key"))
    whole = F.shiftleft(F.col("place").cast("bigint"), 32).bitwiseOR(F.col("key").cast("bigint").bitwiseAND(0xFFFFFFFF))
    return place.select(whole.alias("s"), "id", "n", "at", "part", "bits", "keys")


def met_before(s: str, keys: str, others: str) -> Column:
    """Whether two nodes that meet in the list of a key share an earlier key."""
    place = F.shiftright(F.col(s), 32).cast("int")
    return F.exists(F.arrays_zip(F.slice(keys, 1, place).alias("x"), F.slice(others, 1, place).alias("y")), lambda k: k["x"] == k["y"])


def main_parts(entries: DataFrame) -> DataFrame:
    """s, main, fewer: of each list with several components the most frequent one, and
    how many nodes are outside of it."""
    parts = entries.groupBy("s", "part").agg(F.count(F.lit(1)).alias("of"))
    lists = parts.groupBy("s").agg(F.max_by("part", F.struct("of", "part")).alias("main"), F.max("of").alias("most"), F.sum("of").alias("of"))
    return lists.where("of > most").select("s", "main", (F.col("of") - F.col("most")).alias("fewer"))


def met_in_lists(marked: DataFrame) -> DataFrame:
    """a, b: in each list, the nodes outside of its main component with all others.
    marked: s, id, n, at, part, bits, main, and keys where these made the lists."""
    by_keys = "keys" in marked.columns
    own = ("id", "n", "at", "part", "bits", *(["keys"] if by_keys else []))
    fewer = marked.where("part <> main").select("s", *[F.col(c).alias(f"a_{c}") for c in own])
    wanted = (
        (F.col("a_part") != F.col("part"))
        & ((F.col("part") == F.col("main")) | (F.col("a_id") < F.col("id")))
        & may_be_similar("a_n", "a_at", "n", "at")
        & few_differences("a_n", "a_bits", "n", "bits")
    )
    met = fewer.join(marked, "s").where(wanted & ~met_before("s", "a_keys", "keys") if by_keys else wanted)
    return met.select(F.greatest("a_id", "id").alias("a"), F.least("a_id", "id").alias("b"))


def crossing_pairs(entries: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of different components that meet in a list and may be similar.
    entries: s, id, n, at, part; nodes: id, bits; sets: id, shingles."""
    main = staged(main_parts(entries), "list-components")
    marked = staged(entries.join(main, "s").join(nodes, "id"), "crossing-lists")
    pairs = met_in_lists(marked.where(F.col("fewer") <= LONG))
    crowded = marked.where(F.col("fewer") > LONG).select("id", "n", "part", "bits").dropDuplicates(["id"])
    crowded = staged(crowded, "crowded-nodes")
    if not crowded.isEmpty():
        again = staged(listed_again(crowded, sets), "several-shingles")
        pairs = pairs.union(met_in_lists(again.join(staged(main_parts(again), "several-components"), "s")))
    return pairs.distinct()


def small_pairs(nodes: DataFrame, most: int) -> DataFrame:
    """a, b: all similar pairs among the sets of at most ``most`` shingles."""
    subsets = small_subsets(nodes, most)
    one = subsets.select("a", "b", "subset", F.col("id").alias("one"), F.col("n").alias("one_n"))
    both = subsets.join(one, ["a", "b", "subset"]).where(
        (F.col("id") > F.col("one")) & (F.least("n", "one_n") == F.col("a")) & (F.greatest("n", "one_n") == F.col("b"))
    )
    return both.select(F.col("id").alias("a"), F.col("one").alias("b")).distinct()


@dataclass(frozen=True)
class Lists:
    rows: DataFrame  # a row for each document
    nodes: DataFrame  # distinct sets
    most: int  # the largest size that is enumerated
    entries: DataFrame  # s, id, n, at
    sets: DataFrame  # id, shingles


def lists_of(docs: DataFrame) -> Lists:
    """The distinct sets and their inverted lists."""
    hot = hot_shingles(_texts(docs).select("text"))
    rows = staged(described(docs, hot), "shingle-prefixes")
    nodes = staged(node_table(rows), "shingle-nodes")
    most = boundary(nodes)
    listed = nodes.where(F.col("n") >= first_listed(most)).select("id", "n", F.posexplode("listed").alias("at", "s"))
    shared = staged(listed.groupBy("s").agg(F.count(F.lit(1)).alias("of")).where("of > 1").select("s"), "shared-shingles")
    entries = staged(listed.join(shared, "s").select("s", "id", "n", "at"), "inverted-lists")
    wanted = entries.select("id").distinct().join(nodes.select("id", "doc", "version"), "id")
    return Lists(rows, nodes, most, entries, staged(sets_of(docs, wanted), "shingle-sets"))


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc, version, n_shingles, component_id for each row of ``docs``."""
    with batch_rows(docs.sparkSession, SLICE):
        return _joined(docs)


def _joined(docs: DataFrame) -> DataFrame:
    found = lists_of(docs)
    rows, nodes, entries, sets = found.rows, found.nodes, found.entries, found.sets
    links = [staged(small_links(nodes, found.most), "small-links")]
    heads = list_heads(entries, nodes.select("id", F.size("listed").alias("listed_as")))
    pairs = staged(best_heads(entries, heads), "head-pairs")
    links.append(staged(compared(pairs, sets).where(similar()).select("a", "b"), "head-links"))
    roots = components(_all(links))
    lists = staged(labelled(entries, roots), "labelled-lists")
    pairs = staged(crossing_pairs(lists, nodes.select("id", "bits"), sets), "crossing-pairs")
    links.append(staged(compared(pairs, sets).where(similar()).select("a", "b"), "crossing-links"))
    roots = components(_all(links))
    named = nodes.join(roots, nodes["id"] == roots["node"], "left").select("digest", "low", F.coalesce("root", "id").alias("root"))
    named = staged(named, "node-components")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_digest = staged(named.join(lowest, "root").select("digest", "component_id"), "component-names")
    return rows.join(by_digest, "digest", "left").select(
        "doc", "version", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id")
    )


def set_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links: (a, b) of the numbers of distinct similar sets, each pair once, and the
    members (id, doc, version, copies) of the sets, ``copies`` being the rows of a set.
    As many rows as there are links: a group of k near copies has up to k (k - 1) / 2."""
    with batch_rows(docs.sparkSession, SLICE):
        return _set_links(docs)


def _set_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    found = lists_of(docs)
    alone = found.entries.withColumn("part", F.col("id"))
    pairs = staged(crossing_pairs(alone, found.nodes.select("id", "bits"), found.sets), "all-pairs")
    large = compared(pairs, found.sets).where(similar()).select("a", "b")
    links = staged(large.union(small_pairs(found.nodes, found.most)).distinct(), "all-links")
    sizes = found.rows.where("n > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    classes = found.nodes.select("digest", "id").join(sizes, "digest")
    members = found.rows.select("doc", "version", "digest").join(classes, "digest", "left").select("id", "doc", "version", "copies")
    return links, staged(members, "set-members")


def link_counts(docs: DataFrame) -> DataFrame:
    """doc, version, n_links for each row: how many other rows are similar, copies
    included.  Rows without words have none."""
    links, members = set_links(docs)
    both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(links.select(F.col("b").alias("id"), F.col("a").alias("to")))
    sizes = members.where("id is not null").groupBy(F.col("id").alias("to")).agg(F.first("copies").alias("copies"))
    linked = both.join(sizes, "to").groupBy("id").agg(F.sum("copies").alias("others"))
    counts = F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("bigint")
    return members.join(linked, "id", "left").select("doc", "version", counts.alias("n_links"))


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the one that names it.  Of repeated rows one stays."""
    joined = ngram_join(docs).select(F.col("doc").alias("of_doc"), F.col("version").alias("of_version"), "component_id")
    stays = joined.where(F.col("of_doc").eqNullSafe(F.col("component_id"))).select("of_doc", "of_version").distinct().hint("shuffle_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("version"),
    )
    same = rows["doc"].eqNullSafe(F.col("of_doc")) & (rows["version"] == F.col("of_version"))
    return rows.join(stays, same).select("row", "doc", "version").dropDuplicates(["doc", "version"]).select("row.*")
