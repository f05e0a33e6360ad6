"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is a set of paragraph digests: its lines without white space at the ends;
a line of more than ``LONGEST`` code points is cut after the ends of its sentences,
and a sentence that is still longer after words whose hash is divisible by 8, so a
change in one place leaves the other parts as they were.  Texts are cut and hashed by
Spark's functions; only digests go to Python.  A paragraph that comes again counts
again, with its number in the digest.

The texts of a batch are sketched and peeled together, by arrays.  Each digest goes to
one cell in each of three parts of a sketch.  A cell holds the
number of its digests, and their exclusive or beside that of their check values.
Subtracting the sketches of two versions leaves the digests of only one of them;
peeling takes a cell with a single digest, removes that digest from its other
cells, and goes on until all cells are empty.  Where it gets stuck, both versions
are sketched again with four times the cells, as often as needed: sketches are
compared exactly, whatever the lengths.  The fingerprint is the smallest sketch,
``CELLS`` cells, as text; equal texts have equal fingerprints.  Likeness is the
share of digests that both versions hold among those that either holds.

``with_next`` puts beside each document the next one in order.  Documents are cut
into ranges of ids; the first document of each range is also sent to the end of the
range before it, so whole texts are shuffled once and no window holds more than a
range.  The bounds of the ranges are a few numbers for each shuffle partition.

Cases: a null text is empty; two texts without paragraphs have likeness 1; rows
that repeat a ``doc_id`` follow each other by the hash of their text, then the
text; a null ``doc_id`` comes last in descending order; a single document is
its own next one; an empty table gives an empty result; further columns pass
through inside ``row``.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpilot.llm.text import SPACES, map_partitions, text_or_empty, with_fields

CELLS = 24
GROWTH = 4
LONGEST = 120

MASK = (1 << 64) - 1
# Odd multipliers of 64 bits: three for the places of a digest, one for its check.
PLACES = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)))
CHECK = np.uint64(0xD6E8FEB86659FD93)

#: Digests of the texts, and cells of their sketches, that Python handles at once; a text
#: that has more is handled by itself.
GROUP = 1 << 16
MOST_CELLS = 1 << 18

SPACE = r"[\x20\x09-\x0D]+"
SENTENCE_END = rf"(?<=[.!?]){SPACE}"

FIRST_ID = -(2**63)
#: Ranges of ids for each shuffle partition: several, so that partitions come out even.
RANGES = 4


def paragraphs(text: Column, longest: int = LONGEST) -> Column:
    """The parts of a text, an array of strings."""

    def cut(parts: Column, pieces) -> Column:
        return F.flatten(F.transform(parts, lambda p: F.when(F.length(p) <= longest, F.array(p)).otherwise(pieces(p))))

    def by_words(part: Column) -> Column:
        ends = lambda w: F.when(F.crc32(w.cast("binary")) % 8 == 0, "\n").otherwise(" ")
        return F.split(F.array_join(F.transform(F.split(part, SPACE), lambda w: F.concat(w, ends(w))), ""), "\n", -1)

    parts = cut(cut(F.split(text, "\n", -1), lambda p: F.split(p, SENTENCE_END, -1)), by_words)
    return F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(SPACES))), lambda p: p != "")


def digests(text: Column, longest: int = LONGEST) -> Column:
    """A 64-bit digest for each paragraph, repeated ones alike."""
    return F.transform(paragraphs(text, longest), lambda p: F.xxhash64(p))


def _numbered(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    order = np.lexsort((keys, rows))  # equal ones keep their order
    k, r = keys[order], rows[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    if first.all():
        return keys
    at = np.arange(len(k))
    out = np.empty_like(keys)
    out[order] = k + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64) * CHECK
    return out


def numbered(found: list[int]) -> list[int]:
    """Unsigned digests; the n-th equal one has n in it."""
    return Version(found).keys


def check(keys: np.ndarray) -> np.ndarray:
    return (keys ^ keys >> np.uint64(29)) * CHECK >> np.uint64(32)


def places(keys: np.ndarray) -> list[np.ndarray]:
    """Three numbers of 44 bits; their remainders are the places in the parts."""
    mixed = keys ^ keys >> np.uint64(31)
    return [mixed * p >> np.uint64(20) for p in PLACES]


def _cells_of(placed: list[np.ndarray], rows: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell in each part, with the ``cells`` of all rows one after the other."""
    third = cells // 3
    return [(p % np.uint64(third)).astype(np.int64) + (rows * cells + i * third) for i, p in enumerate(placed)]


class Sketch:
    """Sketches of some texts, a row for each: ``counts``, and the exclusive or of the
    digests (``keys``) and of their ``checks``, of each cell."""

    def __init__(self, counts: np.ndarray, keys: np.ndarray, checks: np.ndarray):
        self.counts, self.keys, self.checks = counts, keys, checks

    def __sub__(self, other: Sketch) -> Sketch:
        return Sketch(self.counts - other.counts, self.keys ^ other.keys, self.checks ^ other.checks)

    def of(self, rows: np.ndarray) -> Sketch:
        return Sketch(self.counts[rows], self.keys[rows], self.checks[rows])

    def peel_each(self, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which rows were peeled until all cells were empty (not those whose cells are too
        few, or would give more than ``most`` digests), and the row, digest and whether only
        the second version holds it, of the digests found in any.  In each round all
        digests that are alone in a cell are taken."""
        n, cells = self.counts.shape
        counts, sums, checks = self.counts.ravel().copy(), self.keys.ravel().copy(), self.checks.ravel().copy()
        left = np.array(most, np.int64)
        found = []
        todo = np.flatnonzero(np.abs(counts) == 1)
        while len(todo):
            key = sums[todo]
            right = check(key) == checks[todo]
            todo, key = todo[right], key[right]
            row = todo // cells
            at = _cells_of(places(key), row, cells)
            right = (at[0] == todo) | (at[1] == todo) | (at[2] == todo)
            # A digest may be alone in two or three of its cells.
            order = np.lexsort((key, row))
            order = order[right[order]]
            once = np.ones(len(order), bool)
            once[1:] = (key[order[1:]] != key[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
            order = order[once]
            left -= np.bincount(row[order], minlength=n)
            order = order[left[row[order]] >= 0]
            key, row, sign, at = key[order], row[order], counts[todo[order]], [c[order] for c in at]
            found.append((row, key, sign < 0))
            values = check(key)
            for c in at:
                np.subtract.at(counts, c, sign)
                np.bitwise_xor.at(sums, c, key)
                np.bitwise_xor.at(checks, c, values)
            todo = np.unique(np.concatenate(at))
            todo = todo[np.abs(counts[todo]) == 1]
        rest = (counts != 0) | (sums != 0) | (checks != 0)
        solved = (left >= 0) & ~rest.reshape(n, cells).any(axis=1)
        rows, keys, second = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, t) for i, t in enumerate((np.int64, np.uint64, bool)))
        return solved, rows, keys, second

    def peel(self, most: int) -> tuple[list[int], list[int]] | None:
        """Of a single text: the digests of only the first and of only the second version,
        or None if the cells are too few (or would give more than ``most`` digests)."""
        solved, _, keys, second = self.peel_each(np.array([most]))
        return (keys[~second].tolist(), keys[second].tolist()) if solved[0] else None

    def texts(self) -> list[str]:
        shown = np.empty(self.counts.shape, [("count", "<u4"), ("key", "<u8"), ("check", "<u4")])
        shown["count"], shown["key"], shown["check"] = self.counts, self.keys, self.checks
        whole, size = shown.tobytes(), shown.itemsize * shown.shape[1]
        return [base64.b64encode(whole[i : i + size]).decode() for i in range(0, len(whole), size)]

    def text(self) -> str:
        return self.texts()[0]


class Versions:
    """The digests of some texts, those of text i from ``offsets[i]`` on, and their sketches."""

    def __init__(self, found: np.ndarray, offsets: np.ndarray):
        self.offsets, self.sizes = offsets, np.diff(offsets)
        self.digests = _numbered(found, np.repeat(np.arange(len(self.sizes)), self.sizes))
        self._checks, self._places = check(self.digests), places(self.digests)
        self._sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int) -> Sketch:
        """Of all texts; kept."""
        if cells not in self._sketches:
            self._sketches[cells] = self.sketch_of(np.arange(len(self.sizes)), cells)
        return self._sketches[cells]

    def sketch_of(self, rows: np.ndarray, cells: int) -> Sketch:
        if cells in self._sketches:
            return self._sketches[cells].of(rows)
        sizes = self.sizes[rows]
        n, ends = len(rows), np.cumsum(sizes)
        take = np.arange(sizes.sum()) + np.repeat(self.offsets[rows] - (ends - sizes), sizes)
        keys, checks = self.digests[take], self._checks[take]
        counts, sums, marks = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
        for at in _cells_of([p[take] for p in self._places], np.repeat(np.arange(n), sizes), cells):
            counts += np.bincount(at, minlength=n * cells)
            np.bitwise_xor.at(sums, at, keys)
            np.bitwise_xor.at(marks, at, checks)
        return Sketch(*(x.reshape(n, cells) for x in (counts, sums, marks)))


class Version(Versions):
    """One text."""

    def __init__(self, found: list[int]):
        super().__init__(np.array([k & MASK for k in found], np.uint64), np.array([0, len(found)]))
        self.keys = self.digests.tolist()


def differences(old: Versions, new: Versions, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of versions the number of cells that were needed, and the row, digest
    and whether only the new version holds it, of the digests that only one of them holds."""
    most, apart = old.sizes + new.sizes, np.abs(old.sizes - new.sizes)
    level = np.full(len(most), cells)
    while (low := level < apart).any():  # at least so many differ
        level[low] *= GROWTH
    used = np.zeros(len(most), np.int64)
    found = []
    while not used.all():
        at = np.flatnonzero((level == cells) & (used == 0))
        step = max(1, MOST_CELLS // cells)
        for some in (at[i : i + step] for i in range(0, len(at), step)):
            solved, rows, keys, second = (old.sketch_of(some, cells) - new.sketch_of(some, cells)).peel_each(most[some])
            right = solved[rows]
            found.append((some[rows[right]], keys[right], second[right]))
            used[some[solved]] = cells
            level[some[~solved]] *= GROWTH
        cells *= GROWTH
    rows, keys, second = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, t) for i, t in enumerate((np.int64, np.uint64, bool)))
    return used, rows, keys, second


def difference(old: Version, new: Version, cells: int = CELLS) -> tuple[list[int], list[int], int]:
    """Digests that only ``old`` holds, those that only ``new`` holds, and the
    number of cells that gave them."""
    used, _, keys, second = differences(old, new, cells)
    return keys[~second].tolist(), keys[second].tolist(), int(used[0])


def likeness(old: Versions, new: Versions, changed: np.ndarray | int) -> np.ndarray:
    """Of each pair, by the number of digests that only one of them holds."""
    total = old.sizes + new.sizes
    return np.where(total > 0, (total - changed) / np.maximum(total + changed, 1), 1.0)


def _lists_of(rows: np.ndarray, keys: np.ndarray, n: int) -> list[np.ndarray]:
    """The digests of each of ``n`` rows, as sorted unsigned ones but with their sign."""
    order = np.lexsort((keys, rows))
    return np.split(keys[order].view(np.int64), np.searchsorted(rows[order], np.arange(1, n)))


def compare(rows: DataFrame, own: str, others: list[str], columns: list[str] | None = None, cells: int = CELLS, full: bool = True) -> DataFrame:
    """``row`` (the columns named, or all) with the ``fingerprint`` of the ``digests`` in
    column ``own``, and for each column of ``others`` a struct of that name: fingerprint,
    likeness, the number of cells that were needed, and the digests that only the one
    or the other text holds (left empty unless ``full``)."""
    if cells % 3:
        raise ValueError("cells come in three equal parts")
    row = F.struct(*[F.col(f"`{c}`") for c in (rows.columns if columns is None else columns)]).alias("row")
    inputs = rows.select(row, *[F.col(f"`{c}`").alias(f"keys{i}") for i, c in enumerate([own, *others])])
    each = {"fingerprint": "string", "likeness": "double", "cells": "bigint", "lost": "array<bigint>", "gained": "array<bigint>"}
    flat = {f"{name}{i}": kind for i in range(len(others)) for name, kind in each.items()}
    schema = with_fields(inputs, "row", ", ".join(f"{name} {kind}" for name, kind in {"fingerprint": "string", **flat}.items()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[dict]:
        for batch in batches:
            columns = [batch.column(f"keys{i}") for i in range(len(others) + 1)]
            lists = [(c.offsets.to_numpy(), c.values.to_numpy().view(np.uint64)) for c in columns]
            for a, b in _groups(sum(np.diff(offsets) for offsets, _ in lists)):
                version, *rest = (Versions(values[o[a] : o[b]], o[a : b + 1].astype(np.int64) - o[a]) for o, values in lists)
                out = {"row": batch.column("row").slice(a, b - a), "fingerprint": version.sketch(cells).texts()}
                for i, other in enumerate(rest):
                    out[f"fingerprint{i}"] = other.sketch(cells).texts()
                    used, rows, keys, second = differences(version, other, cells)
                    out[f"cells{i}"] = used
                    out[f"likeness{i}"] = likeness(version, other, np.bincount(rows, minlength=b - a))
                    out[f"lost{i}"] = _lists_of(rows[~second], keys[~second], b - a) if full else [[]] * (b - a)
                    out[f"gained{i}"] = _lists_of(rows[second], keys[second], b - a) if full else [[]] * (b - a)
                yield out

    done = map_partitions(inputs, run, schema)
    return done.select(
        "row", "fingerprint", *[F.struct(*[F.col(f"{name}{i}").alias(name) for name in each]).alias(c) for i, c in enumerate(others)]
    )


def _groups(sizes: np.ndarray) -> Iterable[tuple[int, int]]:
    """Bounds of rows that have about ``GROUP`` digests together."""
    number = np.cumsum(sizes) // GROUP
    bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def _range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds not above ``key``, looked up in two steps."""
    step = math.isqrt(len(bounds)) + 1
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    array = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    if not chunks:
        return F.lit(0)
    at = F.size(F.filter(array(c[0] for c in chunks), lambda b: b <= key)) - 1
    chunk = F.get(F.array(*[array(c) for c in chunks]), at)
    return F.when(at < 0, 0).otherwise(at * step + F.size(F.filter(chunk, lambda b: b <= key)))


def with_next(docs: DataFrame, ranges: int | None = None, longest: int = LONGEST, columns: list[str] | None = None) -> DataFrame:
    """row (the columns named, or all), text, keys (its digests), next_text, next_keys: each document with the
    text of the next one by descending ``doc_id``; the first one follows the last."""
    spark = docs.sparkSession
    if ranges is None:
        ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID))
    shares = [i / ranges for i in range(1, ranges)]
    bounds: list[int] = []
    if shares:
        bounds = docs.agg(F.percentile_approx(key, shares, max(10000, 20 * ranges)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    # One row for each range, at most ``ranges`` in all.
    heads = docs.select(key.alias("key")).groupBy(_range_of(F.col("key"), bounds).alias("at")).agg(F.max("key").alias("head")).collect()
    tops = [r["head"] for r in sorted(heads, key=lambda r: r["at"])]
    used = [r["at"] for r in sorted(heads, key=lambda r: r["at"])]
    # The head of a range ends the next higher range; the highest one ends the lowest.
    ends = spark.createDataFrame([(top, at) for top, at in zip(tops, used[1:] + used[:1])], "head bigint, ends int")
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]).alias("row")
    rows = docs.select(kept, key.alias("key"), text_or_empty().alias("body"))
    sent = rows.join(F.broadcast(ends), rows["key"] == ends["head"], "left")  # at most ``ranges`` rows
    own = F.struct(_range_of(F.col("key"), bounds).alias("at"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("ends").alias("at"), F.lit(True).alias("copy"))
    places = F.explode(F.when(F.col("ends").isNull(), F.array(own)).otherwise(F.array(own, copy)))
    dealt = sent.select("key", "body", F.xxhash64("body").alias("tie"), "row", places.alias("to"))
    # Digests are made once for each text, after the shuffle.
    dealt = dealt.repartition("to.at").withColumn("keys", digests(F.col("body"), longest))
    order = Window.partitionBy("to.at").orderBy("to.copy", F.desc("key"), "tie", "body")
    following = F.lead(F.struct("body", "keys")).over(order).alias("next")
    return dealt.select("row", "to", "body", "keys", following).where("not to.copy").select(
        "row", F.col("body").alias("text"), "keys", F.col("next.body").alias("next_text"), F.col("next.keys").alias("next_keys")
    )


def with_edit(docs: DataFrame, ranges: int | None = None, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_chars, edited, and the digests of the text, the edited text and the
    next text: the last half of the code points replaced by as many from the start of
    the next document, or all it has."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    pairs = with_next(docs, ranges, longest, ["doc_id"])
    known = pairs.select("row.doc_id", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited"), "keys", "next_keys")
    return known.withColumn("edited_keys", digests(F.col("edited"), longest))
