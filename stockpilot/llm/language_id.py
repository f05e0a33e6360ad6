"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A
trigram's vector binds (multiplies) the vectors of its letters, each permuted
(rolled) by its place, and a text's vector bundles (adds) those of its trigrams.
A language's prototype bundles all training texts of that language.  Texts are
compared with the prototypes by cosine, after the mean direction of all
prototypes, what the languages share, is taken out of both.

Bundling is addition, so a prototype follows exactly from the trigram counts of
a language: these are counted in each task and summed by Spark, and the vectors
of the distinct trigrams are added up in integers.  The model (labels x
dimensions) is all that reaches the driver; its size does not depend on the
corpus.

Cases: a text that is null or has no letter is ``und`` with score 0, as is any
text when no training text has a language; null languages teach nothing; rows
that repeat count each; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import map_batches, map_partitions, staged

DIMENSIONS = 1024
SEED = 20240229
UNKNOWN = "und"
MAX_GRAMS = 20_000
FLUSH = 200_000

RESULT = "doc_id bigint, held_out boolean, lang_pred string, score double"
_SPACE = 32
_BITS = 21


def remainder(folds: int) -> Column:
    """crc32 of the document's id as text, modulo ``folds``; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


class Letters:
    """Which code points are letters, looked up in bulk."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        return cls.table[points]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text and their counts.  Letters are lower-cased;
    whatever is between two words is one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = Letters.of(points)
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    points = np.where(letter, points, _SPACE).astype(np.int64)
    first = np.empty(len(points), dtype=bool)
    first[0], first[1:] = letter[0], letter[1:] | letter[:-1]  # of several signs the first stays
    points = np.concatenate(([_SPACE], points[first], [_SPACE]))
    if points[-2] == _SPACE:
        points = points[:-1]
    return np.unique(points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:], return_counts=True)


class Vectors:
    """Vectors of trigrams, made when first met."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((MAX_GRAMS, dimensions), dtype=np.int8)

    def letter(self, point: int) -> np.ndarray:
        vector = self.letters.get(point)
        if vector is None:
            bits = np.random.default_rng((self.seed, point)).integers(0, 2, self.dimensions, dtype=np.int8)
            vector = self.letters[point] = 2 * bits - 1
        return vector

    def gram(self, key: int) -> np.ndarray:
        mask = (1 << _BITS) - 1
        a, b, c = key >> 2 * _BITS, key >> _BITS & mask, key & mask
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the vectors, each as often as counted."""
        total = np.zeros(self.dimensions, dtype=np.float64)
        for at in range(0, len(keys), MAX_GRAMS):
            part = keys[at : at + MAX_GRAMS].tolist()
            found = [self.rows.get(k) for k in part]
            missing = [k for k, row in zip(part, found) if row is None]
            if missing:
                if len(self.rows) + len(missing) > MAX_GRAMS:
                    self.rows.clear()
                    missing = part
                for k in missing:
                    row = self.rows[k] = len(self.rows)
                    self.table[row] = self.gram(k)
                found = [self.rows[k] for k in part]
            total += counts[at : at + MAX_GRAMS].astype(np.float32) @ self.table[found].astype(np.float32)
        return total


_vectors: dict[tuple[int, int], Vectors] = {}


def vectors(dimensions: int, seed: int) -> Vectors:
    """One table for each Python worker."""
    if (dimensions, seed) not in _vectors:
        _vectors[dimensions, seed] = Vectors(dimensions, seed)
    return _vectors[dimensions, seed]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, gram, n over all training texts. labelled: lang, text."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush() -> dict:
            rows = [(lang, k, n) for lang, own in counts.items() for k, n in own.items()]
            counts.clear()
            return dict(zip(("lang", "gram", "n"), zip(*rows) if rows else ([], [], [])))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                keys, n = trigrams(text.as_py())
                own = counts.setdefault(lang, Counter())
                for k, v in zip(keys.tolist(), n.tolist()):
                    own[k] += v
            if sum(map(len, counts.values())) > FLUSH:
                yield flush()
        yield flush()

    each = map_partitions(labelled, run, "lang string, gram bigint, n bigint")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def prototypes(grams: DataFrame, dimensions: int, seed: int) -> dict[str, np.ndarray]:
    """The prototype of each language, from its trigram counts."""

    def run(batches):
        table, sums = vectors(dimensions, seed), {}
        for batch in batches:
            keys, n = (batch.column(c).to_numpy() for c in ("gram", "n"))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                of = langs == lang
                own = sums.setdefault(lang, np.zeros(dimensions, dtype=np.int64))
                for k, v in zip(keys[of].tolist(), n[of].tolist()):
                    own += v * table.gram(k).astype(np.int64)
        rows = [(lang, i, v) for lang, own in sums.items() for i, v in enumerate(own.tolist())]
        yield dict(zip(("lang", "at", "v"), zip(*rows) if rows else ([], [], [])))

    parts = map_partitions(grams, run, "lang string, at int, v bigint")
    summed = parts.groupBy("lang", "at").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for r in summed.collect():  # labels x dimensions
        found.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["v"]
    return found


def language_id(docs: DataFrame, folds: int = 3, held_out: int = 1, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``."""
    out = remainder(folds) == held_out
    labelled = docs.where(~out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = staged(gram_counts(labelled.selectExpr("cast(lang as string) lang", "cast(text as string) text")), "language-grams")
    learned = prototypes(counts, dimensions, seed)
    names = sorted(lang for lang, v in learned.items() if v.any())
    units = np.array([learned[n] / np.linalg.norm(learned[n]) for n in names]).reshape(len(names), dimensions)
    shared = units.mean(axis=0) if len(names) > 1 else np.zeros(dimensions)
    shared = shared / (np.linalg.norm(shared) or 1.0)
    apart = units - np.outer(units @ shared, shared)
    norms = np.linalg.norm(apart, axis=1, keepdims=True)
    apart = apart / np.where(norms > 0, norms, 1.0)

    def run(batch: pa.RecordBatch) -> dict:
        table, langs, scores = vectors(dimensions, seed), [], []
        for text in batch.column("text"):
            keys, n = trigrams(text.as_py() or "")
            if not len(keys) or not names:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            own = table.bundle(keys, n)
            own = own - (own @ shared) * shared
            cosines = apart @ (own / (np.linalg.norm(own) or 1.0))
            best = int(cosines.argmax())
            langs.append(names[best])
            scores.append(float(min(1.0, max(0.0, cosines[best]))))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": langs, "score": scores}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, RESULT)
