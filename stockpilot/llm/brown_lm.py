"""Class-based bigram language model with exchange clustering.

P(word | previous) = P(class | class of previous) P(word | class).  Words begin in
classes by how they end; the end of a text is a class of its own.  Every word that
occurs ``MOVED`` times or more is exchanged: it moves to the class that gives the class
bigrams of the training texts the highest likelihood.

1. Each task counts its words, Spark adds the counts up.  Words that occur often
   enough are numbered by frequency.
2. Texts are coded once as numbers: (number << 6) | ending, the number being -1 for
   rarer words.  The ``HEAD`` most frequent words are looked up where texts are read, the
   others meet their numbers in a shuffle join, one row for each text and word; no
   such word has more than one part in ``HEAD`` of all tokens, so none is hot.
3. The ``EXCHANGED`` most frequent words, which would be hot below, are exchanged on the
   driver, one after the other, on the table of the pairs of symbols (these words and
   the endings, a size the parameters bound).
4. All other words are exchanged on Spark.  Their contexts (the codes before and after
   every occurrence) are shuffled once, by word, in packed blocks; words of more than
   ``SPLIT`` occurrences are spread over all blocks and meet as sums for each class.  A
   sweep looks up the classes of all contexts, adds up each word's neighbours and picks
   its best class inside the tasks.  Half of the words move at a time, against a fixed
   table; the table is counted again from the texts, and if the likelihood fell, these
   moves are taken back and the sweeps end: it never falls.

Classes are kept by number in an array of ``TABLE`` bytes at most.  Words beyond it (the
rarest, in very large corpora) stand in their neighbours' counts by their endings, and
are exchanged themselves once, after the sweeps; a join brings their classes to the
texts.  Only tables that the parameters bound reach the driver.

Every word keeps its own count: emissions are (count + 0.1) / (class total + 0.1
(words in the class + 1)), transitions are smoothed towards the classes' shares.

Cases: a null text is empty and has the end token only; rows that repeat a
``doc_id`` are counted and scored each; words that tie in frequency are numbered by
their bytes, classes that tie in likelihood go to the first, and a word that gains
nothing stays; without training texts every token has the same chance; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.language_id import remainder
from stockpilot.llm.ordering import ranked
from stockpilot.llm.text import Staging, batch_rows, lower_bytes, map_partitions

FOLDS, HELD_OUT = 10, 0
ADD = 0.1
HEAD = 200_000
EXCHANGED = 1024
#: How often a word occurs at least that leaves the class of its ending.
MOVED = 3
CLASSES = 64
SWEEPS = 6
#: Sweeps over all other words, two halves each.
FULL_SWEEPS = 2
ENDINGS = 48
PULL = 5.0
FLUSH = 300_000
#: Words whose classes are at hand in every task, one byte each.
TABLE = 1 << 24
#: Occurrences of a word beyond which its contexts are spread over all blocks.
SPLIT = 1 << 22
#: Contexts that a task gathers before it hands them on, and those of a block.
GATHERED, BLOCK = 1 << 19, 1 << 17
#: Blocks that a task is given at once, and rows while contexts are dealt.
BLOCKS, DEALT = 16, 200
#: Contexts of a bucket, about.
BUCKET = 1 << 20

# A code is (number << BITS) | ending; the number is -1 for words without one, and
# the ending LAST with it is the end of a text.
BITS = 6
LAST = (1 << BITS) - 1
END = -1
BY_ENDING = 255  # in the table of classes: the class of the word's ending

_LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha())


def ending(word: bytes) -> int:
    """The first class of a word outside of the exchanged ones."""
    if word.translate(None, _LETTERS) == word:
        return 0  # no letter
    return 1 + zlib.crc32(word[-2:]) % (ENDINGS - 1)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, ending, n over all texts."""

    def run(batches):
        counts: Counter = Counter()

        def flush() -> dict:
            words = list(counts)
            out = {"word": words, "ending": [ending(w) for w in words], "n": list(counts.values())}
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                counts.update(lower_bytes(text.as_py()).split())
                if len(counts) > FLUSH:
                    yield flush()
        yield flush()

    each = map_partitions(texts, run, "word binary, ending int, n bigint")
    return each.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def numbered(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary with ``number``: the rank by frequency, null for rare words."""
    often = vocabulary.where(F.col("n") >= MOVED).select(F.lit("").alias("all"), (-F.col("n")).alias("less"), "word", "ending", "n")
    found = ranked(often, "all", ["less", "word"]).select("word", "ending", "n", F.col("rank").alias("number"))
    rare = vocabulary.where(F.col("n") < MOVED).select("word", "ending", "n", F.lit(None).cast("bigint").alias("number"))
    return found.unionByName(rare)


def head_words(vocabulary: DataFrame, most: int) -> list[tuple[bytes, int, int, int | None]]:
    """(word, ending, n, number) of the most frequent words, at most ``most``."""
    place = F.floor(8 * F.log2("n"))
    bins = vocabulary.groupBy(place.alias("bin")).count().orderBy(F.desc("bin")).collect()  # a few hundred rows
    total, least = 0, None
    for r in bins:
        total += r["count"]
        if total > most:
            break
        least = r["bin"]
    if least is None:
        return []
    found = vocabulary.where(place >= least).collect()
    return [(bytes(r["word"]), r["ending"], r["n"], r["number"]) for r in found]


@dataclass(frozen=True)
class Head:
    """The most frequent words: their codes, and log10 of their smoothed counts."""

    words: list[bytes]
    codes: np.ndarray
    logs: np.ndarray

    @classmethod
    def of(cls, found: list[tuple[bytes, int, int, int | None]], dtype: type) -> Head:
        codes = [((-1 if number is None else number) << BITS) | e for _, e, _, number in found]
        counts = np.array([n for _, _, n, _ in found], dtype=np.float64)
        return cls([w for w, _, _, _ in found], np.array(codes, dtype=dtype), np.log10(counts + ADD))


CODED = (
    "id bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, "
    "codes binary, rest string, times array<int>"
)
#: Rows that a task works on at once.
SLICE = 1000


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE))


def coded_heads(rows: DataFrame, head: Head) -> DataFrame:
    """Each text as codes but for its words outside of the head, which are listed in
    ``rest``: their codes, below -LAST - 1, hold place in the list and ending."""

    def run(batches):
        index = dict(zip(head.words, range(len(head.words))))
        first = TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            out: dict[str, list] = {k: [] for k in ("id", "n_tokens", "n_known", "logs", "codes", "rest", "times")}
            for text in batch.column("text"):
                words = lower_bytes(text.as_py()).split()
                places = np.fromiter(map(index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
                outside = np.flatnonzero(places < 0)
                rest = [words[i] for i in outside.tolist()]
                times = Counter(rest)
                at = dict(zip(times, range(len(times))))
                codes = head.codes[places] if len(head.words) else np.empty(len(words), dtype=head.codes.dtype)
                if rest:
                    which = np.fromiter(map(at.__getitem__, rest), dtype=np.int64, count=len(rest))
                    endings = np.fromiter(map(ending, times), dtype=np.int64, count=len(times))
                    codes[outside] = -2 * (LAST + 1) - (which << BITS | endings[which])
                out["id"].append(first)
                out["n_tokens"].append(len(words) + 1)
                out["n_known"].append(len(words) - len(rest))
                out["logs"].append(float(head.logs[places[places >= 0]].sum()))
                out["codes"].append(codes.tobytes())
                out["rest"].append(b" ".join(times).decode("utf-8", "surrogatepass"))
                out["times"].append(list(times.values()))
                first += 1
            yield out | {c: batch.column(c) for c in ("doc_id", "held_out")}

    return map_partitions(rows, run, CODED)


LINES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, line binary"


def coded_lines(coded: DataFrame, vocabulary: DataFrame, dtype: type) -> DataFrame:
    """All texts as codes, each with the end after it; ``logs`` is the sum of log10 of
    the words' smoothed counts."""
    pairs = F.arrays_zip(F.split("rest", " ").alias("word"), F.col("times").alias("times"))
    rest = coded.where("rest <> ''").select("id", F.posexplode(pairs).alias("at", "r"))
    rest = rest.select("id", "at", F.col("r.word").cast("binary").alias("word"), "r.times")
    found = rest.join(vocabulary.select("word", "n", "number"), "word", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    sums = found.groupBy("id").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(n + ADD)).alias("more_logs"),
        F.collect_list(F.when(F.col("number").isNotNull(), F.struct("at", "number"))).alias("numbers"),  # a text's own words
    )
    joined = coded.drop("rest", "times").join(sums, "id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"),
        "codes",
        "numbers",
    )

    def run(batches):
        for batch in sliced(batches):
            lines = []
            for codes, found in zip(batch.column("codes").to_pylist(), _pairs(batch.column("numbers"))):
                line = np.append(np.frombuffer(codes, dtype=dtype), np.array([END], dtype=dtype))
                outside = np.flatnonzero(line < -LAST - 1)
                places = -2 * (LAST + 1) - line[outside].astype(np.int64)
                numbers = np.full(int((places >> BITS).max()) + 1 if len(places) else 0, -1, dtype=np.int64)
                numbers[found[0]] = found[1]
                line[outside] = numbers[places >> BITS] << BITS | places & LAST
                lines.append(line.tobytes())
            yield {c: batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "logs")} | {"line": lines}

    return map_partitions(joined, run, LINES)


def _pairs(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two fields of the structs in each list; nothing for a null list."""
    flat = column.flatten()
    first, second = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    return ((first[a:b], second[a:b]) for a, b in zip([0, *ends], ends))


def flat_codes(lines: pa.BinaryArray, dtype: type, end: int = END) -> np.ndarray:
    """The codes of the texts, one after the other, an end before the first."""
    return np.concatenate((np.array([end], dtype=dtype), np.frombuffer(b"".join(lines.to_pylist()), dtype=dtype)))


def counted_pairs(lines: DataFrame, size: int, dtype: type, number, end: int = END) -> np.ndarray:
    """How often each of ``size`` numbers follows each in the training texts;
    ``number`` gives the numbers of codes."""

    def run(batches):
        total = np.zeros(size * size, dtype=np.int64)
        for batch in sliced(batches):
            of = number(flat_codes(batch.column("line"), dtype, end)).astype(np.int64)
            total += np.bincount(of[:-1] * size + of[1:], minlength=size * size)
        found = np.flatnonzero(total)
        yield {"pair": found, "n": total[found]}

    train = lines.where("not held_out").select("line")
    got = map_partitions(train, run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most size x size rows
    table = np.zeros(size * size, dtype=np.float64)
    table[got["pair"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    return table.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, exchanged: int, classes: int, sweeps: int) -> np.ndarray:
    """The class of every symbol: exchanged words move among ``classes``, each
    other symbol keeps a class of its own."""
    size = len(pairs)
    classes = min(classes, max(exchanged, 1))
    of = np.concatenate((np.arange(exchanged) % classes, classes + np.arange(size - exchanged))).astype(np.int64)
    total = classes + size - exchanged
    table = np.zeros((total, total))
    np.add.at(table, (of[:, None].repeat(size, 1), of[None, :].repeat(size, 0)), pairs)
    for _ in range(sweeps):
        moved = 0
        for word in range(exchanged):
            own = pairs[word, word]
            right, left = pairs[word].copy(), pairs[:, word].copy()
            right[word] = left[word] = 0
            after = np.bincount(of, weights=right, minlength=total)
            before = np.bincount(of, weights=left, minlength=total)
            now = of[word]
            table[now] -= after
            table[:, now] -= before
            table[now, now] -= own
            # Whatever class the word gets, its neighbours' classes have it beside them.
            rows, columns = table.sum(axis=1) + before, table.sum(axis=0) + after
            c = np.arange(classes)
            # Rows and columns of a class gain; its own cell, counted twice so far, is set right.
            gain = (_xlogx(table[:classes] + after) - _xlogx(table[:classes])).sum(axis=1)
            gain += (_xlogx(table[:, :classes] + before[:, None]) - _xlogx(table[:, :classes])).sum(axis=0)
            cell = table[c, c]
            gain -= _xlogx(cell + after[c]) + _xlogx(cell + before[c]) - 2 * _xlogx(cell)
            gain += _xlogx(cell + after[c] + before[c] + own) - _xlogx(cell)
            gain -= _xlogx(rows[:classes] + after.sum() + own) - _xlogx(rows[:classes])
            gain -= _xlogx(columns[:classes] + before.sum() + own) - _xlogx(columns[:classes])
            best = int(gain.argmax())
            if gain[best] <= gain[now] + 1e-9:
                best = now
            moved += best != now
            of[word] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += own
        if moved * 100 < exchanged:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, apart from what no class changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=1)).sum() - _xlogx(table.sum(axis=0)).sum())


def _growth(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return _xlogx(x + by) - _xlogx(x)


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # word, class, count; by word


class Chooser:
    """Picks the best classes, among the first ``classes`` and their own, of many
    words at once, each as if it alone moved."""

    KNOWN = 4  # counts whose growths are made beforehand

    def __init__(self, table: np.ndarray, classes: int):
        self.table, self.classes = table, classes
        self.rows, self.columns = table.sum(axis=1), table.sum(axis=0)
        # Growth of the cell of a candidate and a neighbour's class, by count.
        self.after = np.stack([_growth(table.T[:, :classes], k) for k in range(1, self.KNOWN + 1)])
        self.before = np.stack([_growth(table[:, :classes], k) for k in range(1, self.KNOWN + 1)])

    def _side(self, entries: Entries, table: np.ndarray, known: np.ndarray, other: np.ndarray, other_now: np.ndarray, now: np.ndarray, own: np.ndarray):
        """What the neighbours on one side add, by word and candidate, and for staying."""
        word, of, count = entries
        classes, words = self.classes, len(now)
        gains, stay = np.zeros((words, classes)), np.zeros(words)
        if not len(word):
            return gains, stay
        each = known[np.minimum(count, self.KNOWN) - 1, of]
        many = np.flatnonzero(count > self.KNOWN)
        each[many] = _growth(table[of[many], :classes], count[many, None])
        # The word itself is no neighbour of its class once it is taken out.
        here = of == now[word]
        each[here] = _growth(table[of[here], :classes] - other[word[here]], count[here, None])
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        gains[word[starts]] = np.add.reduceat(each, starts, axis=0)
        left = table[of, now[word]] - count - here * (other_now[word] + own[word])
        return gains, np.bincount(word, weights=_growth(left, count), minlength=words)

    def choose(self, now: np.ndarray, after: Entries, before: Entries, own: np.ndarray) -> np.ndarray:
        """The classes where the words go; after, before: how often each class
        stands beside a word, apart from the word itself (``own``)."""
        classes, words = self.classes, len(now)
        dense, beside, totals = [], [], []
        for word, of, count in (after, before):
            full = np.zeros((words, classes))
            inside = of < classes
            full[word[inside], of[inside]] = count[inside]
            dense.append(full)
            at_now = of == now[word]
            beside.append(np.bincount(word[at_now], weights=count[at_now], minlength=words))
            totals.append(np.bincount(word, weights=count, minlength=words) + own)
        (a, b), (a_now, b_now) = dense, beside
        gains, stay = self._side(after, self.table.T, self.after, b, b_now, now, own)
        more, more_stay = self._side(before, self.table, self.before, a, a_now, now, own)
        gains += more
        stay += more_stay
        # The cell of a class with itself was counted on both sides.
        cell = np.diag(self.table)[:classes]
        gains += _growth(cell, a + b + own[:, None]) - _growth(cell, a) - _growth(cell, b)
        cell = self.table[now, now] - a_now - b_now - own
        stay += _growth(cell, a_now + b_now + own) - _growth(cell, a_now) - _growth(cell, b_now)
        for sums, total in zip((self.rows, self.columns), totals):
            gains -= _growth(sums[:classes], total[:, None])
            stay -= _growth(sums[now] - total, total)
        inside = np.flatnonzero(now < classes)
        gains[inside, now[inside]] = stay[inside]
        best = gains.argmax(axis=1)
        return np.where(gains[np.arange(words), best] > stay + 1e-9, best, now)


@dataclass(frozen=True)
class Classes:
    """The classes of codes: ``of`` by number, else by ending."""

    of: np.ndarray  # uint8, by number; BY_ENDING where the ending decides
    endings: np.ndarray  # uint8, by the lower bits of a code
    size: int

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        found = self.endings[codes & LAST]
        number = codes >> BITS
        near = np.flatnonzero((number >= 0) & (number < len(self.of)))
        known = self.of[number[near]]
        found[near] = np.where(known == BY_ENDING, found[near], known)
        return found


def contexts(lines: DataFrame, exchanged: int, split: int, buckets: int, dtype: type) -> DataFrame:
    """own, before, after: codes of all occurrences of the numbered words from
    ``exchanged`` on in the training texts, and of their neighbours, in blocks of whole
    words sorted by ``own``.  Words with numbers below ``split`` are spread over all
    buckets and come in several blocks."""
    names = ("own", "before", "after")

    def deal(batches):
        part = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, ...]] = []

        def hand_on() -> dict:
            arrays = [np.concatenate(a) for a in zip(*held)]
            number = (arrays[0] >> BITS).astype(np.uint64)
            number += np.where(number < split, np.uint64(part + 1) << np.uint64(40), np.uint64(0))
            to = (number * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(to, kind="stable")
            found, starts = np.unique(to[order], return_index=True)
            held.clear()
            return {"bucket": found.astype(np.int64)} | {n: [x.tobytes() for x in np.split(a[order], starts[1:])] for n, a in zip(names, arrays)}

        gathered = 0
        for batch in sliced(batches):
            flat = flat_codes(batch.column("line"), dtype)
            at = np.flatnonzero(flat[1:-1] >> BITS >= exchanged) + 1
            held.append((flat[at], flat[at - 1], flat[at + 1]))
            gathered += len(at)
            if gathered > GATHERED:
                yield hand_on()
                gathered = 0
        if gathered:
            yield hand_on()

    def gather(batches):
        """Buckets come one after the other: sort each by word."""
        held: list[tuple[bytes, ...]] = []

        def blocks() -> Iterator[dict]:
            own, before, after = (np.frombuffer(b"".join(x), dtype=dtype) for x in zip(*held))
            held.clear()
            order = np.argsort(own, kind="stable")
            own, before, after = own[order], before[order], after[order]
            starts = np.append(np.flatnonzero(np.diff(own, prepend=own[0] - 1)), len(own))
            low = 0
            while low < len(own):
                high = int(starts[max(np.searchsorted(starts, low + BLOCK, side="right") - 1, np.searchsorted(starts, low, side="right"))])
                yield {n: [a[low:high].tobytes()] for n, a in zip(names, (own, before, after))}
                low = high

        last = None
        for batch in batches:
            for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *names))):
                if bucket != last and held:
                    yield from blocks()
                last = bucket
                held.append(tuple(row))
        if held:
            yield from blocks()

    train = lines.where("not held_out").select("line")
    dealt = map_partitions(train, deal, "bucket bigint, own binary, before binary, after binary")
    return map_partitions(
        dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket"), gather, "own binary, before binary, after binary"
    )


def _entries(word: np.ndarray, of: np.ndarray, size: int, count: np.ndarray | None = None) -> Entries:
    """(word, class, count) with equal pairs added up."""
    keys = word * size + of
    if count is None:
        keys, count = np.unique(keys, return_counts=True)
    else:
        order = np.argsort(keys, kind="stable")
        keys, count = keys[order], count[order]
    return keys // size, keys % size, count


#: Contexts whose gains are worked out at once.
AT_ONCE = 1 << 13

MOVES = "numbers binary, classes binary, endings binary"


def moves(blocks: DataFrame, classes: Classes, table: np.ndarray, among: int, take, split: int, dtype: type) -> DataFrame:
    """The words that leave their class, packed: numbers, new classes and endings.
    ``take`` picks the words that may move by their numbers."""
    size = classes.size

    def moved_of(own: np.ndarray, best: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, ...]:
        moved = best != now
        return (own[moved] >> BITS).astype(np.int64), best[moved].astype(np.uint8), (own[moved] & LAST).astype(np.uint8)

    def together(found: list[tuple[np.ndarray, ...]]) -> Iterator[dict]:
        if found:
            yield {n: [b"".join(x.tobytes() for x in arrays)] for n, arrays in zip(("numbers", "classes", "endings"), zip(*found))}

    def counted(own, before, after) -> tuple[np.ndarray, Entries, Entries, np.ndarray]:
        starts = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
        word = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(own)))
        follows, leads = after == own, before == own
        return (
            own[starts],
            _entries(word[~follows], classes(after[~follows]).astype(np.int64), size),
            _entries(word[~leads], classes(before[~leads]).astype(np.int64), size),
            np.bincount(word[follows], minlength=len(starts)),
        )

    def parts(batches) -> Iterator[tuple[np.ndarray, ...]]:
        """Occurrences of words that may move, some at a time, words kept whole."""
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("own", "before", "after"))):
                own, before, after = (np.frombuffer(x.as_buffer(), dtype=dtype) for x in row)
                kept = np.flatnonzero(take(own >> BITS))
                own, before, after = own[kept], before[kept], after[kept]
                starts = np.append(np.flatnonzero(np.diff(own, prepend=own[:1] - 1)), len(own))
                low = 0
                while low < len(own):
                    high = int(starts[max(np.searchsorted(starts, low + AT_ONCE, side="right") - 1, np.searchsorted(starts, low, side="right"))])
                    yield own[low:high], before[low:high], after[low:high]
                    low = high

    def whole(batches):
        chooser, moved = Chooser(table, among), []
        for own, before, after in parts(batches):
            inside = own >> BITS >= split
            if inside.any():
                words, *found = counted(own[inside], before[inside], after[inside])
                now = classes(words).astype(np.int64)
                moved.append(moved_of(words, chooser.choose(now, *found), now))
        yield from together(moved)

    if not split:
        return map_partitions(blocks, whole, MOVES)

    def sums(batches):
        """code, slot, n: neighbours of the words that are spread."""
        for own, before, after in parts(batches):
            inside = own >> BITS < split
            if inside.any():
                words, one, two, itself = counted(own[inside], before[inside], after[inside])
                code = np.concatenate((words[one[0]], words[two[0]], words))
                slot = np.concatenate((one[1], size + two[1], np.full(len(words), 2 * size)))
                yield {"code": code.astype(np.int64), "slot": slot, "n": np.concatenate((one[2], two[2], itself)).astype(np.int64)}

    summed = map_partitions(blocks, sums, "code bigint, slot bigint, n bigint").groupBy("code", "slot").agg(F.sum("n").alias("n"))
    gathered = summed.groupBy("code").agg(F.collect_list(F.struct("slot", "n")).alias("slots"))  # at most 2 x size + 1

    def spread(batches):
        chooser, moved = Chooser(table, among), []
        for batch in batches:
            words = batch.column("code").to_numpy()
            if not len(words):
                continue
            lists = list(_pairs(batch.column("slots")))
            word = np.repeat(np.arange(len(words)), [len(s) for s, _ in lists])
            slot, n = (np.concatenate([x[k] for x in lists]) for k in range(2))
            itself, one = slot == 2 * size, slot < size
            two = ~itself & ~one
            own = np.bincount(word[itself], weights=n[itself], minlength=len(words))
            now = classes(words).astype(np.int64)
            best = chooser.choose(now, _entries(word[one], slot[one], size, n[one]), _entries(word[two], slot[two] - size, size, n[two]), own)
            moved.append(moved_of(words, best, now))
        yield from together(moved)

    return map_partitions(blocks, whole, MOVES).unionByName(map_partitions(gathered, spread, MOVES))


def unpacked(rows: Iterable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = list(rows)
    return tuple(np.frombuffer(b"".join(bytes(r[c]) for r in rows), dtype=t) for c, t in (("numbers", np.int64), ("classes", np.uint8), ("endings", np.uint8)))


@dataclass
class Model:
    classes: Classes
    words_of: np.ndarray  # distinct training words of each class
    table: np.ndarray  # how often each class follows each
    far: DataFrame | None  # number, class of moved words beyond the table
    tokens: int
    ends: int
    distinct: int
    likelihoods: list[float]  # before the sweeps over all words and after each half


def learn(lines: DataFrame, vocabulary: DataFrame, ends: int, dtype: type, staging: Staging) -> Model:
    totals = vocabulary.groupBy("ending").agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.count("number").alias("numbered"), F.sum(F.when(F.col("n") > SPLIT, 1)).alias("split")
    )
    by_ending = {r["ending"]: r for r in totals.collect()}
    numbered_words = sum(r["numbered"] for r in by_ending.values())
    tokens = ends + sum(r["n"] for r in by_ending.values())
    distinct = (ends > 0) + sum(r["words"] for r in by_ending.values())
    split = sum(r["split"] or 0 for r in by_ending.values())
    exchanged = min(EXCHANGED, numbered_words)
    first = {r["number"]: (r["ending"], r["n"]) for r in vocabulary.where(F.col("number") < exchanged).collect()}  # at most EXCHANGED rows

    def symbol(codes: np.ndarray) -> np.ndarray:
        number = codes >> BITS
        return np.where((number >= 0) & (number < exchanged), number, exchanged + np.minimum(codes & LAST, ENDINGS))

    found = exchange(counted_pairs(lines, exchanged + ENDINGS + 1, dtype, symbol), exchanged, CLASSES, SWEEPS)
    size, among = int(found.max()) + 1, int(found[exchanged])
    endings = np.full(LAST + 1, found[-1], dtype=np.uint8)
    endings[:ENDINGS] = found[exchanged : exchanged + ENDINGS]
    of = np.full(min(numbered_words, TABLE), BY_ENDING, dtype=np.uint8)
    near = min(exchanged, len(of))
    of[:near] = found[:near]
    classes = Classes(of, endings, size)
    words_of = np.zeros(size)
    np.add.at(words_of, found[:exchanged], 1)
    for e, r in by_ending.items():
        words_of[among + e] += r["words"] - sum(x == e for x, _ in first.values())
    table = counted_pairs(lines, size, dtype, classes)
    likelihoods = [likelihood(table)]
    far = None
    if numbered_words > exchanged and among:
        occurrences = sum(r["n"] for r in by_ending.values()) - sum(n for _, n in first.values())
        spread = split if split > exchanged else 0
        buckets = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(occurrences) // BUCKET)
        spark = lines.sparkSession
        with batch_rows(spark, DEALT):
            blocks = staging.write(contexts(lines, exchanged, spread, buckets, dtype), "contexts")
        limit = len(of)
        for half in range(2 * FULL_SWEEPS):
            take = lambda number, half=half: (number % 2 == half % 2) & (number < limit)
            with batch_rows(spark, BLOCKS):
                packed = moves(blocks, classes, table, among, take, spread, dtype).collect()  # ten bytes a word of the table
            numbers, to, e = unpacked(packed)
            changed = of.copy()
            changed[numbers] = to
            tried = Classes(changed, endings, size)
            counted = counted_pairs(lines, size, dtype, tried)
            if likelihood(counted) < likelihoods[-1]:
                break
            was = np.where(of[numbers] == BY_ENDING, endings[e], of[numbers])
            np.add.at(words_of, to, 1)
            np.add.at(words_of, was, -1)
            of, classes, table = changed, tried, counted
            likelihoods.append(likelihood(table))
            if len(numbers) * 100 < limit:
                break
        if numbered_words > limit:
            with batch_rows(spark, BLOCKS):
                far = staging.write(far_classes(moves(blocks, classes, table, among, lambda number: number >= limit, spread, dtype)), "far-classes")
            for r in far.groupBy("class", "ending").count().collect():  # classes x endings
                words_of[r["class"]] += r["count"]
                words_of[among + r["ending"]] -= r["count"]
        staging.remove("contexts")
    return Model(classes, words_of, table, far, tokens, ends, distinct, likelihoods)


def far_classes(moved: DataFrame) -> DataFrame:
    """number, class, ending of the packed moves."""

    def run(batches):
        for batch in batches:
            rows = [dict(zip(("numbers", "classes", "endings"), r)) for r in zip(*(batch.column(c).to_pylist() for c in range(3)))]
            numbers, to, e = unpacked(rows)
            yield {"number": numbers, "class": to.astype(np.int32), "ending": e.astype(np.int32)}

    return map_partitions(moved, run, "number bigint, class int, ending int")


KEPT = ("doc_id", "held_out", "n_tokens", "n_known", "logs")


def class_lines(lines: DataFrame, classes: Classes, far: DataFrame, dtype: type) -> DataFrame:
    """The texts as classes, an end after each; ``far`` has the classes of words
    beyond the table."""
    limit = len(classes.of)

    def number(batches):
        first = TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            codes = (np.frombuffer(x, dtype=dtype) >> BITS for x in batch.column("line").to_pylist())
            found = [np.unique(x[x >= limit]) for x in codes]
            yield {c: batch.column(c) for c in (*KEPT, "line")} | {"id": np.arange(first, first + len(found)), "numbers": found}
            first += len(found)

    listed = map_partitions(lines, number, f"id bigint, {LINES}, numbers array<bigint>")
    wanted = listed.select("id", F.explode("numbers").alias("number")).join(far.select("number", "class"), "number")
    found = wanted.groupBy("id").agg(F.collect_list(F.struct("number", "class")).alias("found"))  # a text's own words

    def put(batches):
        for batch in sliced(batches):
            out = []
            for line, (numbers, to) in zip(batch.column("line").to_pylist(), _pairs(batch.column("found"))):
                codes = np.frombuffer(line, dtype=dtype)
                line = classes(codes)
                if len(numbers):
                    order = np.argsort(numbers)
                    numbers, to = numbers[order], to[order]
                    at = np.minimum(np.searchsorted(numbers, codes >> BITS), len(numbers) - 1)
                    line = np.where(numbers[at] == codes >> BITS, to[at], line).astype(np.uint8)
                out.append(line.tobytes())
            yield {c: batch.column(c) for c in KEPT} | {"line": out}

    return map_partitions(listed.drop("numbers").join(found, "id", "left"), put, LINES)


def transitions(table: np.ndarray) -> np.ndarray:
    """log10 of the chances of each class after each."""
    size = len(table)
    share = (table.sum(axis=0) + 1) / (table.sum() + size)
    return np.log10((table + PULL * share) / (table.sum(axis=1, keepdims=True) + PULL))


def brown_lm(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    staging = Staging(docs.sparkSession)
    out = remainder(folds) == held_out
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), F.col("text").cast("string").alias("text"))
    train = rows.where("not held_out").select("text")
    with batch_rows(docs.sparkSession, SLICE):
        vocabulary = staging.write(numbered(staging.write(word_counts(train), "word-counts")), "vocabulary")
        staging.remove("word-counts")
        most = vocabulary.agg(F.max("number")).first()[0] or 0
        dtype = np.int32 if most < TABLE else np.int64
        coded = staging.write(coded_heads(rows, Head.of(head_words(vocabulary, HEAD), dtype)), "coded-heads")
        lines = staging.write(coded_lines(coded, vocabulary, dtype), "lines")
        staging.remove("coded-heads")
        model = learn(lines, vocabulary, train.count(), dtype, staging)
        staging.remove("vocabulary")
        size, end, table, number = model.classes.size, END, model.table, model.classes
        if model.far is not None:
            end, number = int(number.endings[LAST]), np.asarray
            lines = staging.write(class_lines(lines, model.classes, model.far, dtype), "class-lines")
            staging.remove("lines", "far-classes")
            dtype = np.uint8
            table = counted_pairs(lines, size, dtype, number, end)
    chances = transitions(table)
    divisors = np.log10(table.sum(axis=0) + ADD * (model.words_of + 1))
    divisors[model.classes.endings[LAST]] = 0.0  # the end is its class's only word
    base_total = math.log10(model.tokens + ADD * (model.distinct + 1))
    base_end = math.log10(model.ends + ADD)
    train_tokens, end_known = model.tokens, model.ends > 0

    def run(batches):
        for batch in sliced(batches):
            of = number(flat_codes(batch.column("line"), dtype, end))
            each = chances[of[:-1], of[1:]] - divisors[of[1:]]
            starts = np.flatnonzero(of[:-1] == of[0])  # a text begins after each end
            logs, tokens = (batch.column(c).to_numpy() for c in ("logs", "n_tokens"))
            yield {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "n_tokens": tokens,
                "n_known": batch.column("n_known").to_numpy() + end_known,
                "train_tokens": np.full(len(tokens), train_tokens),
                "base_score": logs + base_end - tokens * base_total,
                "score": logs + (np.add.reduceat(each, starts) if len(tokens) else 0.0),
            }

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return map_partitions(lines, run, schema)
