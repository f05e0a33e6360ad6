"""Periodic runs of words: passages that repeat themselves with a period.

A run is a longest stretch of consecutive words that are equal ``period`` words
apart, ``period`` being its smallest one.  Runs are found online, word by word, by
catching squares (a passage followed at once by itself):

* Every completed block of 2^k words that starts at a multiple of 2^k becomes a
  catcher for squares of period 2^(k+1)-1 to 2^(k+2)-2: the first half of such a
  square holds an aligned block of 2^k words, which comes again one period later.
  Every period belongs to one k, and a block catches only while the words read lie
  within five of its lengths.
* Blocks are named by the names of their halves, so equal names mean equal words.
  An appended word names the suffixes of 2, 4, 8... words that equal a completed
  block, and stops at the first that equals none; in plain text that is the
  second.  A suffix that a live catcher knows is compared backwards, word by
  word, and becomes an open stretch; each appended word advances the comparison
  of every open stretch or closes it.
* Squares of one period that overlap are one open stretch: they merge into a run,
  reported when it closes, if it is long enough and its period is the smallest.
  A square inside an open run whose period divides its own is no news.

A text takes O(n log n) steps and memory in proportion to its words; texts are
independent, so Spark deals rows to tasks as they are read, without a shuffle.

Cases: a null or empty text, or one of white space only, has no words and no runs
and collapses to an empty text; repeated rows are judged each; runs that tie in
length over period rank by start, then period; an empty table gives an empty
result; further columns pass through inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import SPACES, map_batches, packed, text_or_empty, with_fields

MIN_WORDS = 24
MIN_EXPONENT = 3

RUN = "struct<start:bigint,length:bigint,period:bigint>"
FOUND = f"n_words bigint, runs array<{RUN}>, best {RUN}, collapsed string"

Run = tuple[int, int, int]


class SquareCatcher:
    """Reads words one after the other; ``runs`` holds (start, length, period) of
    the runs that have ended."""

    def __init__(self, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT):
        self.min_words, self.min_exponent = min_words, min_exponent
        self.words: list[int] = []
        self.runs: list[Run] = []
        self._ids: dict[bytes, int] = {}
        self._open: dict[int, int] = {}  # period -> start of the stretch that still goes on
        # By level k: names of blocks by the names of their halves, starts of the
        # live blocks of a name, and the names of the last 2^k suffixes of 2^k words
        # as (end, name), each found again 2^k words later.
        self._names: list[dict[tuple[int, int], int]] = [{}]
        self._blocks: list[list[list[int]]] = [[]]
        self._recent: list[list[tuple[int, int] | None]] = [[None]]

    def extend(self, words: Iterable[bytes]) -> None:
        ids, seen, opened, recent = self._ids, self.words, self._open, self._recent
        t = len(seen)
        before, last = (seen[-2] if t > 1 else -1), (seen[-1] if t else -1)
        for word in words:
            name = ids.setdefault(word, len(ids))
            seen.append(name)
            t += 1
            if opened:
                for period in [q for q in opened if seen[t - 1 - q] != name]:
                    self._close(period, t - 1)
            if name == last:
                self._catch(t - 2, 1, t)
            if name == before:
                self._catch(t - 3, 2, t)
            before, last = last, name
            level, half = 0, 1
            while True:
                slots = recent[level]
                slot = t & (half - 1)
                left = slots[slot]
                slots[slot] = (t, name)
                if left is None or left[0] != t - half:
                    break
                level += 1
                size = 2 * half
                if level == len(recent):
                    self._names.append({})
                    self._blocks.append([])
                    recent.append([None] * size)
                names = self._names[level]
                name = names.get((left[1], name), -1) if t & (size - 1) else names.setdefault((left[1], name), len(names))
                if name < 0:
                    break
                self._meet(level, size, name, t)
                half = size

    def _meet(self, level: int, size: int, name: int, t: int) -> None:
        """The last ``size`` words are the block ``name``: try its live catchers,
        and add one if the words are an aligned block themselves."""
        blocks = self._blocks[level]
        if name == len(blocks):
            blocks.append([])
        live = blocks[name]
        while live and live[0] < t - 5 * size + 2:
            live.pop(0)
        for block in live:
            if block <= t - 3 * size + 1:
                self._catch(block, t - size - block, t)
        if not t & (size - 1):
            live.append(t - size)

    def _catch(self, block: int, period: int, t: int) -> None:
        """The words from ``block`` come again ``period`` later, up to ``t``."""
        if period in self._open:
            return
        for q, start in self._open.items():
            if start <= block and period % q == 0:
                return
        words, start = self.words, block
        while start and words[start - 1] == words[start - 1 + period]:
            start -= 1
        self._open[period] = start

    def _close(self, period: int, end: int) -> None:
        start = self._open.pop(period)
        length = end - start
        if length >= max(self.min_words, self.min_exponent * period) and primitive(self.words[start : start + period]):
            self.runs.append((start, length, period))

    def finish(self) -> list[Run]:
        """All runs by start, then period, once the text has ended."""
        for period in list(self._open):
            self._close(period, len(self.words))
        return sorted(self.runs, key=lambda r: (r[0], r[2]))


def primitive(words: list[int]) -> bool:
    """Whether ``words`` are no power of a shorter passage."""
    n, left, factor = len(words), len(words), 2
    while left > 1:
        if factor * factor > left:
            factor = left
        if left % factor:
            factor += 1
            continue
        part = n // factor
        if words[part:] == words[:-part]:
            return False
        while left % factor == 0:
            left //= factor
    return True


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside of runs and the first period of each, joined by spaces.
    A word goes if any run holds it after that run's first period."""
    kept, at = [], 0
    for low, high in sorted((start + period, start + length) for start, length, period in runs):
        if low > at:
            kept += words[at:low]
        at = max(at, high)
    return b" ".join(kept + words[at:])


def best_run(runs: list[Run]) -> Run | None:
    """The run of the greatest length over period; ties: least start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def find_runs(text: str, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> tuple[list[bytes], list[Run]]:
    words = text.encode("utf-8", "surrogatepass").split()
    catcher = SquareCatcher(min_words, min_exponent)
    catcher.extend(words)
    return words, catcher.finish()


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """row, n_words, runs (by start, then period), best, collapsed for each row."""
    if min_exponent < 2:
        raise ValueError("a run holds a square: min_exponent is 2 at least")
    rows = packed(docs, text_or_empty().alias("body"))

    def judge(batch: pa.RecordBatch) -> dict:
        counts, found, best, collapsed = [], [], [], []
        for text in batch.column("body"):
            words, runs = find_runs(text.as_py(), min_words, min_exponent)
            counts.append(len(words))
            found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            top = best_run(runs)
            best.append(top and dict(zip(("start", "length", "period"), top)))
            collapsed.append(collapse(words, runs).decode("utf-8", "surrogatepass"))
        return {"row": batch.column("row"), "n_words": counts, "runs": found, "best": best, "collapsed": collapsed}

    return map_batches(rows, judge, with_fields(rows, "row", FOUND))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text, a tenth of the texts made periodic: where h = crc32(doc_id)
    is divisible by 10, word i from a on becomes word a + (i - a) % p, with g = h / 10,
    a = g % n and p = 1 + (n - a) / (3 + g % 8), n being the number of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    body = F.btrim(text_or_empty(), F.lit(SPACES))
    words = F.split(body, r"[\x20\x09-\x0D]+")
    g, n = F.floor(h / 10).cast("bigint"), F.size("words").cast("bigint")
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("bigint")
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get("words", source(i).cast("int"))), " ")
    return (
        docs.select("doc_id", "text", g.alias("g"), F.when((h % 10 == 0) & (body != ""), words).alias("words"))
        .withColumn("a", F.when(F.col("words").isNotNull(), F.col("g") % n))
        .withColumn("p", period)
        .select("doc_id", F.when(F.col("words").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
    )


def runs_text(runs: str = "runs") -> Column:
    """``start,length,period`` and a line feed for each run."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
