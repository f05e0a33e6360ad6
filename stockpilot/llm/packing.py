"""Hierarchical multi-length packing.

Every document is encoded once and cut into full windows and a rest.  Pieces are
routed by length to tiers of context sizes.  What is packed where depends on the
number of pieces of each length alone, a table of at most ``window`` rows: the
driver plans on it, and the plan is a list of patterns ("so many sequences made
of pieces of these lengths"), of bounded size however large the corpus is.

The plan goes through the tiers from long to short.  A window is opened with the
longest piece and its gap filled with the longest pieces that fit, of its own
and of shorter tiers.  A window of a shorter tier counts only when it is filled
exactly (then it needs no padding); otherwise it grows to the next tier's size.
Long windows are padded.  Sequences of one size are dealt to step groups round
robin, so the groups of a size hold equally many tokens and equally little padding.

Each piece finds its place by its rank among the pieces of its length.  The pieces
(numbers only, no text or id) are dealt by ranges of length and origin, so that a
partition holds few lengths and a length, however common, is spread over as many
partitions as its share.  The rank is a count within the partition plus the number
of such pieces in earlier partitions: a table of at most one row for each partition
and one more for each length, which is counted from the pieces' lengths where it is
needed and broadcast to the pieces.

Cases: a null or empty text is one piece, the closing id alone; texts are encoded
whole; rows that repeat a ``doc_id`` are packed each on their own; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpilot.llm.byte_bpe import read_file
from stockpilot.llm.text import arrow_schema, map_batches, map_partitions, staged

WINDOW = 1024
TIERS = (1024, 512, 256, 128)
STEP_WINDOWS = 8
END_ID = 0

# Fixed value: the pattern of this family of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, nth bigint"
NUMBERED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, range int, nth bigint"
RESULT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window bigint, step_group bigint"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def tokenizer(data: bytes) -> tiktoken.Encoding:
    """The ids that the ``tokenizers`` library gives for a byte-level BPE file, by
    the same merges in the faster ``tiktoken``; strings of special tokens in a text
    become their ids, as there."""
    spec = json.loads(data)
    letter = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letter[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encoded_pieces(docs: DataFrame, vocabulary_path: str, window: int) -> DataFrame:
    """The pieces of each document, numbered per partition."""
    vocabulary = read_file(vocabulary_path)

    def run(batches):
        coder, part, nth = tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*coder.encode(text.as_py() or "", allowed_special="all"), END_ID], dtype="<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), part, nth))
                    nth += 1
            yield dict(zip(names, zip(*rows) if rows else [[]] * len(names)))

    names = [f.name for f in arrow_schema(PIECES)]
    return map_partitions(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), run, PIECES)


def numbered_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces by ranges of length, numbered per range and length.  Within a length
    ranges go by origin, which no two pieces share: equal lengths, ids and even equal
    rows never force pieces into one partition."""

    def run(batches):
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            nth = np.empty(len(lengths), dtype=np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                nth[at] = seen[length] + np.arange(len(at))
                seen[length] += len(at)
            kept = {c: batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            yield kept | {"range": np.full(len(lengths), part, dtype=np.int32), "nth": nth}

    return map_partitions(pieces.repartitionByRange("length", "part", "nth"), run, NUMBERED)


def plan_patterns(counts: dict[int, int], window: int, tiers: tuple[int, ...]) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of the pieces of a sequence, number of such sequences)].

    Each step uses up a length or leaves fewer of it than a pattern takes, so
    there are at most a few patterns for each length."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    sizes = sorted({*tiers, window})
    plan: list[tuple[tuple[int, ...], int]] = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        rest, lengths, total = left.copy(), [longest], longest
        rest[longest] -= 1
        limit = next(s for s in sizes if s >= longest)
        while True:
            fits = np.flatnonzero(rest[: limit - total + 1])
            if len(fits):
                piece = int(fits[-1])
                rest[piece] -= 1
                lengths.append(piece)
                total += piece
            elif total == limit or limit == window:
                break
            else:
                limit = next(s for s in sizes if s > limit)
        used = Counter(lengths)
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= times * n
        plan.append((tuple(lengths), times))
    return plan


def padded_size(total: int, window: int) -> int:
    """A sequence of a power of two stays; any other is padded to the window."""
    return total if total & (total - 1) == 0 else window


def places(plan: list[tuple[tuple[int, ...], int]], window: int) -> dict[str, np.ndarray]:
    """Rows of (length, from rank): pieces of a length from a rank on go to
    ``times`` sequences from ``sequence`` on, at ``offset``, then again further on."""
    rows, next_rank, sequence, dealt = [], Counter(), 0, Counter()
    for lengths, times in plan:
        size = padded_size(sum(lengths), window)
        offset = 0
        for length, n in Counter(lengths).items():  # equal lengths stand together: they were taken longest first
            rows.append((length, next_rank[length], times, sequence, offset, size, dealt[size]))
            next_rank[length] += n * times
            offset += n * length
        sequence += times
        dealt[size] += times
    names = ("length", "rank", "times", "sequence", "offset", "size", "nth")
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T)) | {"of_size": np.array([dealt[int(s)] for s in table[:, 5]], dtype=np.int64)}


def packing(
    docs: DataFrame,
    vocabulary_path: str,
    window: int = WINDOW,
    tiers: tuple[int, ...] = TIERS,
    step_windows: int = STEP_WINDOWS,
) -> DataFrame:
    """A row for each piece: where it comes from and where it stands."""
    pieces = staged(encoded_pieces(docs, vocabulary_path, window), "pieces")
    pieces = staged(numbered_pieces(pieces), "numbered-pieces")
    n = F.count(F.lit(1)).alias("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(n).collect()}  # at most ``window`` rows
    if not counts:
        return docs.sparkSession.createDataFrame([], RESULT)
    place = places(plan_patterns(counts, window, tiers), window)
    span = 1 << 40
    keys = place["length"] * span + place["rank"]
    earlier = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = pieces.groupBy("range", "length").agg(n)
    before = by_range.select("range", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most a row for each range and one for each length: never worth shuffling the pieces for.
    ranked = pieces.join(F.broadcast(before), ["range", "length"]).withColumn("rank", F.col("before") + F.col("nth"))

    def put(batch: pa.RecordBatch) -> dict:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(keys, length * span + rank, side="right") - 1
        past = rank - place["rank"][at]
        times, size = place["times"][at], place["size"][at]
        # Step groups of a size hold as many slots as ``step_windows`` windows.
        groups = -(-place["of_size"][at] * size // (step_windows * window))
        return {c: batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")} | {
            "sequence_id": place["sequence"][at] + past % times,
            "offset": place["offset"][at] + past // times * length,
            "window": size,
            "step_group": (place["nth"][at] + past % times) % np.maximum(groups, 1),
        }

    return map_batches(ranked, put, RESULT)
