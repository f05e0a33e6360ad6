"""Line deduplication across documents.

Lines are exploded with their position, normalised (white space stripped at
both ends, A-Z lower-cased) and hashed to 128 bits.  A key of at least
``min_chars`` code points that ``min_docs`` documents or more hold keeps its
lines in one document, the one with the smallest ``doc_id``; every other
document loses them.  The rest is put together again by position.

Only hashes and positions are shuffled by line.  The counts are combined before
the shuffle, so a line that a third of all documents hold leaves each task as
one row; the join back to the lines has two plain shuffled sides, which
adaptive execution splits where one key is hot.  The keys found are few beside the
lines: they go from the counts into that join, without files of their own for each
shuffle partition.  Whole texts move once, by document.

Cases: a null text is one empty line (and stays null in ``deduplicate``); rows
that repeat a ``doc_id`` count as one document, each row keeps its own lines;
a null ``doc_id`` counts as one document that sorts last; an empty table gives
an empty result; further columns of the input pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import SPACES, ascii_lower, packed, staged, text_or_empty

LAST_ID = 2**63 - 1


def _identified(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return packed(
        docs,
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("version"),
        text.alias("body"),
    )


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, version, pos, h1, h2: a row for each line whose key is long enough."""
    key = ascii_lower(F.btrim("line", F.lit(SPACES)))
    return (
        _identified(docs)
        .select("doc", "version", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
        .select("doc", "version", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(min_chars), F.reverse("key")).alias("h2"))
    )


def shared_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, owner: keys found in ``min_docs`` documents or more.

    Grouped by one struct, so that the join by h1 and h2 shuffles them anew."""
    keys = lines.groupBy(F.struct("h1", "h2").alias("key"))
    if min_docs == 2:  # two documents differ: no distinct count is needed
        counted = keys.agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner <> last")
    else:
        counted = keys.agg(F.min("doc").alias("owner"), F.count_distinct("doc").alias("n")).where(F.col("n") >= min_docs)
    return counted.select("key.h1", "key.h2", "owner")


def dropped_positions(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """doc, version, gone: the sorted positions each document loses."""
    return (
        lines.join(shared, ["h1", "h2"])
        .where("doc <> owner")
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """row (the input's columns), n_lines, n_dropped, kept: a row for each input row."""
    lines = staged(line_keys(docs, min_chars), "line-keys")
    drops = dropped_positions(lines, shared_keys(lines, min_docs)).hint("shuffle_hash")
    all_lines = F.split("body", "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
    kept = F.array_join(F.transform(rest, lambda i: F.get(all_lines, i)), "\n")
    return _identified(docs).join(drops, ["doc", "version"], "left").select(
        "row",
        F.size(all_lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(kept).alias("kept"),
    )


def deduplicate(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The documents with their remaining lines as text; ``n_chars`` follows."""
    done = line_dedup(docs, min_chars, min_docs)
    row = F.col("row").withField("text", F.when(F.col("row.text").isNotNull(), F.col("kept")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType))
    return done.select(row.alias("row")).select("row.*")
