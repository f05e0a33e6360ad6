"""Exact deduplication with keyed streaming state.

Texts are equal when they are identical without ASCII white space.  A first
pass appends one entry per row to an ingest log: digest of the stripped text,
the integer ``doc_id``, the length of the original text and a content locator
(file and row number).  A Structured Streaming aggregation over that log keeps,
per digest and without expiry, the entry that stays and the number of rows; its
state lives on disk in RocksDB and is saved under the shared folder.  A caller that
names a folder keeps log and state there: the next call appends its documents to the
log, the stream goes on where it stopped, and the result holds all documents of the
log.  The log is read in ``batches`` micro-batches or more, so hits across batches go
through the state.  Entries of a digest are combined in each task before they are shuffled: a text that a third of all
rows hold leaves each task as one row.

The state is then read as a table.  On hits (digests of several rows) the full
bytes are compared: the smallest and the largest stripped text of a digest are
the same exactly when all are.  Digests whose bytes differ are grouped again by
their whole text.

Cases: a null text counts as empty; of equal texts the row with the most code
points stays, then the smallest ``doc_id`` (null last), then the first locator,
so that of fully repeated rows exactly one stays; an empty table gives an empty
result; further columns are not read.  The input must be read from files, which must
be parquet and stay where they are if a folder is kept; a document that is read
again from the same file counts again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpilot.llm.text import staged, text_or_empty
from stockpilot.session import scratch_path

WHITE_SPACE = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Logs take the disk they need: preallocation costs 4 MB for each partition of the state.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

RESULT = "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def ingest_log(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """digest, sha, doc_id, chars, file, at: one entry for each row."""
    place = docs.metadataColumn("_metadata")
    text = text_or_empty()
    read = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.length(text).alias("chars"),
        stripped(text).alias("body"),
        place["file_path"].alias("file"),
        place["row_index"].alias("at"),
    )
    return read.select(digest(F.col("body")).alias("digest"), sha256(F.col("body")).alias("sha"), "doc_id", "chars", "file", "at")


def rank() -> Column:
    """The entry that stays is the smallest."""
    return F.struct(
        (-F.col("chars")).alias("less"),
        F.col("doc_id").isNull().alias("last"),
        F.col("doc_id").alias("id"),
        F.col("file").alias("file"),
        F.col("at").alias("at"),
    )


def keep_state(spark: SparkSession, log_path: str, log: DataFrame, checkpoint: str, files_per_batch: int) -> None:
    """Bring the keyed state under ``checkpoint`` up to date with the log."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files_per_batch)
        groups = reader.parquet(log_path).groupBy("digest").agg(F.min(rank()).alias("stays"), F.count(F.lit(1)).alias("n"))
        query = (
            groups.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, stays, n: what the state holds."""
    state = spark.read.format("statestore").load(checkpoint)
    stays, n = state.schema["value"].dataType.fieldNames()
    return state.select(F.col("key.digest").alias("digest"), F.col(f"value.`{stays}`").alias("stays"), F.col(f"value.`{n}`").alias("n"))


def check_bytes(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """digest of the hits whose texts are not all the same bytes.
    hits: digest, file, at."""
    return (
        _texts(docs, hits)
        .groupBy("digest")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .where("low <> high")
        .select("digest")
    )


def _earlier(docs: DataFrame, log: DataFrame) -> DataFrame:
    """The documents of all files that the log names, as far as they are needed."""
    files = [r["file"] for r in log.select("file").distinct().collect()]  # paths, as Spark's own file list
    return docs.sparkSession.read.schema(docs.select(F.col("text").cast("string")).schema).parquet(*files)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The entries of ``wanted`` with their stripped text, found by locator."""
    place = docs.metadataColumn("_metadata")
    texts = docs.select(place["file_path"].alias("file"), place["row_index"].alias("at"), text_or_empty().alias("text"))
    return texts.join(wanted.hint("shuffle_hash"), ["file", "at"]).withColumn("body", stripped(F.col("text"))).drop("text")


def _decided(entries: DataFrame) -> DataFrame:
    kept = (F.col("file") == F.col("stays.file")) & (F.col("at") == F.col("stays.at"))
    return entries.select(
        "doc_id",
        F.col("stays.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 1, folder: str | None = None
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``, and for
    those of earlier calls with the same ``folder``."""
    spark = docs.sparkSession
    if folder is None:
        log_path, checkpoint = scratch_path(spark, "llm-ingest-log"), scratch_path(spark, "llm-dedup-state")
    else:
        log_path, checkpoint = f"{folder.rstrip('/')}/log", f"{folder.rstrip('/')}/state"
    entries = ingest_log(docs, digest)
    entries.write.mode("append").parquet(log_path)
    log = spark.read.schema(entries.schema).parquet(log_path)
    if log.isEmpty():
        return spark.createDataFrame([], RESULT)
    keep_state(spark, log_path, entries, checkpoint, max(1, len(log.inputFiles()) // batches))
    if folder is not None:
        docs = _earlier(docs, log)
    state = staged(read_state(spark, checkpoint), "dedup-state")
    hits = log.select("digest", "file", "at").join(state.where("n > 1").select("digest"), "digest")
    differing = staged(check_bytes(docs, hits), "differing-digests")
    if differing.isEmpty():
        return _decided(log.join(state, "digest"))
    plain = log.join(state, "digest").join(differing, "digest", "left_anti")
    mixed = staged(_texts(docs, log.join(differing, "digest")), "differing-texts")
    split = mixed.groupBy("digest", "body").agg(F.min(rank()).alias("stays"), F.count(F.lit(1)).alias("n"))
    return _decided(plain).unionByName(_decided(mixed.join(split, ["digest", "body"])))
