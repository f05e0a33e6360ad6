"""One query for each operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpilot.llm import brown_lm, byte_bpe, chat_format, exact_dedup, fingerprints, language_id, line_dedup, merkle, ngram_join, packing, periodic_runs, quality_rules, secret_scan
from stockpilot.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.byte_bpe(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


# Fixed value: the conversation that the contract adds.
EXTRA_CONVERSATION = -7
EXTRA_TEXT = r"\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_CONVERSATION, turn, role, EXTRA_TEXT) for turn, role in enumerate(("user", "assistant"))], rows.schema
    )
    return chat_format.read_back(chat_format.chat_format(chat_format.threads(rows.unionByName(extra)), branches=1))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), columns=["doc_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *[f"stats.{c}" for c in base], "base_failed", "kept")


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.brown_lm(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"), columns=["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "row.doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.digest(F.col("base")), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_join(table(spark, sf_dir, "documents"))
    return joined.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), batches=3)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents")))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.with_edit(table(spark, sf_dir, "documents"))
    shown = pairs.withColumn("edited_sha256", F.sha2("edited", 256))
    compared = fingerprints.compare(shown, "keys", ["edited_keys", "next_keys"], columns=["doc_id", "n_chars", "edited_sha256"], full=False)
    return compared.select(
        "row.*",
        "fingerprint",
        F.col("edited_keys.fingerprint").alias("edited_fingerprint"),
        F.col("edited_keys.likeness").alias("near_edited"),
        F.col("next_keys.likeness").alias("near_next"),
        F.col("edited_keys.cells").alias("edited_cells"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = {c: F.col(c) for c in merkle.FIELDS} | {"text": F.when(broken, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    listed = merkle.manifest(docs, keep={"doc_id": F.col("doc_id"), "read": merkle.leaf(list(fields.values()))})
    folded = listed.withColumn("folded_root", merkle.fold(F.col("row.read")))
    proof = merkle.proof_digest().alias("proof_sha256")
    return folded.select("row.doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_byte_bpe,
        op3_chat_format,
        op4_language_id,
        op5_quality_rules,
        op6_brown_lm,
        op7_packing,
        op8_secret_scan,
        op9_ngram_join,
        op10_exact_dedup,
        op11_periodic_runs,
        op12_fingerprints,
        op13_merkle_manifest,
    )
}
