"""The corpus pipeline: each stage works on what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stockpilot.llm import line_dedup, ngram_join, packing, quality_rules, secret_scan
from stockpilot.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the plain limits or the outlier test reject go."""
    return quality_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: a line that several documents hold stays in one of them."""
    return line_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: what it finds is replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents with their places in sequences."""
    return packing.packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_poor),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Robust covariance, randomness tests and packing have no SQL form; tests compare
# each operator with brute force, and check what the chain keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
