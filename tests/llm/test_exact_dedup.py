import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents, empty
from conftest import SF0001
from stockpilot.llm import exact_dedup, queries


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        text = r[1] or ""
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        groups[body].append((-len(text), r[0] is None, r[0] or 0))
    out = []
    for body, own in groups.items():
        own.sort()
        keep = None if own[0][1] else own[0][2]
        for i, (_, none, doc) in enumerate(own):
            out.append((None if none else doc, keep, len(own), i == 0, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def stored(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "docs"))
    return spark.read.schema(df.schema).parquet(str(tmp_path / "docs"))


def test_cases_against_brute_force(spark, tmp_path):
    got = exact_dedup.exact_dedup(stored(spark, documents(spark), tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_digests_that_collide_are_told_apart_by_their_bytes(spark, tmp_path):
    def weak(body):
        return F.unhex(F.when(F.length(body) % 2 == 0, "00").otherwise("01"))

    got = exact_dedup.exact_dedup(stored(spark, documents(spark), tmp_path), digest=weak).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_several_batches(spark, tmp_path):
    docs = stored(spark, documents(spark).repartition(4), tmp_path)
    got = exact_dedup.exact_dedup(docs, batches=4).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def weak_digest(body):
    return F.unhex(F.when(F.length(body) % 2 == 0, "00").otherwise("01"))


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak_digest])
def test_halves_in_turn_equal_the_whole(spark, tmp_path, digest):
    """State and log outlive a call; copies of earlier documents meet them there."""
    rows = [*ROWS, (20, ROWS[0][1], "en", "s9"), (0, " " + ROWS[9][1] + " \n", "en", "s9")] if ROWS[9][1] else [*ROWS, (20, ROWS[0][1], "en", "s9")]
    folder, calls = str(tmp_path / "kept"), [rows[:6], rows[6:11], rows[11:]]
    for i, part in enumerate(calls):
        documents(spark, part).repartition(2).write.parquet(str(tmp_path / f"docs{i}"))
        got = exact_dedup.exact_dedup(spark.read.parquet(str(tmp_path / f"docs{i}")), digest, batches=2, folder=folder).collect()
        assert sorted(map(tuple, got), key=str) == brute([r for p in calls[: i + 1] for r in p])


def test_log_is_read_in_batches(spark, tmp_path):
    docs = stored(spark, documents(spark).repartition(6), tmp_path)
    exact_dedup.exact_dedup(docs, batches=3, folder=str(tmp_path / "kept"))
    assert len([f for f in (tmp_path / "kept" / "state" / "commits").iterdir() if f.name.isdigit()]) >= 3


def test_no_documents(spark, tmp_path):
    assert exact_dedup.exact_dedup(stored(spark, empty(spark), tmp_path)).count() == 0


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op10_exact_dedup(spark, SF0001).collect()), key=str) == brute(rows)


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    plan = exact_dedup.ingest_log(docs, exact_dedup.sha256)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
