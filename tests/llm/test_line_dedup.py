import re
from collections import defaultdict

import duckdb

from cases import ROWS, documents, empty
from conftest import SF0001
from stockpilot.llm import line_dedup, oracle, queries

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def brute(rows, min_docs=2):
    last = 1 << 63
    held = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[key(line)].add(last if r[0] is None else r[0])
    out = []
    for r in rows:
        own = last if r[0] is None else r[0]
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < min_docs or min(held[key(x)]) == own]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_cases_against_brute_force(spark):
    got = line_dedup.line_dedup(documents(spark)).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_threshold_of_three_documents(spark):
    got = line_dedup.line_dedup(documents(spark), min_docs=3).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS, 3)


def test_documents_keep_their_columns(spark):
    docs = documents(spark)
    done = line_dedup.deduplicate(docs)
    assert done.schema.names == docs.schema.names
    rows = done.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_no_documents(spark):
    assert line_dedup.line_dedup(empty(spark)).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    want = con.sql("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + oracle.SQL["op1_line_dedup"] + ")").fetchall()
    got = queries.op1_line_dedup(spark, SF0001).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_shared_keys_go_into_the_join_without_files(spark, monkeypatch):
    """Only the line keys are written; both sides of their join are shuffled by the key,
    as adaptive execution needs to split a hot one."""
    written, staged = [], line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: written.append(name) or staged(df, name))
    assert line_dedup.line_dedup(documents(spark)).count() == len(ROWS)
    assert written == ["line-keys"]

    lines = staged(line_dedup.line_keys(documents(spark), 10), "line-keys")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = line_dedup.dropped_positions(lines, line_dedup.shared_keys(lines, 2))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(re.findall(r"Exchange hashpartitioning\(h1#\d+L, h2#\d+L, \d+\), ENSURE_REQUIREMENTS", plan)) == 2
