import importlib
import sys

import corpus_pipeline
from cases import documents, empty
from conftest import SF0001
from stockpilot.llm import queries


def run_stages(spark, docs, tmp_path):
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, "unused")
        path = str(tmp_path / f"{i}-{name}")
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        seen.append((name, docs.schema.names, docs.count()))
    return seen, docs


def test_stages_take_the_cases(spark, tmp_path):
    docs = documents(spark)
    seen, packed = run_stages(spark, docs, tmp_path)
    assert [name for name, _, _ in seen] == ["quality_rules", "line_dedup", "ngram_join", "secret_scan", "packing"]
    for _, columns, rows in seen[:-1]:
        assert columns == docs.schema.names and rows <= docs.count()
    assert packed.count() > 0


def test_stages_take_no_documents(spark, tmp_path):
    seen, packed = run_stages(spark, empty(spark), tmp_path)
    assert all(rows == 0 for _, _, rows in seen) and packed.count() == 0


def test_run_packs_what_the_stages_kept(spark):
    packed = corpus_pipeline.run(spark, SF0001)
    total = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    ids = {r["doc_id"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id").collect()}
    assert total and all(r["sum(length)"] == r["max(doc_tokens)"] and r["doc_id"] in ids for r in total)


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_entry_without_the_package(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "stockpilot.llm" else real(name, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert not any(n.startswith("op") and n[2].isdigit() for n in entry.queries()) and "pipeline" not in entry.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__")
