import zlib

import numpy as np

from cases import ROWS, documents, empty, plain
from conftest import SF001
from stockpilot.llm import language_id, queries


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = queries.op4_language_id(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.98


def test_cases(spark):
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.language_id(documents(spark)).collect()}
    assert len(got) >= len(ROWS) - 2  # repeated rows give equal results
    for doc in (3, 4, 5):  # null, empty, no letter
        assert (doc, "und", 0.0) in got
    assert {lang for _, lang, _ in got} <= {"en", "fr", "de", "und"}
    assert language_id.language_id(empty(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    docs = plain(spark, ["some text", None]).selectExpr("*", "cast(null as string) lang")
    assert {(r["lang_pred"], r["score"]) for r in language_id.language_id(docs).collect()} == {("und", 0.0)}


def test_trigrams_and_vectors():
    keys, counts = language_id.trigrams("Ab, ab!")
    assert sorted(counts.tolist()) == [1, 2, 2]  # of " ab ab ": "b a" once, " ab" and "ab " twice
    v = language_id.Vectors(256, 1)
    a, b = v.gram(int(keys[0])), v.gram(int(keys[1]))
    assert abs(int(a.astype(int) @ b.astype(int))) < 80  # nearly orthogonal
    both = v.bundle(keys[:2], np.array([2, 3]))
    assert (both == 2 * a.astype(int) + 3 * b.astype(int)).all()


def test_prototypes_are_the_sum_of_their_texts(spark):
    texts = ["the cat sat", "the dog sat", "le chat dort"]
    labelled = spark.createDataFrame([("en", texts[0]), ("en", texts[1]), ("fr", texts[2])], "lang string, text string")
    got = language_id.prototypes(language_id.gram_counts(labelled), 128, 5)
    v = language_id.Vectors(128, 5)
    assert (got["en"] == sum(v.bundle(*language_id.trigrams(t)) for t in texts[:2])).all()
    assert (got["fr"] == v.bundle(*language_id.trigrams(texts[2]))).all()
