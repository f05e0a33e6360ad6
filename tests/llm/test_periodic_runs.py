import hashlib
import random
import zlib

import pytest

from cases import ROWS, documents, empty, plain
from conftest import SF0001
from stockpilot.llm import queries
from stockpilot.llm.periodic_runs import SquareCatcher, collapse, periodic_runs, primitive, with_periods


def brute_runs(words, min_words=24, min_exponent=3):
    """Every stretch that is equal ``q`` words apart, for every ``q``."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(min_words, min_exponent * q):
                stretch = words[start : start + length]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.append((start, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def found_runs(words, *limits):
    catcher = SquareCatcher(*limits)
    catcher.extend(words)
    return catcher.finish()


@pytest.mark.parametrize("seed", range(8))
def test_random_texts_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, letters = rng.randint(0, 140), rng.choice([1, 2, 2, 3, 5])
        words = [b"%d" % rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
            for i in range(a, rng.randint(a, n)):
                words[i] = words[a + (i - a) % p]
        for limits in ((24, 3), (1, 2)):
            runs = found_runs(words, *limits)
            assert runs == brute_runs(words, *limits)
            assert collapse(words, runs) == brute_collapsed(words, runs)


def test_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert found_runs(b, 2, 2) == brute_runs(b, 2, 2)


def test_words_may_come_one_by_one():
    words = [b"x", b"y", b"z"] * 40 + [b"end"] + [b"w"] * 30
    one = SquareCatcher()
    for w in words:
        one.extend([w])
    assert one.finish() == found_runs(words) == [(0, 120, 3), (121, 30, 1)]


def test_primitive():
    for n in range(1, 25):
        for bits in range(1 << min(n, 12)):
            w = [bits >> i & 1 for i in range(n)]
            assert primitive(w) == (not any(n % p == 0 and w[p:] == w[:-p] for p in range(1, n)))


def test_long_texts():
    words = [b"w%d" % (i % 5000) for i in range(400_000)]
    assert found_runs(words) == [(0, 400_000, 5000)]
    assert found_runs([b"a"] * 200_000) == [(0, 200_000, 1)]


def edited(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = edited(doc_id, text)
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, digest(listed.encode()), digest(brute_collapsed(words, runs)))


def test_query_against_brute_force(spark):
    got = queries.op11_periodic_runs(spark, SF0001).collect()
    assert sum(r["n_runs"] for r in got) > 10
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = {r["doc_id"]: tuple(r[c] for c in names) for r in got}
    assert len(found) == len(got) == len(rows)
    for r in rows:
        if len((r["text"] or "").split()) < 1500:  # brute force takes the square of the words
            assert found[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_cases(spark):
    docs = documents(spark, [*ROWS, (20, "ab cd " * 30, "en", "s0"), (20, "ab cd " * 30, "en", "s0")])
    got = periodic_runs(docs)
    assert got.schema["row"].dataType.names == docs.columns
    rows = got.collect()
    assert len(rows) == len(ROWS) + 2
    for r in rows:
        words = (r["row"]["text"] or "").encode().split()
        assert r["n_words"] == len(words)
        if len(words) < 1500:
            assert [tuple(x) for x in r["runs"]] == brute_runs(words)
            assert r["collapsed"].encode() == brute_collapsed(words, brute_runs(words))
    assert [r["collapsed"] for r in rows if r["row"]["doc_id"] == 20] == ["ab cd"] * 2
    assert {r["row"]["doc_id"]: r["runs"] for r in rows}[4] == []


def test_ties_rank_by_start(spark):
    text = " ".join(["a b"] * 20 + ["x"] + ["c"] * 20 + ["d"] * 20 + ["e e"] * 13)
    row = periodic_runs(plain(spark, [text, " ".join(["p q"] * 12 + ["z"] + ["r s"] * 12)])).collect()
    assert [tuple(r["best"]) for r in row] == [(81, 26, 1), (0, 24, 2)]


def test_edit_of_texts(spark):
    rows = spark.createDataFrame([(i, t) for i in range(300) for t in ("a b c d e f g h i j", " \n", None)], "doc_id bigint, text string")
    for r in with_periods(rows).collect():
        assert (r["text"] or "").encode().split() == edited(r["doc_id"], r["text"] if zlib.crc32(str(r["doc_id"]).encode()) % 10 else "a b c d e f g h i j") or not (r["text"] or "").strip()


def test_no_documents(spark):
    assert periodic_runs(empty(spark)).count() == 0
