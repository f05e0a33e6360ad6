import hashlib
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents, empty, plain
from conftest import SF0001
from stockpilot.llm import fingerprints, queries
from stockpilot.llm.fingerprints import Version, compare, difference, digests, likeness, numbered, with_edit, with_next


def parts_of(text, longest=120):
    """The paragraphs by plain Python."""
    found = []
    for line in (text or "").split("\n"):
        for sentence in [line] if len(line) <= longest else re.split(r"(?<=[.!?])[\x20\x09-\x0d]+", line):
            if len(sentence) <= longest:
                found.append(sentence)
                continue
            part = []
            for word in re.split(r"[\x20\x09-\x0d]+", sentence):
                part.append(word)
                if zlib.crc32(word.encode()) % 8 == 0:
                    found.append(" ".join(part))
                    part = []
            found.append(" ".join(part))
    found = [p.strip(" \t\n\x0b\x0c\r") for p in found]
    return [p for p in found if p]


def set_of(text):
    seen, found = Counter(), set()
    for p in parts_of(text):
        seen[p] += 1
        found.add((p, seen[p]))
    return found


def near(a, b):
    one, two = set_of(a), set_of(b)
    return len(one & two) / len(one | two) if one | two else 1.0


def random_text(rng, lines):
    return "\n".join(" ".join(rng.choice("ab cd efg hij klm nopq. rst! uvw".split()) for _ in range(rng.randint(0, 60))) for _ in range(lines))


@pytest.mark.parametrize("seed", range(6))
def test_difference_against_sets(seed):
    rng = random.Random(seed)
    for _ in range(60):
        shared = [rng.getrandbits(64) for _ in range(rng.randint(0, 400))]
        old = shared + [rng.getrandbits(64) for _ in range(rng.choice([0, 1, 5, 60, 900]))]
        new = shared + [rng.getrandbits(64) for _ in range(rng.choice([0, 1, 5, 60, 900]))]
        a, b = Version(old), Version(new)
        lost, gained, cells = difference(a, b)
        assert sorted(lost) == sorted(set(old) - set(new)) and sorted(gained) == sorted(set(new) - set(old))
        union = set(old) | set(new)
        assert likeness(a, b, len(lost) + len(gained)) == (len(set(old) & set(new)) / len(union) if union else 1.0)
        assert cells >= fingerprints.CELLS


def test_small_sketches_fail_and_larger_ones_succeed():
    rng = random.Random(3)
    a, b = Version([rng.getrandbits(63) for _ in range(500)]), Version([])
    assert (a.sketch(24) - b.sketch(24)).peel(500) is None
    lost, gained, cells = difference(a, b)
    assert sorted(lost) == sorted(a.keys) and not gained and cells > 500


def test_repeated_paragraphs_count():
    same = Version([-5, 7, -5])
    assert len(set(same.keys)) == 3 and same.keys == numbered([-5, 7, -5])
    lost, gained, _ = difference(same, Version([7, -5]))
    assert len(lost) == 1 and not gained
    assert same.sketch(24).text() == Version([7, -5, -5]).sketch(24).text()


def test_paragraphs(spark):
    rng = random.Random(5)
    line = " ".join("%06x" % rng.getrandbits(24) for _ in range(400))
    texts = ["", " \n\t\n", line, "new words before " + line, "One. Two! Three", "x" * 500, random_text(rng, 40), "a\nb\n a", "Aé. " * 60]
    rows = plain(spark, texts).select("doc_id", fingerprints.paragraphs(F.col("text")).alias("p"), digests(F.col("text")).alias("k")).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(texts):
        assert got[i]["p"] == parts_of(text) and len(got[i]["k"]) == len(got[i]["p"])
    assert set(got[3]["p"]) >= set(got[2]["p"][1:]) and len(got[2]["p"]) > 20
    assert got[7]["k"][0] == got[7]["k"][2]


def in_order(rows):
    """Rows by descending id, null last."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


@pytest.mark.parametrize("ranges", [1, 3, 7, 64])
def test_next_document(spark, ranges):
    texts = [f"text {i}" for i in range(100)]
    docs = plain(spark, texts).where("doc_id % 7 <> 3").repartition(5)
    ids = sorted((r["doc_id"] for r in docs.collect()), reverse=True)
    got = {r["text"]: r["next_text"] for r in with_next(docs, ranges).collect()}
    assert got == {texts[a]: texts[b] for a, b in zip(ids, ids[1:] + ids[:1])}


@pytest.mark.parametrize("ranges", [1, 4])
def test_next_of_repeated_and_null_ids(spark, ranges):
    docs = documents(spark)
    rows = with_next(docs, ranges).collect()
    assert len(rows) == len(ROWS)
    bodies = sorted(r[1] or "" for r in ROWS)
    assert sorted(r["text"] for r in rows) == sorted(r["next_text"] for r in rows) == bodies
    by_id = {}
    for r in ROWS:
        by_id.setdefault(r[0], set()).add(r[1] or "")
    ids = in_order([(i,) for i in by_id])
    follows = {a[0]: by_id[a[0]] | by_id[b[0]] for a, b in zip(ids, ids[1:] + ids[:1])}
    assert all(r["next_text"] in follows[r["row"]["doc_id"]] for r in rows)


def test_single_document_follows_itself(spark):
    one = documents(spark, [(5, "abc", "en", "s0")])
    assert [(r["text"], r["next_text"]) for r in with_next(one).collect()] == [("abc", "abc")]


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    rows.sort(reverse=True)
    got = {r["doc_id"]: r for r in queries.op12_fingerprints(spark, SF0001).collect()}
    assert len(got) == len(rows)

    prints = {}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following, r = text or "", following or "", got[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == (near(text, edited), near(text, following))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.8 * len(got)


def test_compare_gives_the_digests(spark):
    rng = random.Random(1)
    old = random_text(rng, 300)
    new = old.replace("ab", "AB", 3) + "\nan added line"
    texts = spark.createDataFrame([(1, old, new), (2, "", ""), (3, "a", "")], "row int, old string, `new` string")
    rows = texts.withColumn("a", digests(F.col("old"))).withColumn("b", digests(F.col("new")))
    keys = {r["row"]: (numbered(r["a"]), numbered(r["b"])) for r in rows.collect()}
    got = {r["row"]["row"]: r for r in compare(rows, "a", ["b"]).collect()}
    signed = lambda keys: sorted(k - (1 << 64) if k >> 63 else k for k in keys)
    a, b = map(set, keys[1])
    assert sorted(got[1]["b"]["lost"]) == signed(a - b) and sorted(got[1]["b"]["gained"]) == signed(b - a)
    assert got[1]["b"]["likeness"] == near(old, new)
    assert got[2]["b"]["likeness"] == 1.0 and got[2]["fingerprint"] == got[2]["b"]["fingerprint"]
    assert got[3]["b"]["likeness"] == 0.0
    assert compare(rows.limit(0), "a", ["b"]).count() == 0


def test_long_text(spark):
    text = " ".join("word%d" % (i * i % 9973) for i in range(300_000))
    r = compare(with_edit(plain(spark, [text, "short"])), "keys", ["edited_keys", "next_keys"], full=False).where("row.n_chars > 10").first()
    assert 0.45 < r["edited_keys"]["likeness"] < 1 and r["next_keys"]["likeness"] == 0.0


def test_no_documents(spark):
    assert with_edit(empty(spark)).count() == 0


def versions(lists):
    return fingerprints.Versions(np.array(sum(lists, []), np.uint64), np.cumsum([0, *map(len, lists)]))


def random_pairs(rng, n, sizes):
    pairs = []
    for _ in range(n):
        shared, old, new = ([rng.getrandbits(64) for _ in range(rng.choice(sizes))] for _ in range(3))
        pairs.append((shared + old + shared[:2] * rng.randint(0, 2), shared + new))
    return pairs


@pytest.mark.parametrize("cells", [1, 24 * 64, 1 << 18])
def test_many_pairs_at_once_against_sets(monkeypatch, cells):
    monkeypatch.setattr(fingerprints, "MOST_CELLS", cells)
    pairs = random_pairs(random.Random(7), 300, (0, 0, 1, 6, 40, 300))
    old, new = (versions([p[i] for p in pairs]) for i in (0, 1))
    used, rows, keys, second = fingerprints.differences(old, new)
    lost, gained = ({i: set() for i in range(len(pairs))} for _ in range(2))
    for row, key, later in zip(rows.tolist(), keys.tolist(), second.tolist()):
        (gained if later else lost)[row].add(key)
    near = likeness(old, new, np.bincount(rows, minlength=len(pairs)))
    for i, (a, b) in enumerate(pairs):
        one, two = set(numbered(a)), set(numbered(b))
        assert lost[i] == one - two and gained[i] == two - one and used[i] == difference(Version(a), Version(b))[2]
        assert near[i] == (len(one & two) / len(one | two) if one | two else 1.0)
        assert old.sketch(24).texts()[i] == Version(a).sketch(24).text()
    assert len(rows) == sum(map(len, lost.values())) + sum(map(len, gained.values()))


def test_groups_hold_all_rows(monkeypatch):
    monkeypatch.setattr(fingerprints, "GROUP", 10)
    for sizes in ([], [0], [0, 0], [3, 30, 0, 1, 9, 9, 0, 0, 100], [1] * 35):
        groups = list(fingerprints._groups(np.array(sizes, np.int64)))
        assert [i for a, b in groups for i in range(a, b)] == list(range(len(sizes)))
        assert all(sum(sizes[a : b - 1]) <= 10 + max(sizes) for a, b in groups)


def test_work_is_done_by_arrays_and_not_by_digest():
    pairs = random_pairs(random.Random(8), 500, (10, 20, 30))
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        old, new = (versions([p[i] for p in pairs]) for i in (0, 1))
        old.sketch(24).texts()
        fingerprints.differences(old, new)
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 20 * len(pairs)


def test_compared_lists_are_those_of_single_pairs(spark):
    rng = random.Random(9)
    pairs = random_pairs(rng, 40, (0, 1, 6, 40))
    signed = lambda keys: [k - (1 << 64) if k >> 63 else k for k in keys]
    rows = spark.createDataFrame([(i, signed(a), signed(b)) for i, (a, b) in enumerate(pairs)], "id int, a array<long>, b array<long>")
    got = {r["row"]["id"]: r for r in compare(rows, "a", ["b"], columns=["id"]).collect()}
    assert len(got) == len(pairs)
    for i, (a, b) in enumerate(pairs):
        lost, gained, cells = difference(Version(a), Version(b))
        assert got[i]["b"]["lost"] == signed(sorted(lost)) and got[i]["b"]["gained"] == signed(sorted(gained))
        assert got[i]["b"]["cells"] == cells and got[i]["fingerprint"] == Version(a).sketch(24).text()
