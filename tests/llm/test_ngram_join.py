import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ROWS, documents, empty, plain
from conftest import SF0001
from pyspark.sql import functions as F
from stockpilot.llm import ngram_join, queries
from stockpilot.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(min(5, len(words))))))


def brute(rows):
    """(doc_id, set size, component) of each row, all pairs of distinct sets compared."""
    sets = [shingles(text) for _, text in rows]
    distinct = list({s for s in sets if s})
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    place = {s: root(i) for i, s in enumerate(distinct)}
    lowest = defaultdict(list)
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            lowest[place[s]].append(doc)
    return sorted(((doc, len(s), (min(lowest[place[s]], default=None) if s else doc)) for (doc, _), s in zip(rows, sets)), key=str)


def joined(docs):
    return sorted(((r["doc"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(docs).collect()), key=str)


def test_cases(spark):
    assert joined(documents(spark)) == brute([(r[0], r[1]) for r in ROWS])
    assert ngram_join.ngram_join(empty(spark)).count() == 0


def corpus(rng):
    """Copies with some words changed, of all sizes; a passage that many share."""
    texts, passage = [], [f"p{i}" for i in range(40)]
    for size in [*range(1, 24), 60, 150, 400]:
        for _ in range(3):
            words = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
            for _ in range(4):
                copy = list(words)
                for _ in range(rng.choice((0, 1, 1, 2, max(1, size // 40)))):
                    copy[rng.randrange(size)] = f"x{rng.randint(0, 10**6)}"
                texts.append(" ".join(copy[: size - rng.choice((0, 0, 1))]))
    for i in range(60):
        texts.append(" ".join([*passage, *(f"t{i}_{j}" for j in range(rng.choice((2, 8, 12, 60))))]))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("list_cost", [0, 10, 10**6])
def test_all_sizes_against_brute_force(spark, monkeypatch, list_cost):
    """Whatever the boundary between the two ways is."""
    monkeypatch.setattr(ngram_join, "LIST_COST", list_cost)
    monkeypatch.setattr(ngram_join, "SMALL_MAX", 12)
    texts = corpus(random.Random(11))
    assert joined(plain(spark, texts)) == brute(list(enumerate(texts)))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.integers(0, 400))
def test_similar_sets_share_a_listed_shingle(a, b, shared):
    """The full prefix misses no similar pair, whichever shingles are frequent."""
    shared = min(shared, a, b)
    if 100 * shared < 75 * (a + b - shared):
        return
    rng = np.random.default_rng(a * 1000 + b)
    pool = np.unique(rng.integers(0, 2**63, a + b + 10, dtype=np.uint64))[: a + b - shared]
    rng.shuffle(pool)
    x, y = np.sort(pool[:a]), np.sort(pool[a - shared :])
    hot = np.sort(rng.choice(pool, len(pool) // 3, replace=False))
    assert set(ngram_join.prefix(x, hot).tolist()) & set(ngram_join.prefix(y, hot).tolist())
    if a <= 12 and b <= 12:
        assert shared >= ngram_join.needed(a, b) and b in ngram_join.partners(a) and a in ngram_join.partners(b)


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    kept = ngram_join.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, (1, 2, 3, 4, 5, 6, 6, None, None, 7, 9, 10, 11)))


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 460)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    want = {x: root(x) for x in list(parent)}
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op9_ngram_join(spark, SF0001).collect()), key=str) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(1, 300), st.integers(0, 300))
def test_parities_never_rule_out_a_similar_pair(a, b, shared):
    shared = min(shared, a, b)
    rng = np.random.default_rng(a * 1000 + b)
    pool = np.unique(rng.integers(0, 2**63, a + b + 10, dtype=np.uint64))[: a + b - shared]
    x, y = ngram_join.parities(pool[:a]), ngram_join.parities(pool[a - shared :])
    differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
    assert differ <= a + b - 2 * shared


def blocks(rng, pages, kinds=12, of=4, words=30):
    """Pages made of some of a few shared passages, and near copies of pages."""
    passages = [" ".join(f"b{k}_{i}" for i in range(words)) for k in range(kinds)]
    texts = [" ".join(rng.sample(passages, of)) for _ in range(pages)]
    for text in rng.sample(texts, pages // 5):
        copy = text.split()
        copy[rng.randrange(len(copy))] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("hot_max", [0, 200_000])
def test_crowded_lists_against_brute_force(spark, monkeypatch, hot_max):
    """Lists whose nodes are listed again under keys of several shingles."""
    monkeypatch.setattr(ngram_join, "LONG", 3)
    monkeypatch.setattr(ngram_join, "HOT_MAX", hot_max)
    again, seen = ngram_join.listed_again, []
    monkeypatch.setattr(ngram_join, "listed_again", lambda *a: seen.append(1) or again(*a))
    texts = blocks(random.Random(5), 150) + corpus(random.Random(12))[:200]
    assert joined(plain(spark, texts)) == brute(list(enumerate(texts)))
    assert seen


def test_similar_sets_share_a_key_of_several_shingles():
    rng = np.random.default_rng(2)
    for n in (20, 60, 300):
        for _ in range(40):
            pool = rng.integers(0, 2**63, 5 * n, dtype=np.uint64)
            a, b = pool[: 4 * n], np.concatenate((pool[: 3 * n], pool[4 * n :]))  # 3 n of 5 n: not similar
            similar = pool[: 4 * n], np.concatenate((pool[: 4 * n], pool[4 * n : 5 * n]))  # 4 n of 5 n
            keys = [set(ngram_join.several_keys(x).tolist()) for x in (*similar, a, b)]
            assert keys[0] & keys[1]


def list_pairs(spark, monkeypatch, pages, long):
    """Pairs in the lists of single shingles and of several."""
    counted, met = [], ngram_join.met_in_lists
    monkeypatch.setattr(ngram_join, "LONG", long)
    monkeypatch.setattr(ngram_join, "met_in_lists", lambda marked: counted.append(lists_of_pairs(marked)) or met(marked))
    ngram_join.ngram_join(plain(spark, pages)).count()
    monkeypatch.setattr(ngram_join, "met_in_lists", met)
    return counted


def lists_of_pairs(marked):
    """Pairs that the lists hold before any filter."""
    sizes = marked.groupBy("s").agg(F.count_if(F.col("part") != F.col("main")).alias("few"), F.count(F.lit(1)).alias("of"))
    return sizes.agg(F.coalesce(F.sum(F.col("few") * F.col("of")), F.lit(0))).first()[0]


def test_pairs_of_pages_with_shared_passages(spark, monkeypatch):
    """Pages of 4 of 30 passages: the lists of a passage are not paired out."""
    rng = random.Random(8)
    pages = blocks(rng, 800, kinds=30, words=40)
    half, whole = (list_pairs(spark, monkeypatch, pages[:n], 16) for n in (400, 800))
    plain_lists = sum(list_pairs(spark, monkeypatch, pages[:800], 10**9))
    print("pairs in lists:", half, whole, "without splitting:", plain_lists)
    assert whole[0] < 16 * 120 * 960 and 10 * sum(whole) < plain_lists


def brute_links(rows):
    """How many other rows are similar to each, and the pairs of distinct sets."""
    sets = [shingles(text) for _, text in rows]
    near = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)
    counts = sorted(((doc, sum(near(s, t) for j, t in enumerate(sets) if j != i)) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)
    distinct = list({s for s in sets if s})
    return counts, sum(near(a, b) for i, a in enumerate(distinct) for b in distinct[:i])


@pytest.mark.parametrize("long", [2, 32])
def test_links_against_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(ngram_join, "LONG", long)
    texts = corpus(random.Random(13))[:260]
    texts += texts[:25] + texts[:5] + [None, "", "a b"]
    docs = plain(spark, texts)
    counts, links = brute_links(list(enumerate(texts)))
    assert sorted(((r["doc"], r["n_links"]) for r in ngram_join.link_counts(docs).collect()), key=str) == counts
    assert ngram_join.set_links(docs)[0].count() == links
    cases = brute_links([(r[0], r[1]) for r in ROWS])[0]
    assert sorted(((r["doc"], r["n_links"]) for r in ngram_join.link_counts(documents(spark)).collect()), key=str) == cases
    assert ngram_join.link_counts(empty(spark)).count() == 0


def test_few_rows_at_once_reach_python(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, write = spark.conf.get(name), [], ngram_join.staged

    def watched(df, what):
        seen.append(spark.conf.get(name))
        return write(df, what)

    monkeypatch.setattr(ngram_join, "staged", watched)
    docs = plain(spark, ["a b c d e f g h", "a b c d e f g h i", "another text of six words"])
    joined = ngram_join.ngram_join(docs)
    ngram_join.set_links(docs)
    assert seen and set(seen) == {str(ngram_join.SLICE)} and spark.conf.get(name) == before
    # What is left to do when the result is read runs no Python.
    assert "MapInArrow" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 3
