import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cases import ROWS, documents, empty
from conftest import SF001
from stockpilot.llm import brown_lm, queries


def base_scores(rows):
    train = Counter()
    for doc, text in rows:
        if zlib.crc32((str(doc) if doc is not None else "").encode()) % 10:
            train.update([*(text or "").encode().lower().split(), None])
    total, distinct = sum(train.values()), len(train)
    out = []
    for doc, text in rows:
        tokens = [*(text or "").encode().lower().split(), None]
        score = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out.append((doc, len(tokens), sum(train[t] > 0 for t in tokens), total, round(score, 4)))
    return sorted(out, key=str)


def rounded(got):
    return sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got), key=str)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.op6_brown_lm(spark, SF001).collect()
    assert rounded(got) == base_scores(rows)
    held = [r for r in got if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert held and sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens  # lower perplexity


@pytest.mark.parametrize("head", [200_000, 3])
def test_cases_with_words_in_and_outside_of_the_head(spark, monkeypatch, head):
    monkeypatch.setattr(brown_lm, "HEAD", head)
    got = brown_lm.brown_lm(documents(spark)).collect()
    assert rounded(got) == base_scores([(r[0], r[1]) for r in ROWS])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def scores(spark, docs):
    return sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in brown_lm.brown_lm(docs).collect())


def kinds(seed=3, texts=300, words=200):
    """Texts of words of two kinds that alternate."""
    rng = np.random.default_rng(seed)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(2 * words)]
    odds = 1 / (np.arange(words) + 10)
    drawn = (rng.choice(words, 100, p=odds / odds.sum()) for _ in range(texts))
    return [(i, " ".join(names[words * (j % 2) + d] for j, d in enumerate(line)), "en", "s") for i, line in enumerate(drawn)]


@pytest.mark.parametrize("name, value", [("HEAD", 5), ("SPLIT", 40), ("GATHERED", 7), ("BLOCK", 50), ("AT_ONCE", 30), ("SLICE", 3)])
def test_scores_do_not_depend_on_how_the_work_is_cut(spark, monkeypatch, name, value):
    monkeypatch.setattr(brown_lm, "EXCHANGED", 20)
    docs = documents(spark, [*ROWS, *kinds(texts=60)])
    usual = scores(spark, docs)
    monkeypatch.setattr(brown_lm, name, value)
    assert scores(spark, docs) == usual


def test_no_documents(spark):
    assert brown_lm.brown_lm(empty(spark)).count() == 0


def likelihood(pairs, of):
    size = of.max() + 1
    table = np.zeros((size, size))
    np.add.at(table, (of[:, None].repeat(len(of), 1), of[None, :].repeat(len(of), 0)), pairs)
    h = brown_lm._xlogx
    return h(table).sum() - h(table.sum(axis=0)).sum() - h(table.sum(axis=1)).sum()


def test_exchange_finds_hidden_classes():
    """Words of two kinds that alternate end up in two classes, and no single move is better."""
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 2, 30)
    pairs = np.zeros((32, 32))
    for a in range(30):
        for b in range(30):
            pairs[a, b] = rng.poisson(8 if kind[a] != kind[b] else 0.3)
    pairs[31, :30] = 1
    pairs[:30, 31] = 1
    of = brown_lm.exchange(pairs, 30, 2, 20)
    assert len({(k, c) for k, c in zip(kind, of[:30])}) == 2
    best = likelihood(pairs, of)
    for word in range(30):
        other = of.copy()
        other[word] = 1 - other[word]
        assert likelihood(pairs, other) <= best + 1e-6


@pytest.mark.parametrize("head, table", [(200_000, 1 << 24), (30, 1 << 24), (200_000, 150)])
def test_words_beyond_the_exchanged_ones_get_learnt_classes(spark, monkeypatch, head, table):
    """Most words lie outside of the exchanged ones, some beyond the table of classes."""
    monkeypatch.setattr(brown_lm, "EXCHANGED", 20)
    monkeypatch.setattr(brown_lm, "CLASSES", 2)
    monkeypatch.setattr(brown_lm, "HEAD", head)
    monkeypatch.setattr(brown_lm, "TABLE", table)
    got = [r for r in brown_lm.brown_lm(documents(spark, kinds())).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in got)
    gained = (sum(r["score"] for r in got) - sum(r["base_score"] for r in got)) / tokens
    assert gained > 0.25, gained  # log10(2) = 0.30 for the kind of each word


@pytest.fixture
def model(monkeypatch):
    """The models that are learnt while a test runs."""
    learnt, learn = [], brown_lm.learn

    def remember(*args):
        learnt.append(learn(*args))
        return learnt[-1]

    monkeypatch.setattr(brown_lm, "learn", remember)
    return learnt


def test_likelihood_never_falls(spark, monkeypatch, model):
    monkeypatch.setattr(brown_lm, "EXCHANGED", 100)
    brown_lm.brown_lm(spark.read.parquet(f"{SF001}/documents.parquet"))
    found = model[0].likelihoods
    print("log-likelihood of the class bigrams, before and after each half sweep:", found)
    assert len(found) == 2 * brown_lm.FULL_SWEEPS + 1
    assert all(a < b for a, b in zip(found, found[1:]))


def plain_scores(rows, model, number):
    """The model written out in plain Python: classes by word, counts, chances."""
    texts = [(doc, [*(text or "").encode().lower().split(), None]) for doc, text in rows]
    train = [t for doc, t in texts if zlib.crc32((str(doc) if doc is not None else "").encode()) % 10]
    counts = Counter(w for t in train for w in t)
    end, by_ending = int(model.classes.endings[brown_lm.LAST]), model.classes.endings

    def class_of(word):
        if word is None:
            return end
        known = model.classes.of[number[word]] if word in number else brown_lm.BY_ENDING
        return int(by_ending[brown_lm.ending(word)] if known == brown_lm.BY_ENDING else known)

    pairs, size = Counter(), model.classes.size
    for t in train:
        line = [end, *map(class_of, t)]
        pairs.update(zip(line, line[1:]))
    row, column = Counter(), Counter()
    for (a, b), n in pairs.items():
        row[a] += n
        column[b] += n
    words_of = Counter(class_of(w) for w in counts if w is not None)
    total = sum(pairs.values())
    out = []
    for doc, t in texts:
        score, last = 0.0, end
        for w in t:
            c = class_of(w)
            share = (column[c] + 1) / (total + size)
            score += math.log10((pairs[last, c] + brown_lm.PULL * share) / (row[last] + brown_lm.PULL))
            if w is not None:
                score += math.log10((counts[w] + 0.1) / (column[c] + 0.1 * (words_of[c] + 1)))
            last = c
        out.append((str(doc), len(t), round(score, 4)))
    return sorted(out)


@pytest.mark.parametrize("exchanged", [3, 1024])
def test_scores_against_a_plain_model(spark, monkeypatch, model, exchanged):
    monkeypatch.setattr(brown_lm, "EXCHANGED", exchanged)
    rows = [*ROWS, *kinds(texts=40)]
    got = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 4)) for r in brown_lm.brown_lm(documents(spark, rows)).collect())
    counts = Counter()
    for r in rows:
        if zlib.crc32((str(r[0]) if r[0] is not None else "").encode()) % 10:
            counts.update((r[1] or "").encode().lower().split())
    often = sorted((w for w in counts if counts[w] >= brown_lm.MOVED), key=lambda w: (-counts[w], w))
    assert got == plain_scores([(r[0], r[1]) for r in rows], model[0], {w: i for i, w in enumerate(often)})


@pytest.mark.parametrize("seed", range(4))
def test_chooser_finds_the_highest_likelihood(seed):
    rng = np.random.default_rng(seed)
    n, classes = 24, 4
    pairs = rng.poisson(rng.choice([0.5, 3.0]), (n, n)).astype(float)
    of = np.concatenate((np.arange(20) % classes, np.arange(classes, 2 * classes)))
    size = int(of.max()) + 1
    table = np.zeros((size, size))
    np.add.at(table, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), pairs)
    sides = []
    for counts in (pairs, pairs.T):
        rows = [(w, c, k) for w in range(n) for c in range(size) if (k := int(sum(counts[w, v] for v in range(n) if v != w and of[v] == c)))]
        sides.append(tuple(np.array(x) for x in zip(*rows)))
    best = brown_lm.Chooser(table, classes).choose(of.copy(), *sides, np.diag(pairs))

    def moved(word, c):
        other = np.append(of, size - 1)
        other[word] = c
        grown = np.zeros((n + 1, n + 1))
        grown[:n, :n] = pairs
        return likelihood(grown, other)

    assert (best != of).any()
    for word in range(n):
        top = max(moved(word, c) for c in {*range(classes), int(of[word])})
        assert moved(word, best[word]) >= top - 1e-6


def test_long_text(spark):
    text = " ".join(f"w{i * i % 9973}" for i in range(400_000))
    got = brown_lm.brown_lm(documents(spark, [(2, text, "en", "s"), (3, text, "en", "s"), (5, "w0 w1", "en", "s")])).collect()
    assert sorted(r["n_tokens"] for r in got) == [3, 400_001, 400_001] and all(math.isfinite(r["score"]) for r in got)
