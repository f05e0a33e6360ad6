import re
from collections import Counter

import numpy as np

from cases import ROWS, documents, empty
from conftest import SF001
from stockpilot.llm import quality_rules, queries

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_statistics(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = queries.op5_quality_rules(spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in BASE) == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    clean = [r for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    poor = [r for r in got if labels.get(r["doc_id"]) == 0]
    assert np.mean([r["kept"] for r in clean]) > 0.99
    assert np.mean([r["kept"] for r in poor]) < 0.1


def test_cases(spark):
    docs = documents(spark)
    judged = quality_rules.quality_rules(docs).collect()
    assert sorted(((r["row"]["doc_id"], *(r["stats"][c] for c in BASE[:5]), r["base_failed"]) for r in judged), key=str) == sorted(
        ((r[0], *brute(r[1])) for r in ROWS), key=str
    )
    kept = quality_rules.keep_good(docs)
    assert kept.schema.names == docs.schema.names
    assert {r["doc_id"] for r in kept.collect()} <= {r["row"]["doc_id"] for r in judged if not r["base_failed"]}
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_the_estimate_withstands_outliers(spark):
    """A fifth of far rows moves neither centre nor scatter by much; numpy's
    estimate from the sound rows alone is the reference."""
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(6, 6)) * 0.3 + np.eye(6) * 2
    good = rng.normal(size=(3000, 6)) @ mix.T + 5
    bad = rng.normal(size=(700, 6)) * 0.3 + 60
    rows = [("a", *map(float, x)) for x in np.vstack([good, bad])]
    columns = ", ".join(f"x{i} double" for i in range(6))
    frame = spark.createDataFrame(rows, f"lang string, {columns}").selectExpr("named_struct('level', 2, 'lang', lang, 'source', 's') cell", "x0", "x1", "x2", "x3", "x4", "x5")
    got = quality_rules.robust_params(frame.selectExpr("named_struct('level', 2, 'lang', cell.lang, 'source', cell.source) cell", *[f"x{i}" for i in range(6)])).first()
    inverse = np.array(got["inverse"]).reshape(6, 6)
    scatter = np.linalg.inv(inverse) - np.diag(np.square(quality_rules.SPREAD))
    assert np.abs(np.array(got["centre"]) - good.mean(axis=0)).max() < 0.3
    assert np.abs(scatter / np.cov(good.T) - 1)[np.eye(6, dtype=bool)].max() < 0.2
    far = bad - np.array(got["centre"])
    assert (np.einsum("ni,ij,nj->n", far, inverse, far) > quality_rules.chi2_quantile(1 - quality_rules.REJECT, 6)).all()


def test_chi_squared():
    assert abs(quality_rules.chi2_quantile(0.975, 6) - 14.4494) < 1e-3
    assert abs(quality_rules.chi2_quantile(0.95, 8) - 15.5073) < 1e-3


def mcd_rows(spark, points):
    columns = ", ".join(f"x{i} double" for i in range(6))
    frame = spark.createDataFrame([("a", *map(float, x)) for x in points], f"lang string, {columns}")
    return frame.selectExpr("named_struct('level', 2, 'lang', lang, 'source', 's') cell", *[f"x{i}" for i in range(6)])


def test_the_smallest_determinant_is_chosen(spark):
    """Rows along a line, a tenth of the rows beside it but inside of all margins: the
    start from medians alone keeps them, the chosen one leaves them out."""
    rng = np.random.default_rng(3)
    good = rng.normal(size=(2000, 1)) * 40 @ np.ones((1, 6)) + rng.normal(size=(2000, 6)) * 0.5
    bad = np.array([8, -8, 8, -8, 8, -8]) + rng.normal(size=(220, 6)) * 0.5
    rows = mcd_rows(spark, np.vstack([good, bad]))
    starts = quality_rules.staged(quality_rules.starting_params(rows), "starts").collect()
    assert sorted(r["start"] for r in starts) == [0, 1, 2]

    def distances(points, got):
        off = points - np.array(got["centre"])
        return np.einsum("ni,ij,nj->n", off, np.array(got["inverse"]).reshape(6, 6), off)

    first = next(r for r in starts if r["start"] == 0)
    assert np.median(distances(bad, first)) < np.median(distances(good, first))
    limit = quality_rules.chi2_quantile(1 - quality_rules.REJECT, 6)
    got = quality_rules.robust_params(rows).first()
    assert (distances(bad, got) > limit).all() and (distances(good, got) < limit).mean() > 0.99


def test_pages_of_repeated_lines_are_rejected(spark):
    """Nothing is wrong with these pages but that most of their lines come again."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    lines = lambda n: [word() + str(rng.integers(1000)) for _ in range(n)]
    pages = ["\n".join(lines(160)) for _ in range(300)]
    for i in range(3):
        few = lines(24)  # in another order each time, so that no passage comes again
        pages.append("\n".join(rng.permutation((few * 7)[:160])))
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(pages)])
    got = {r["row"]["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    assert all(not got[i]["base_failed"] for i in range(300))
    assert sum(got[i]["kept"] for i in range(300)) >= 298
    assert not any(got[i]["base_failed"] or got[i]["kept"] for i in range(300, 303))


def test_texts_are_read_by_python_once(spark, capsys):
    """A filter on what is kept moves no second call of the statistics below the first."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    quality_rules.keep_good(docs).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
