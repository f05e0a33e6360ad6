import hashlib
import zlib

import duckdb
import pytest

from cases import ROWS, documents, empty
from conftest import SF0001
from pyspark.sql import functions as F
from stockpilot.llm import merkle, oracle, queries


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root and, for each leaf, its (place, siblings) of every level."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, path in enumerate(steps):
            run = nodes[at[i] // 3 * 3 : at[i] // 3 * 3 + 3]
            path.append((at[i] % 3, [d for j, d in enumerate(run) if j != at[i] % 3]))
            at[i] //= 3
        nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], steps


def brute(rows):
    """rows: (group, order, leaf). The leaves' (group, order, leaf, subroot, root, steps)."""
    groups = {}
    for g, o, d in rows:
        groups.setdefault(g, []).append((o is not None, o or 0, d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subtrees = [tree([d for _, _, d in sorted(groups[g])]) for g in names]
    root, above = tree([sub for sub, _ in subtrees])
    return [
        (g, o if some else None, d, sub, root, steps + up)
        for g, (sub, paths), up in zip(names, subtrees, above)
        for (some, o, d), steps in zip(sorted(groups[g]), paths)
    ]


def found(df):
    return [
        (r["row"]["source"], r["row"]["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["at"], s["siblings"]) for s in r["steps"]])
        for r in df.collect()
    ]


def by_text(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_cases_against_brute_force(spark, depth):
    docs = documents(spark)
    rows = [(r["source"], r["doc_id"], leaf([r[c] for c in merkle.FIELDS])) for r in docs.collect()]
    assert by_text(found(merkle.manifest(docs, depth=depth))) == by_text(brute(rows))


@pytest.mark.parametrize("depth", [1, 2])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82])
def test_sizes_around_powers(spark, n, depth):
    ids = list(range(0, 5 * n, 5))
    rows = [(f"g{i % 11}" if i % 2 else "hot", i) for i in ids]
    docs = spark.createDataFrame([(i, g, f"text {i}") for g, i in rows], "doc_id bigint, source string, text string").repartition(3)
    want = brute([(g, i, leaf([i, g, f"text {i}"])) for g, i in rows])
    assert by_text(found(merkle.manifest(docs, ("doc_id", "source", "text"), depth=depth))) == by_text(want)


def test_groups_order_by_bytes(spark):
    names = ["b", "a", "é", "z", "", "B", "𝄞", "￮", None, "a b"]
    docs = spark.createDataFrame([(i, g) for i, g in enumerate(names)], "doc_id bigint, source string")
    want = brute([(g, i, leaf([i, g])) for i, g in enumerate(names)])
    assert by_text(found(merkle.manifest(docs, ("doc_id", "source")))) == by_text(want)


def test_fold_leads_to_the_root_and_detects_changes(spark):
    listed = merkle.manifest(documents(spark)).withColumn("wrong", F.sha2("leaf", 256))
    for r in listed.select("root", merkle.fold(F.col("leaf")).alias("right"), merkle.fold(F.col("wrong")).alias("wrong")).collect():
        assert r["right"] == r["root"] != r["wrong"]


def test_query_against_brute_force_and_sql(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    got = queries.op13_merkle_manifest(spark, SF0001)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    read = {}
    for r in docs:
        text = r["text"]
        if text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        read[r["doc_id"]] = leaf([r["doc_id"], r["source"], r["lang"], r["n_chars"], text])
    want = []
    for _, i, d, sub, root, steps in brute([(r["source"], r["doc_id"], leaf([r[c] for c in merkle.FIELDS])) for r in docs]):
        folded = read[i]
        for at, siblings in steps:
            folded = digest("".join(siblings[:at]) + folded + "".join(siblings[at:]))
        want.append((i, d, sub, root, digest("".join(x for _, s in steps for x in s)), folded, folded == root))
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want)
    assert 0 < sum(r[-1] for r in rows) < len(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    assert sorted(con.sql(f"SELECT {', '.join(names)} FROM ({oracle.SQL['op13_merkle_manifest']})").fetchall()) == rows


def test_no_documents(spark):
    assert merkle.manifest(empty(spark)).count() == 0


def test_repeated_rows_are_leaves_each(spark):
    assert merkle.manifest(documents(spark, ROWS + ROWS)).count() == 2 * len(ROWS)
