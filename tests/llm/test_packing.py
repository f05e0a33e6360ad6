import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cases import ROWS, documents, empty, plain
from conftest import SF0001
from stockpilot.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, window=1024):
    """texts: [(doc_id, text)]; every id in one piece, every sequence gapless."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for start in range(0, len(ids), window):
            piece = ids[start : start + window]
            want[doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    padding = total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        size = packing.padded_size(at, window)
        assert at <= window and {r["window"] for r in own} == {size}
        padding, total = padding + size - at, total + at
    return padding, total, sequences


def test_cases(spark):
    rows = packing.packing(documents(spark), PATH).collect()
    check(rows, [(r[0], r[1]) for r in ROWS])
    assert packing.packing(empty(spark), PATH).count() == 0


def test_special_tokens_and_many_equal_lengths(spark):
    texts = ["<|endoftext|> a <|endoftext|>"] * 3 + ["same"] * 400 + ["", None, "a b c " * 700]
    rows = packing.packing(plain(spark, texts).repartition(5), PATH).collect()
    padding, total, _ = check(rows, list(enumerate(texts)))
    assert padding < 1024 and total > 2000


def test_query_pads_little_and_balances_steps(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    padding, total, sequences = check(queries.op7_packing(spark, SF0001).collect(), texts)
    assert padding < 0.02 * total
    groups = Counter((own[0]["window"], own[0]["step_group"]) for own in sequences.values())
    for size in {w for w, _ in groups}:
        of_size = [n for (w, _), n in groups.items() if w == size]
        assert max(of_size) - min(of_size) <= 1 and max(of_size) * size <= packing.STEP_WINDOWS * packing.WINDOW


def test_the_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    for _ in range(30):
        counts = {int(k): int(rng.integers(1, 60)) for k in rng.integers(1, 65, 20)}
        plan = packing.plan_patterns(counts, 64, (64, 32, 16))
        used = Counter()
        for lengths, times in plan:
            assert times > 0 and sum(lengths) <= 64
            for length in lengths:
                used[length] += times
        assert used == Counter(counts)
        assert len(plan) <= 4 * len(counts)


def test_the_table_of_ranks_stays_small(spark):
    """At most a row for each range of pieces and one more for each length, however many
    input partitions there are and however common a length is."""
    texts = ["a b c"] * 3000 + [("word " * n).strip() for n in range(60)] * 5
    docs = plain(spark, texts).repartition(40)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = packing.numbered_pieces(packing.encoded_pieces(docs, PATH, 1024)).select("range", "length", "nth").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    ranges, lengths = {r["range"] for r in numbered}, Counter(r["length"] for r in numbered)
    rows = Counter((r["range"], r["length"]) for r in numbered)
    assert len(ranges) > 4 and len(rows) <= len(ranges) + len(lengths)
    assert max(rows.values()) < 0.5 * max(lengths.values())  # the common length is spread
    for (part, length), n in rows.items():
        assert sorted(r["nth"] for r in numbered if (r["range"], r["length"]) == (part, length)) == list(range(n))


def test_piece_counts_are_not_written(spark, monkeypatch):
    """The table of ranks is counted from the numbered pieces and broadcast: no files of
    its own, and the pieces are not shuffled for it."""
    written, staged = [], packing.staged
    monkeypatch.setattr(packing, "staged", lambda df, name: written.append(name) or staged(df, name))
    texts = ["same"] * 50 + ["a b c " * n for n in range(30)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        packed = packing.packing(plain(spark, texts).repartition(7), PATH)
        check(packed.collect(), list(enumerate(texts)))
        plan = packed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert written == ["pieces", "numbered-pieces"]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
