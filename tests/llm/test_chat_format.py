import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF0001
from stockpilot.llm import chat_format, queries

PIECES = st.lists(st.sampled_from(["\\", "#", "###", "### ", "</turn>", "<", "/turn>", ":", ": ", "\n", "a", "é", "user", " "]), max_size=8).map("".join)
MESSAGES = "conv_id bigint, msg_id bigint, parent_id bigint, role string, text string, score double"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4))
def test_what_is_written_is_read_back(turns):
    formatted, spans = chat_format.format_turns([*turns, ("assistant", "x\\</turn>")])
    assert chat_format.read_turns(formatted) == [*turns, ("assistant", "x\\</turn>")]
    a, z = spans[-1]
    assert chat_format.unescape(formatted[a:z]) == "x\\</turn>"


def test_branches_are_ranked(spark):
    rows = [
        (1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "bad", 0.0), (1, 3, 1, "assistant", "good", 5.0),
        (1, 4, 3, "user", None, 1.0), (1, 5, 3, None, "other", 2.0), (2, 1, 9, "user", "orphan", None),
        (None, 1, None, "user", "no conversation", None), (None, 2, 1, "assistant", "yes", None),
    ]
    messages = spark.createDataFrame(rows, MESSAGES)
    every = {(r["conv_id"], r["leaf_id"]): r["formatted"] for r in chat_format.chat_format(messages).collect()}
    assert set(every) == {(1, 2), (1, 4), (1, 5), (2, 1), (None, 2)}
    assert chat_format.read_turns(every[1, 5]) == [("user", "q"), ("assistant", "good"), ("", "other")]
    assert chat_format.read_turns(every[None, 2]) == [("user", "no conversation"), ("assistant", "yes")]
    best = {(r["conv_id"], r["leaf_id"]) for r in chat_format.chat_format(messages, branches=1).collect()}
    assert best == {(1, 5), (2, 1), (None, 2)}


def test_a_long_chain(spark):
    rows = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", str(i), 0.0) for i in range(150)]
    got = chat_format.chat_format(spark.createDataFrame(rows, MESSAGES)).collect()
    assert len(got) == 1
    assert [t for _, t in chat_format.read_turns(got[0]["formatted"])] == [str(i) for i in range(150)]


def test_a_circle_is_an_error(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)]
    with pytest.raises(ValueError, match="circle"):
        chat_format.chat_format(spark.createDataFrame(rows, MESSAGES)).collect()


def test_no_messages(spark):
    assert chat_format.chat_format(spark.createDataFrame([], MESSAGES)).count() == 0


def test_query(spark):
    want = defaultdict(list)
    for r in spark.read.parquet(f"{SF0001}/conversations.parquet").collect():
        want[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    want[-7] = [(0, "user", queries.EXTRA_TEXT), (1, "assistant", queries.EXTRA_TEXT)]
    got = queries.op3_chat_format(spark, SF0001).collect()
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = sorted(want[r["conv_id"]])
        said = "".join(text for _, role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
