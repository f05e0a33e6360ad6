"""Reply trees as training conversations.

Messages point to the message that they reply to.  Iterative self-joins double
the reach of that pointer, and walking back down the powers of two lists all
ancestors of every leaf: the root-to-leaf paths, in as many rounds as the
deepest path has binary digits.  The branches of a conversation are ranked by
the mean score of their messages, and each chosen branch is formatted as one
conversation with a mask of the assistant's text.

The template is ``### role: text</turn>`` and a line break for each turn.  A
backslash inside a text (or a role) is doubled and one is put before every
control string, so that what is read back is what was written, whatever it holds.

Cases: a null text or role counts as empty; a null score as 0; a reply to an
unknown message starts a tree; a null ``conv_id`` is a conversation of its own;
replies in a circle are an error; an empty table gives an empty result; further
columns are not read.  Messages of a conversation need distinct ids: ``threads``
numbers rows by turn, then role, then text, so that repeated rows all stay.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpilot.llm.text import map_batches, staged

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>"
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|#|<|:)")
# What a turn looks like: in both parts a backslash takes the next character along.
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and the spans (in code points) that a loss counts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role, _ROLE_CONTROL)}{MIDDLE}", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        turn = f"{head}{body}{CLOSE}\n"
        parts.append(turn)
        at += len(turn)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def threads(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply chains: conv_id, msg_id, parent_id, role, text, score."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("msg_id")).select(
        "conv_id",
        "msg_id",
        F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def reply_paths(links: DataFrame) -> DataFrame:
    """leaf, node, up: the messages of each root-to-leaf path, ``up`` counted from
    the leaf.  links: node, parent (structs of conversation and message)."""
    known = links.select(F.col("node").alias("found"))
    reach = links.join(known, links["parent"] == F.col("found"), "left").select("node", F.col("found").alias("above"))
    hops = [staged(reach.where("above is not null"), "reply-hops")]
    parents = hops[0].select(F.col("above").alias("node")).distinct()
    paths = links.select("node").join(parents, "node", "left_anti").select(F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    total = links.count()
    while not hops[-1].isEmpty():
        if 1 << (len(hops) - 1) > total:
            raise ValueError("replies form a circle")
        last = hops[-1]
        further = last.select(F.col("node").alias("middle"), F.col("above").alias("top"))
        hops.append(staged(last.join(further, last["above"] == further["middle"]).select("node", F.col("top").alias("above")), "reply-hops"))
    for k in reversed(range(len(hops) - 1)):
        step = hops[k].select(F.col("node").alias("at"), "above")
        climbed = paths.join(step, paths["node"] == step["at"]).select("leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        paths = staged(paths.unionByName(climbed), "reply-paths")
    return paths


def chosen_paths(messages: DataFrame, branches: int | None) -> DataFrame:
    """conv_id, leaf, up, role, text of the ``branches`` best branches of each
    conversation (all: None), by the mean score of their messages; of equal scores the
    branch with the smallest leaf comes first."""
    key = F.struct("conv_id", "msg_id")
    messages = staged(
        messages.select(
            key.alias("node"),
            F.when(F.col("parent_id").isNotNull(), F.struct("conv_id", F.col("parent_id").alias("msg_id"))).alias("parent"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        ),
        "messages",
    )
    paths = reply_paths(messages.select("node", "parent"))
    if branches is not None:
        scored = paths.join(messages.select("node", "score"), "node").groupBy("leaf").agg(F.avg("score").alias("score"))
        best = Window.partitionBy("leaf.conv_id").orderBy(F.desc("score"), "leaf.msg_id")
        scored = scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= branches)
        paths = paths.join(scored.select("leaf"), "leaf")
    return paths.join(messages.select("node", "role", "text"), "node").select("leaf", "up", "role", "text")


def chat_format(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """conv_id, leaf_id, formatted, spans: a row for each chosen branch."""
    turn = F.struct((-F.col("up")).alias("place"), "role", "text")
    whole = chosen_paths(messages, branches).groupBy("leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batch: pa.RecordBatch) -> dict:
        done = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
        return {
            "conv_id": batch.column("conv_id"),
            "leaf_id": batch.column("leaf_id"),
            "formatted": [text for text, _ in done],
            "spans": [[{"start": a, "end": z} for a, z in spans] for _, spans in done],
        }

    flat = whole.select(F.col("leaf.conv_id").alias("conv_id"), F.col("leaf.msg_id").alias("leaf_id"), "turns")
    return map_batches(flat, run, "conv_id bigint, leaf_id bigint, formatted string, spans array<struct<start:bigint,end:bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a formatted conversation says, parsed from the output."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
            turns = read_turns(text)
            counted = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            out["n_turns"].append(len(turns))
            out["turns_sha256"].append(hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest())
            out["loss_chars"].append(len(counted))
            out["loss_sha256"].append(hashlib.sha256(counted.encode()).hexdigest())
            out["formatted_chars"].append(len(text))
        return out | {"conv_id": batch.column("conv_id")}

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_batches(formatted, run, schema)
