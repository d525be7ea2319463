"""Formatting conversations out of reply trees.

A message names the message it answers. A leaf is a message without answers, and a path leads
from a root to a leaf. Paths are found by self-joins that double their reach: after k rounds
each leaf knows its ancestors up to a distance of 2^k, and each message its ancestor at just
that distance, so a chain of n turns takes log2(n) rounds. Rows never exceed the paths' total
length, and all joins are on a message's own key, which no hot conversation can skew.

Branches of a conversation are ranked by the mean score of their messages; each chosen path
becomes one formatted conversation. A conversation is one string, so its text is gathered in
one row; nothing else is.

Template: each turn is ``<s>role\\ntext</s>``. Control strings of this and of other common
templates are broken up inside roles and texts by a backslash after their first character;
a backslash is doubled. Reading back drops them again. The loss mask is the list of spans of
the assistants' texts in the formatted string.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop, prepare, table

OPEN, CLOSE = "<s>", "</s>"
#: Control strings that may not stand inside a text (fixed values).
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")

_BEFORE = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n", re.S)


def escape(text: str) -> str:
    return _BEFORE.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts of role ``learn``."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
        body = escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = _ROLE.match(formatted, at)
        end = formatted.find(CLOSE, head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(head[1]), unescape(formatted[head.end() : end])))
        at = end + len(CLOSE)
    return turns


def _key(col: Column) -> Column:
    """A join key in which nulls are equal."""
    return F.coalesce(F.concat(F.lit("v"), col.cast("string")), F.lit("n"))


def reply_paths(messages: DataFrame) -> DataFrame:
    """All root-to-leaf paths of ``messages(conv, node, parent)``, unique in (conv, node):
    ``conv, leaf, node, up`` (0 at the leaf).

    A parent that is not there makes a root. Messages on or below a circle of answers have no
    root and are left out.
    """
    nodes = messages.select("conv", "node", "parent")
    there = nodes.select("conv", F.col("node").alias("parent"))
    jump = table(nodes.where("parent IS NOT NULL").join(there, ["conv", "parent"]).select("conv", "node", F.col("parent").alias("up_node")), "jump")
    answered = jump.select("conv", F.col("up_node").alias("node")).distinct()
    paths = table(
        nodes.join(answered, ["conv", "node"], "left_anti").select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")),
        "paths",
    )
    roots = nodes.select("conv", "node").join(jump.select("conv", "node"), ["conv", "node"], "left_anti")
    roots = table(roots, "roots")
    longest = messages.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    reach = 1
    while reach <= longest and not jump.isEmpty():
        further = paths.join(jump, ["conv", "node"]).select("conv", "leaf", F.col("up_node").alias("node"), (F.col("up") + reach).alias("up"))
        new_paths = table(paths.union(further), "paths")
        twice = jump.select("conv", F.col("node").alias("first"), F.col("up_node").alias("node")).join(jump, ["conv", "node"])
        new_jump = table(twice.select("conv", F.col("first").alias("node"), "up_node"), "jump")
        drop(paths, jump)
        paths, jump, reach = new_paths, new_jump, 2 * reach
    rooted = paths.join(roots, ["conv", "node"], "left_semi").select("conv", "leaf").distinct()
    return paths.join(rooted, ["conv", "leaf"], "left_semi").select("conv", "leaf", "node", "up")


def format_trees(
    messages: DataFrame,
    conv_col: str = "conv_id",
    node_col: str = "node",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
    branches: int | None = 1,
    learn: str = "assistant",
) -> DataFrame:
    """The best ``branches`` paths (None: all) of each conversation, each formatted.

    Returns ``conv_id`` (of the input's type), ``leaf, branch`` (from 1), ``score`` (mean, a
    null score counts 0), ``n_turns, formatted, loss_spans`` (array of start and end, in code
    points). Ties in score go to the smaller leaf.

    Null roles and texts are empty. A null conversation id is a conversation of its own; a
    null message id takes no part. Of rows with the same conversation and message id the
    smallest (by parent, role, text, score) counts. Empty table: no rows. Other input columns
    are never read by name.
    """
    prepare(messages.sparkSession)
    score = F.col(score_col).cast("double") if score_col else F.lit(0.0)
    fields = F.struct(
        F.col(parent_col).cast("long").alias("parent"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )
    rows = messages.where(F.col(node_col).isNotNull())
    rows = rows.select(_key(F.col(conv_col)).alias("conv"), F.col(conv_col).alias("conv_id"), F.col(node_col).cast("long").alias("node"), fields.alias("m"))
    rows = rows.groupBy("conv", "conv_id", "node").agg(F.min("m").alias("m")).select("conv", "conv_id", "node", "m.*")
    rows = table(rows, "messages")
    paths = table(reply_paths(rows), "rooted")

    scored = paths.join(rows.select("conv", "node", "score"), ["conv", "node"]).groupBy("conv", "leaf").agg(F.avg("score").alias("score"))
    by_score = Window.partitionBy("conv").orderBy(F.col("score").desc(), "leaf")
    ranked = scored.withColumn("branch", F.row_number().over(by_score))
    chosen = ranked if branches is None else ranked.where(F.col("branch") <= branches)

    turns = paths.join(chosen, ["conv", "leaf"]).join(rows.select("conv", "conv_id", "node", "role", "text"), ["conv", "node"])
    whole = turns.groupBy("conv", "conv_id", "leaf", "branch", "score").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")
    )

    def write(batches):
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns], learn) for turns in batch["turns"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {c: batch[c] for c in ("conv_id", "leaf", "branch", "score")}
                | {
                    "n_turns": pa.array([len(t) for t in batch["turns"]], pa.int64()),
                    "formatted": pa.array([f for f, _ in made], pa.string()),
                    "loss_spans": pa.array([[{"start": a, "end": b} for a, b in s] for _, s in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                }
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    return whole.select("conv_id", "leaf", "branch", "score", "turns").mapInArrow(
        write, f"conv_id {kind}, leaf long, branch int, score double, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>"
    )
