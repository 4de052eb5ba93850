"""Chat formatting over reply trees.

Messages form trees by ``parent``. Iterative self-joins with doubling steps give every message its
distance from the root and the scores on the way (2, 4, 8, ... ancestors per round, so a thread of 400
replies takes nine rounds). Leaves are ranked per tree by the mean score of their path; the best
``branches`` paths are listed by the same steps in reverse and each becomes one conversation.

Template: ``[INST] user [/INST]``, ``<s> assistant </s>``, ``<<SYS>> system <</SYS>>`` and
``[ROLE]name[/ROLE] text [END]`` for any other role. Inside texts and names, a backslash and the first
character of a control string are replaced by ``\\\\``, ``\\l`` or ``\\b``, so no control string is left and the
text comes back exactly.

Defined results: NULL texts and roles count as empty; a missing or unknown parent makes a root; rows of
one node id are told apart by role and text and all but the first dropped (``as_chain`` numbers rows, so
nothing is dropped there: rows with equal turns are ordered by role and text); messages on a cycle have no
root and give no path; an empty table gives no conversations; other columns are not read. One conversation
is one row and must fit in a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Control strings of the template.
_MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
_CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"]

_ESCAPE = re.compile(r"\\|(?=" + "|".join(map(re.escape, _CONTROLS)) + r")[<\[]")
_TO = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {v: k for k, v in _TO.items()}
_UNESCAPE = re.compile(r"\\[\\lb]")
_TURN = re.compile(r"<<SYS>> (?P<system>.*?) <</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>"
                   r"|\[ROLE\](?P<name>.*?)\[/ROLE\] (?P<other>.*?) \[END\]", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _BACK[m[0]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the spans of assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        before, after = _MARKS.get(role) or (f"[ROLE]{escape(role)}[/ROLE] ", " [END]")
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(before), at + len(before) + len(body)))
        parts += [before, body, after]
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        turns.append((unescape(m["name"]) if kind == "other" else kind, unescape(m[kind])))
        at = m.end()
    return turns


def as_chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it."""
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    plain = rows.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    number = F.row_number().over(order).cast("long")
    return (plain.withColumn("node", number)
            .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                    F.lit(0.0).alias("score")))


def _key(tree: Column) -> Column:
    return F.coalesce(tree.cast("string"), F.lit("\u0000"))


def branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """Messages of the best paths of every tree: ``tree``, ``branch`` (from 1), ``path_score``, ``turns``.

    ``messages``: tree, node, parent, role, text, score. ``turns`` is an array of (depth, role, text) in order.
    """
    rows = messages.select(_key(F.col("tree")).alias("key"), "tree", "node", "parent",
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                           F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    rows = rows.groupBy("key", "node").agg(F.min(F.struct("role", "text", "parent", "score", "tree")).alias("m"))
    rows = common.stored(rows.select("key", "node", "m.*"), "chat-messages")
    links = rows.select("key", "node", "parent", "score")
    known = links.select("key", F.col("node").alias("parent"), F.lit(True).alias("__known"))
    jump = links.join(known, ["key", "parent"], "left").select(
        "key", "node", F.when(F.col("__known") & (F.col("parent") != F.col("node")), F.col("parent")).alias("up"),
        F.col("score").alias("total"), F.lit(1).cast("long").alias("length"))
    levels = []
    most = links.count()
    while True:
        jump = common.stored(jump, "chat-jumps")
        levels.append(jump.filter("up IS NOT NULL").select("key", "node", "up"))
        if levels[-1].isEmpty() or 2 ** (len(levels) - 1) > most:
            break
        # Only rows that have not met their root yet are joined; the others stay as they are.
        ahead = jump.select("key", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"),
                            F.col("length").alias("length2"))
        going = jump.filter("up IS NOT NULL").join(ahead, ["key", "up"]).select(
            "key", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"),
            (F.col("length") + F.col("length2")).alias("length"))
        jump = jump.filter("up IS NULL").unionByName(going)
    parents = links.filter("parent IS NOT NULL AND parent != node").select("key", F.col("parent").alias("node")).distinct()
    leaves = jump.filter("up IS NULL").join(parents, ["key", "node"], "left_anti")
    rank = Window.partitionBy("key").orderBy(F.desc("path_score"), F.desc("length"), "node")
    chosen = (leaves.withColumn("path_score", F.col("total") / F.col("length"))
              .withColumn("branch", F.row_number().over(rank)).filter(F.col("branch") <= per_tree))
    chosen = common.stored(chosen.select("key", F.col("node").alias("leaf"), "branch", "path_score", "length"), "chat-leaves")
    path = chosen.select("key", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("back"))
    for k in range(len(levels) - 1, -1, -1):
        farther = path.join(levels[k], ["key", "node"]).select("key", "leaf", F.col("up").alias("node"), (F.col("back") + 2 ** k).alias("back"))
        path = path.unionByName(farther)
        if k % 3 == 0:
            path = common.stored(path, "chat-paths")
    told = path.join(rows.select("key", "node", "tree", "role", "text"), ["key", "node"])
    grouped = told.groupBy("key", "leaf").agg(
        F.first("tree", ignorenulls=True).alias("tree"),
        F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("depth"), "role", "text"))).alias("turns"))
    return grouped.join(chosen.drop("length"), ["key", "leaf"]).select("tree", "branch", "path_score", "turns")


def format_branches(paths: DataFrame) -> DataFrame:
    """``tree``, ``branch``, ``formatted`` and the loss mask ``loss_spans`` (code points, end exclusive)."""
    kinds = dict(paths.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns]) for turns in batch["turns"]]
            yield pd.DataFrame({"tree": batch["tree"], "branch": batch["branch"], "formatted": [d[0] for d in done],
                                "loss_spans": [[{"start": a, "stop": b} for a, b in d[1]] for d in done]})

    return paths.select("tree", "branch", "turns").mapInPandas(
        run, f"tree {kinds['tree']}, branch int, formatted string, loss_spans array<struct<start: long, stop: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a formatted conversation holds, read from the string and its mask alone."""
    kind = dict(formatted.dtypes)["tree"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, whole, spans in zip(batch["tree"], batch["formatted"], batch["loss_spans"]):
                turns = parse(whole)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(whole[s["start"]:s["stop"]]) for s in spans)
                out.append((tree, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
            yield pd.DataFrame(out, columns=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInPandas(run, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
