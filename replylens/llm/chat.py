"""Chat formatting of reply trees."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from replylens.llm.common import map_batches, same, store

BRANCHES = 1
CONVERSATION = "tree long, leaf long, branch int, formatted string, loss array<struct<begin:long,end:long>>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)

# The template: a head with the role, the text, an end. Every mark begins with "<" or "[",
# which inside roles and texts have a backslash before them, as have "|" and the backslash.
TURN = "<|{role}|>\n{text}<|end|>\n"
LEARNED = "assistant"
_MARKS = regex.compile(r"[\\<\[|]")
_ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)
_TURN = regex.compile(r"<\|((?:\\.|[^\\|])*)\|>\n((?:\\.|[^\\<])*+)<\|end\|>\n", regex.DOTALL)


def escape(text: str | None) -> str:
    return _MARKS.sub(lambda m: "\\" + m[0], text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans (in characters) to learn from."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, _, tail = TURN.partition("{text}")
        head, body = head.format(role=escape(role)), escape(text)
        if role == LEARNED:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(parts), loss


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


def _at(key: str) -> list:
    """Match of ``tree`` and ``key`` with ``t`` and ``p``; a null tree matches itself."""
    return [same(F.col("tree"), F.col("t")), F.col(key) == F.col("p")]


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jumps of 1, 2, 4, ... replies towards the root, and the sums of whole paths.

    A table of jumps has ``tree, node, up, total, steps`` for the nodes that have so many
    nodes above them; ``total`` and ``steps`` sum the path below ``up``. Each round joins
    the nodes that have not reached their root with what is known of ``up`` and doubles
    the reach, so a conversation of n turns takes log2(n) rounds, in which fewer and fewer
    nodes take part. Whole paths have a null ``up``.
    """
    ids = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"), F.lit(True).alias("there")).distinct()
    first = nodes.join(ids, _at("parent"), "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"),
        F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"),
    )
    first = store(first, "jumps")
    jumps, whole, current = [], first.filter("up is null"), first.filter("up is not null")
    open_before = None
    while True:
        open_now = current.count()
        # What no longer shrinks leads into a cycle.
        if open_now in (0, open_before):
            return jumps, whole
        open_before = open_now
        jumps.append(current)
        above = whole.unionByName(current).select(
            F.col("tree").alias("t"), F.col("node").alias("p"), F.col("up").alias("further"),
            F.col("total").alias("more"), F.col("steps").alias("rest"),
        )
        joined = store(
            current.join(above, _at("up")).select(
                "tree", "node", F.col("further").alias("up"),
                (F.col("total") + F.col("more")).alias("total"), (F.col("steps") + F.col("rest")).alias("steps"),
            ),
            "jumps",
        )
        whole, current = whole.unionByName(joined.filter("up is null")), joined.filter("up is not null")


def reply_branches(nodes: DataFrame, branches: int = BRANCHES) -> DataFrame:
    """``tree, leaf, branch, node, place``: the best root-to-leaf paths of every tree, a row
    for each node with its place from the root.

    ``nodes`` has ``tree, node, parent, score``. A node without a parent in its tree is a
    root. Branches rank by mean score, then length, then leaf. From the chosen leaves the
    jumps, longest first, reach every node above them once. Nodes whose path ends in a cycle
    have no root and are left out. A null tree is a tree of its own.
    """
    nodes = store(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    jumps, whole = _jumps(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).dropna(subset=["p"]).distinct()
    leaves = whole.join(parents, _at("node"), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), F.desc("steps"), "node")
    path = (
        leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= branches)
        .select("tree", F.col("node").alias("leaf"), "branch", "node")
    )
    for table in reversed(jumps):
        path = store(path, "paths")
        up = table.select(F.col("tree").alias("t"), F.col("node").alias("p"), "up")
        path = path.unionByName(path.join(up, _at("node")).select("tree", "leaf", "branch", F.col("up").alias("node")))
    depth = whole.select(F.col("tree").alias("t"), F.col("node").alias("p"), F.col("steps").alias("place"))
    return path.join(depth, _at("node")).select("tree", "leaf", "branch", "node", "place")


def format_trees(messages: DataFrame, branches: int = BRANCHES) -> DataFrame:
    """Each chosen path of ``messages`` (tree, node, parent, score, role, text) as one
    conversation, with the spans of assistant text in it: the columns of ``CONVERSATION``.

    Null roles and texts are empty. Node ids are unique in their tree.
    """
    steps = store(reply_branches(messages, branches), "branches").withColumnsRenamed({"tree": "t", "node": "p"})
    turns = (
        steps.join(messages, _at("node"))
        .groupBy(F.col("t").alias("tree"), "leaf", "branch")
        .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            made = [
                format_turns([(turn["role"], turn["text"]) for turn in turns])
                for turns in batch.column(3).to_pylist()
            ]
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            loss = [[{"begin": a, "end": b} for a, b in spans] for _, spans in made]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([text for text, _ in made], pa.string()), pa.array(loss, span)],
                ["tree", "leaf", "branch", "formatted", "loss"],
            )

        return each

    return map_batches(turns.select("tree", "leaf", "branch", "turns"), make, CONVERSATION)


def linear_messages(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as trees in which each turn answers the one
    before. Rows with the same turn follow each other by role and text; a turn without a
    number comes first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(
        F.col("conv_id").cast("long").alias("tree"), node.alias("node"), "role", "text"
    ).select(
        "tree", "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("double").alias("score"),
        "role", "text",
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold, read from the text and its spans."""

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def digest(formatted: str, loss: list[dict]) -> tuple:
            turns = read_turns(formatted)
            learned = "".join(unescape(formatted[s["begin"] : s["end"]]) for s in loss)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            return (
                len(turns),
                hashlib.sha256(whole.encode()).hexdigest(),
                len(learned),
                hashlib.sha256(learned.encode()).hexdigest(),
                len(formatted),
            )

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = [digest(*r) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*rows) if rows else [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], [column.split()[0] for column in DIGESTS.split(", ")]
            )

        return each

    return map_batches(conversations.select("tree", "formatted", "loss"), make, DIGESTS)
