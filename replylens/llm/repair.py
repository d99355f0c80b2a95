"""Conversation structure repair: the cheapest edits that make turns alternate, by
Hirschberg's divide and conquer.

A repaired conversation is an optional system turn and then pairs of user and assistant,
which four states recognise: nothing yet, after system, after user, after assistant. To
find the edits of a run of turns, four costs are carried forward from its beginning and
four backward from its end; where they meet in its middle, the state on the best path is
fixed and both halves are solved alone. Only these vectors and a byte for each turn are held.

Conversations are cut into blocks, and a block as a whole is a step of the same kind as a
turn. So a conversation of any length is spread over tasks: its blocks are summed up side by
side, the states between them come from the same search over blocks, then each block is solved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from replylens.llm.common import same, store

BLOCK_ROWS = 4_096
BLOCK_CHARS = 4_000_000
SHORT = 64  # turns; what was found for a sequence of so few is kept

DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5  # costs; Keep costs nothing
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 50
FINE, DOOMED, CUT_OFF = range(3)  # how a turn may be edited
BLANK, TRUNCATED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

ROWS = "conv_id long, turn long, role string, text string, alive boolean, blank boolean, again boolean, whole boolean"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
BLOCKS = (
    "conv_id long, block long, open boolean, n long, first_turn long, last_turn long, turns long, blank long,"
    " duplicate long, truncated long, illegal long, first string, last string, steps binary, costs array<long>,"
    " ranks array<long>, roles array<string>, texts array<string>"
)
PLAN = (
    "conv_id long, block long, begins int, ends int, last boolean, cost long, "
    + ", ".join(f"{c} long" for c in COUNTS)
)
PIECES = "conv_id long, block long, n long, audit string, repaired binary, cost long, " + ", ".join(
    f"{c} long" for c in COUNTS
)
RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string, repaired_sha256 string"


class Move:
    """What a step costs from one state to another, and how the edits of paths from one
    state rank: each path to another state reads differently, and none begins another."""

    __slots__ = ("cost", "rank", "text")

    def __init__(self, cost: list[list[int]], rank: list[list[int]], text: list[list[str]] | None = None) -> None:
        self.cost, self.rank, self.text = cost, rank, text


def _after(state: int, role: str) -> int | None:
    """The state after a turn of this role, if it may follow."""
    if role == "a":
        return ASSISTANT if state == USER else None
    if role == "u":
        return USER if state != USER else None
    return SYSTEM if role == "s" and state == START else None


def _turn_move(role: str, fault: int) -> Move:
    """All ways to edit one turn, with the turns inserted before it."""
    ways: list[list[tuple[int, str]]] = [[(NEVER, "")] * 4 for _ in range(4)]
    extra = UNFINISHED if fault == CUT_OFF else 0
    for start in range(4):
        state, inserted = start, ""
        for _ in range(3):
            edits = [("D", DELETE, state)]
            if fault != DOOMED:
                edits += [("K", extra, _after(state, role))]
                edits += [("R", REROLE + extra, _after(state, r)) for r in "ua"]
            for letter, cost, end in edits:
                if end is not None:
                    way = (INSERT * len(inserted) + cost, inserted + letter)
                    ways[start][end] = min(ways[start][end], way)
            state, inserted = ASSISTANT if state == USER else USER, inserted + "I"
    order = [sorted(range(4), key=lambda q: row[q][1]) for row in ways]
    rank = [[order[p].index(q) for q in range(4)] for p in range(4)]
    return Move([[c for c, _ in row] for row in ways], rank, [[t for _, t in row] for row in ways])


MOVES = [_turn_move(role, fault) for role in ("s", "u", "a", "") for fault in (FINE, DOOMED, CUT_OFF)]
# Turns inserted after the last one, by state: a conversation may end empty or after an assistant.
TAIL = ["", "II", "I", ""]
ENDS = tuple(INSERT * len(t) for t in TAIL)

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # costs and ranks of the best paths to each state


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if q == state else NEVER for q in range(4))


@lru_cache(maxsize=1 << 16)
def _forward(vector: Vector, move: Move) -> tuple[Vector, int]:
    """The vector after a step, its least cost taken off, and that cost."""
    costs, ranks = vector
    best = []
    for q in range(4):
        reached = min((min(costs[p] + move.cost[p][q], NEVER), ranks[p], p) for p in range(4))
        best.append((reached[0], reached[1], move.rank[reached[2]][q]))
    order = sorted(range(4), key=lambda q: best[q][1:])
    least = min(b[0] for b in best)
    kept = tuple(b[0] - least if b[0] < NEVER else NEVER for b in best)
    return (kept, tuple(order.index(q) for q in range(4))), least


@lru_cache(maxsize=1 << 16)
def _backward(costs: tuple[int, ...], move: Move) -> tuple[int, ...]:
    before = [min(move.cost[p][q] + costs[q] for q in range(4)) for p in range(4)]
    least = min(before)
    return tuple(c - least if c < NEVER else NEVER for c in before)


def _crossing(vector: Vector, ends: Sequence[int]) -> int:
    """The state on the cheapest path; of several the one whose edits come first in ASCII."""
    return min(range(4), key=lambda q: (vector[0][q] + ends[q], vector[1][q]))


def find_states(moves: Sequence[Move], begin: int, ends: Sequence[int]) -> list[int]:
    """The state after each step of the best path from ``begin``, with costs at the end."""
    states = [begin] * len(moves)

    def solve(low: int, high: int, begin: int, ends: tuple[int, ...]) -> None:
        vector: Vector = (_only(begin), (0, 0, 0, 0))
        middle = (low + high + 1) // 2
        for i in range(low, middle):
            vector, _ = _forward(vector, moves[i])
        costs = ends
        for i in range(high - 1, middle - 1, -1):
            costs = _backward(costs, moves[i])
        state = states[middle - 1] = _crossing(vector, costs)
        if middle - low > 1:
            solve(low, middle, begin, _only(state))
        if high > middle:
            solve(middle, high, state, ends)

    if moves:
        solve(0, len(moves), begin, tuple(ends))
    return states


@lru_cache(maxsize=50_000)
def _short_states(steps: bytes, begin: int, ends: tuple[int, ...]) -> list[int]:
    return find_states([MOVES[s] for s in steps], begin, ends)


def edits(steps: bytes, begin: int, ends: Sequence[int]) -> tuple[list[str], int, int]:
    """The edits of each turn (insertions before it, then its own), their cost and the last state."""
    solve = _short_states if len(steps) <= SHORT else lambda s, b, e: find_states([MOVES[x] for x in s], b, e)
    texts, cost, state = [], 0, begin
    for step, after in zip(steps, solve(steps, begin, tuple(ends))):
        texts.append(MOVES[step].text[state][after])
        cost += MOVES[step].cost[state][after]
        state = after
    return texts, cost, state


def block_move(steps: bytes) -> Move:
    """A run of turns as one step."""
    cost, rank = [], []
    for begin in range(4):
        vector, total = (_only(begin), (0, 0, 0, 0)), 0
        for step in steps:
            vector, more = _forward(vector, MOVES[step])
            total += more
        cost.append([min(c + total, NEVER) for c in vector[0]])
        rank.append(list(vector[1]))
    return Move(cost, rank)


def repaired_turns(texts: list[str], roles: list[str], messages: list[str], begin: int) -> list[str]:
    """``role:text`` of the turns that the edits leave."""
    out, state = [], begin
    for text, role, message in zip(texts, roles, messages):
        for letter in text:
            if letter == "D":
                continue
            wanted = "assistant" if state == USER else "user"
            if letter == "K":
                state = _after(state, role[:1])
                out.append(f"{role}:{message}")
            else:
                state = _after(state, wanted[0])
                out.append(f"{wanted}:{message if letter == 'R' else ''}")
    return out


def inserted_turns(tail: str, state: int) -> list[str]:
    return ["user:", "assistant:"][-len(tail) :] if tail else []


def damage(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``ROWS`` without ``again`` and ``whole``: the rows after damage, those dropped with
    ``alive`` false."""
    space = F.lit(" ")
    turns = df.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
    )
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(F.col("kind") <= 1, F.lit("")).when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")
    ).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    return (
        turns.withColumn("kind", kind).withColumn("copy", F.explode(copies))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            (F.col("kind") != 0).alias("alive"),
        )
    )


def intact(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The same columns as ``damage`` returns, of the rows as they are."""
    space = F.lit(" ")
    return df.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
        F.lit(True).alias("alive"),
    )


def with_faults(turns: DataFrame) -> DataFrame:
    """Adds ``blank``, ``whole`` (not truncated) and ``again``: role and text were there in an
    earlier turn. Copies inside one turn are told by their place in the sorted rows."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    marked = turns.withColumns(
        {
            "blank": ~F.col("text").rlike(BLANK),
            "whole": F.col("text").rlike(TRUNCATED),
            "digest": digest,
        }
    )
    # Copies are counted before they meet; only what is there more than once is joined.
    repeated = (
        marked.filter("alive AND NOT blank").groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    match = same(F.col("conv_id"), F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again: Column = F.col("first").isNotNull() & ~same(F.col("first.turn"), F.col("turn"))
    return marked.join(repeated, match, "left").select(
        "conv_id", "turn", "role", "text", "alive", "blank", again.alias("again"), "whole"
    )


class _Block:
    """Turns of one conversation, in order, until there are enough for a block."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.steps, self.roles, self.texts, self.turns = conv, bytearray(), [], [], []
        self.faults = [0, 0, 0]
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, fault: int | None) -> None:
        """``fault``: 0 blank, 1 duplicate, 2 truncated or None."""
        if fault is not None:
            self.faults[fault] += 1
        how = FINE if fault is None else CUT_OFF if fault == 2 else DOOMED
        self.steps.append(3 * "sua".find(role[:1] or "-") + how if role[:1] in ("s", "u", "a") else 9 + how)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def row(self, number: int, is_open: bool) -> tuple:
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        steps = bytes(self.steps)
        move = block_move(steps) if is_open else None
        return (
            self.conv, number, is_open, len(steps), self.turns[0] if self.turns else None,
            self.turns[-1] if self.turns else None, len(self.turns), *self.faults, illegal,
            initials[0] if initials else None, initials[-1] if initials else None, steps,
            sum(move.cost, []) if move else None, sum(move.rank, []) if move else None, self.roles, self.texts,
        )


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _arrow_schema(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _to_blocks(block_rows: int) -> Callable:
    """Sorted rows to blocks. The first and the last conversation of a task may go on in
    another one, and so may parts of a long one: those blocks are ``open``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        block: _Block | None = None
        last, done, chars, cut, began = None, [], 0, False, False

        def finish(is_open: bool) -> None:
            nonlocal number, chars
            done.append(block.row(number, is_open))
            chars += block.chars
            number += 1

        for batch in batches:
            for conv, turn, role, text, alive, blank, again, whole in zip(*(c.to_pylist() for c in batch.columns)):
                if block is None or conv != block.conv:
                    if block is not None:
                        finish(cut or not began)
                        began = True
                    block, cut, last = _Block(conv), False, None
                elif len(block.steps) >= block_rows or block.chars >= BLOCK_CHARS:
                    finish(True)
                    block, cut = _Block(conv), True
                if not alive:
                    continue
                row = (turn, role, text)
                repeated = again or row == last
                last = row
                block.add(turn, role, text, 0 if blank else 1 if repeated else None if whole else 2)
                if len(done) >= 10_000 or chars >= 4 * BLOCK_CHARS:
                    yield _batch(done, BLOCKS)
                    done, chars = [], 0
        if block is not None:
            finish(True)
        yield _batch(done, BLOCKS)

    return run


def _digest(turns: list[str]) -> str:
    return hashlib.sha256("\n".join(turns).encode()).hexdigest()


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return last - first + 1 - turns if turns else 0


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that are whole conversations to results."""
    for batch in batches:
        rows = []
        for b in batch.to_pylist():
            texts, cost, state = edits(b["steps"], START, ENDS)
            turns = repaired_turns(texts, b["roles"], b["texts"], START) + inserted_turns(TAIL[state], state)
            counts = (b["blank"], b["duplicate"], b["truncated"], b["illegal"])
            gaps = _gaps(b["first_turn"], b["last_turn"], b["turns"])
            audit = "".join(texts) + TAIL[state]
            rows.append((b["conv_id"], gaps, *counts, cost + ENDS[state], audit, _digest(turns)))
        yield _batch(rows, RESULT)


def _plan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's blocks, ``conv_id, blocks`` without texts, the states between them."""
    for batch in batches:
        for conv, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            blocks.sort(key=lambda b: b["block"])
            moves = [Move(*([b[k][i : i + 4] for i in range(0, 16, 4)] for k in ("costs", "ranks"))) for b in blocks]
            states = find_states(moves, START, ENDS)
            begins = [START, *states]
            cost = ENDS[begins[-1]] + sum(m.cost[p][q] for m, p, q in zip(moves, begins, states))
            counts = [sum(b[c] for b in blocks) for c in COUNTS[1:]]
            filled = [b for b in blocks if b["n"]]
            counts[-1] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(filled, filled[1:]))
            timed = [b for b in blocks if b["turns"]]
            distinct = sum(b["turns"] for b in timed)
            distinct -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
            gaps = _gaps(timed[0]["first_turn"], timed[-1]["last_turn"], distinct) if timed else 0
            rows = [
                (conv, b["block"], p, q, b is blocks[-1], cost, gaps, *counts)
                for b, p, q in zip(blocks, begins, states)
            ]
            yield _batch(rows, PLAN)


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the states around them to their part of the result."""
    for batch in batches:
        for b in batch.to_pylist():
            texts, _, state = edits(b["steps"], b["begins"], _only(b["ends"]))
            turns = repaired_turns(texts, b["roles"], b["texts"], b["begins"])
            audit = "".join(texts)
            if b["last"]:
                turns += inserted_turns(TAIL[state], state)
                audit += TAIL[state]
            piece = (b["conv_id"], b["block"], len(turns), audit, "\n".join(turns).encode(), b["cost"])
            yield _batch([(*piece, *(b[c] for c in COUNTS))], PIECES)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and block to results, hashed one after another."""
    current, digest, audits, filled = None, None, [], False

    def result() -> pa.RecordBatch:
        counts = tuple(current[c] for c in COUNTS)
        return _batch([(current["conv_id"], *counts, current["cost"], "".join(audits), digest.hexdigest())], RESULT)

    for batch in batches:
        for piece in batch.to_pylist():
            if current is None or piece["conv_id"] != current["conv_id"]:
                if current is not None:
                    yield result()
                current, digest, audits, filled = piece, hashlib.sha256(), [], False
            if piece["n"]:
                digest.update(b"\n" * filled + piece["repaired"])
                filled = True
            audits.append(piece["audit"])
    if current is not None:
        yield result()


def repair_turns(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``RESULT`` for each conversation of rows as ``damage`` or ``intact`` return them.

    A conversation is sorted by range, so that it is spread over tasks however long it is, and
    solved in blocks. What meets in one task for a conversation of several blocks is a summary of
    32 numbers for each block, and at the end its pieces one after another, as its SHA-256
    needs them; of these, the audit alone (a letter or a few for each turn) is held.
    """
    # The first characters of the text spread a turn's many texts and follow their order.
    spread = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ordered = spread.sortWithinPartitions("conv_id", "turn", "role", "text")
    blocks = store(ordered.mapInArrow(_to_blocks(block_rows), BLOCKS), "blocks")
    results = blocks.filter("NOT open").mapInArrow(_solve_whole, RESULT)

    summary = [c.split()[0] for c in BLOCKS.split(",") if not c.endswith("array<string>") and "steps" not in c]
    open_blocks = blocks.filter("open")
    gathered = open_blocks.groupBy("conv_id").agg(F.collect_list(F.struct(*summary)).alias("blocks"))
    plan = gathered.mapInArrow(_plan_blocks, PLAN)
    # Block numbers are unique, so the conversation needs no part in the join.
    known = open_blocks.select("block", "steps", "roles", "texts")
    pieces = known.join(plan, "block").mapInArrow(_solve_pieces, PIECES)
    chained = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chain, RESULT)
    return results.unionByName(chained)


def repair_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damaged: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    for each conversation; with ``damaged`` of the rows after a repeatable damage.

    Null roles and texts are one space; such a text is blank. Null turns come first and
    have no part in the gaps. Turns with one number are ordered by role and text. Null
    conversation ids are one conversation. Rows repeated are duplicates. A conversation without
    rows after damage has zeros, an empty audit and the hash of nothing; an empty table gives no
    rows. Other columns are not read.
    """
    prepare = damage if damaged else intact
    return repair_turns(with_faults(prepare(df, conv_col, turn_col, role_col, text_col)), block_rows)
