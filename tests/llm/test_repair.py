import hashlib
import heapq
import random
import zlib
from collections import Counter

import duckdb
import pytest

from replylens.llm import oracle, repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(turns):
    """By Dijkstra over (turns read, state), edits in ASCII order: cost, audit and turns."""
    heap = [(0, "", 0, 0, ())]
    while True:
        cost, audit, at, state, kept = heapq.heappop(heap)
        if at == len(turns) and state in (0, 3):
            return cost, audit, "\n".join(kept)
        follow = {"u": (0, 1, 3), "a": (2,), "s": (0,)}
        reach = {"s": 1, "u": 2, "a": 3}
        if not audit.endswith("III"):
            for role in ("user", "assistant"):
                if state in follow[role[0]]:
                    heapq.heappush(heap, (cost + 5, audit + "I", at, reach[role[0]], (*kept, f"{role}:")))
        if at < len(turns):
            role, text, fault = turns[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, kept))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways = [("K", 0, role)] + [("R", 1, r) for r in ("user", "assistant")]
                for letter, price, new in ways:
                    if state in follow.get(new[:1], ()):
                        turn = (*kept, f"{new}:{text}")
                        heapq.heappush(heap, (cost + price + more, audit + letter, at + 1, reach[new[0]], turn))


def turn_by_turn(turns):
    """The same for long conversations: the best path to each state, one turn after another."""
    follow, reach = {"u": (0, 1, 3), "a": (2,), "s": (0,)}, {"s": 1, "u": 2, "a": 3}

    def with_inserts(best):
        out = dict(best)
        for _ in range(2):
            for state, (cost, audit, kept) in list(out.items()):
                role = "assistant" if state == 2 else "user"
                way = (cost + 5, audit + "I", (*kept, f"{role}:"))
                out[reach[role[0]]] = min(out.get(reach[role[0]], way), way)
        return out

    best = {0: (0, "", ())}
    for role, text, fault in turns:
        ways = {}
        for state, (cost, audit, kept) in with_inserts(best).items():
            options = [(cost + 2, audit + "D", state, kept)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for letter, price, new in [("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")]:
                    if state in follow.get(new[:1], ()):
                        options.append((cost + price + more, audit + letter, reach[new[0]], (*kept, f"{new}:{text}")))
            for price, edits, end, turns_kept in options:
                ways[end] = min(ways.get(end, (price, edits, turns_kept)), (price, edits, turns_kept))
        best = ways
    cost, audit, kept = min(v for q, v in with_inserts(best).items() if q in (0, 3))
    return cost, audit, "\n".join(kept)


def brute_force(rows, damage=True, solve=cheapest):
    out = []
    after = damaged(rows) if damage else [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, faults = set(), [], Counter()
        for _, role, text in turns:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role, text, fault))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, kept = solve(judged)
        digest = hashlib.sha256(kept.encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return Counter(out)


def hard_turns(seed, number):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a.", "b", "c! ", "d?\n", "x.y", "é." * 50]
    roles = ["user", "assistant", "system", None, "", "tool", "unknown"]
    turns = [None, 0, 1, 2, 3, 4, 5, 6, 20]
    return [(rng.choice([None, *range(12)]), rng.choice(turns), rng.choice(roles), rng.choice(texts)) for _ in range(number)]


def found(df, **more):
    return Counter(map(tuple, repair.repair_conversations(df, damaged=True, **more).select(COLUMNS).collect()))


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_hard_rows_against_brute_force(spark, block_rows):
    rows = hard_turns(5, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    named = df.selectExpr("*", "'x' AS text_", "1 AS kind", "2 AS copy", "3 AS block", "4 AS alive", "5 AS first")
    assert found(named, block_rows=block_rows) == brute_force(rows)


def test_sql_on_hard_rows(spark):
    rows = hard_turns(6, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    duck = duckdb.connect()
    duck.register("conversations", df.toArrow())
    cursor = duck.execute(oracle.oracle_sql()["op11_conversation_repair"])
    assert [d[0] for d in cursor.description] == COLUMNS
    assert Counter(cursor.fetchall()) == brute_force(rows) == found(df)


def test_one_long_conversation_in_many_blocks(spark):
    rng = random.Random(8)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"turn {rng.randint(0, 300)}{rng.choice('.!?,')}") for i in range(800)]
    rows += [(i, t, "user", "x.") for i in range(3) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, block_rows=64) == brute_force(rows, solve=turn_by_turn)


def test_without_damage(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "user", "more."), (1, 5, "assistant", "a."), (2, 0, "user", "cut")]
    got = repair.repair_conversations(spark.createDataFrame(rows, SCHEMA)).select(COLUMNS).collect()
    assert Counter(map(tuple, got)) == brute_force(rows, damage=False)
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in got} == {1: (2, "KDKK"), 2: (2, "D")}


def test_empty_table(spark):
    assert not found(spark.createDataFrame([], SCHEMA))


def test_halves_give_the_least_audit():
    rng = random.Random(2)
    for _ in range(200):
        kinds = [(rng.choice(["system", "user", "assistant", "x"]), rng.choice([None, None, "blank", "truncated"])) for _ in range(rng.randint(0, 7))]
        faults = {None: 0, "blank": 1, "truncated": 2}
        steps = bytes((3 * "sua".find(r[0]) if r[0] in "sua" else 9) + faults[f] for r, f in kinds)
        texts, cost, state = repair.edits(steps, repair.START, repair.ENDS)
        expected = cheapest([(r, "", f) for r, f in kinds])
        assert (cost + repair.ENDS[state], "".join(texts) + repair.TAIL[state]) == expected[:2]
        assert turn_by_turn([(r, "", f) for r, f in kinds])[:2] == expected[:2]
