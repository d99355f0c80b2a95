import gc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from replylens.llm import packing
from tests.llm.helpers import DOCUMENTS, clash, hard_rows


def library_ids(text):
    library = tokenizers.Tokenizer.from_file(packing.TOKENIZER)
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")


HARD_TEXTS = [
    "", " ", "Hello, World!", "it's I'll we're 'tis don't", "a1b22c 333", "ÀÉÎõü ß İstanbul", "<|endoftext|> x<|startoftext|>y",
    "<|ENDOFTEXT|>", "日本語 テスト", "e\u0301 \u0301x", "ﬁ ǅ Σας ΣΑΣ", "a\u00a0b\u2003c\u200bd", "x\x00y\x1fz", "🙂👍🏽", "...!!!???",
    "line\nline\r\n\ttab\x0bv\x0cf\x85n", "ɏɐ Ɏ", "'S 'T", "''s", "l'été d'a",
]


@pytest.mark.parametrize("text", HARD_TEXTS)
def test_ids_are_those_of_the_library(text):
    encode = packing.Tokenizer()
    for _ in range(2):  # the second time from the tables
        assert encode(text) == library_ids(text).tobytes()


def test_full_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 3)
    monkeypatch.setattr(packing, "CACHED_PARTS", 2)
    encode = packing.Tokenizer()
    text = " ".join(HARD_TEXTS)
    assert encode(text) == library_ids(text).tobytes()


def test_a_tokenizer_goes_with_its_task(spark):
    """Workers are used again by later stages, whose memory it would take."""
    df = spark.createDataFrame([(i, f"uno dos {i}", None, None, 0) for i in range(40)], DOCUMENTS)
    assert packing.tokenised_pieces(df.repartition(8)).count() == 40

    def alive(batches):
        for _ in batches:
            found = [type(x) for x in gc.get_objects()]
            n = sum((x.__module__, x.__name__) == ("replylens.llm.packing", "Tokenizer") for x in found)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32())})

    assert {r["n"] for r in spark.range(0, 8, 1, 8).mapInArrow(alive, "n int").collect()} == {0}


def check(found, rows, capacity, end_id=0):
    pieces = Counter()
    for doc, text, *_ in rows:
        ids = np.append(library_ids(text), end_id).astype("<u4")
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            pieces[doc, number, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in found) == pieces
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_of_a_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = packing.pack_documents(documents).collect()
    used = check(found, rows, packing.CAPACITY)
    counts = np.bincount([r["length"] for r in found], minlength=packing.CAPACITY + 1)
    assert used == packing.lower_bound(counts) == 88
    assert {r["search"] for r in found} == {"proven"}


@pytest.mark.parametrize("capacity", [1, 7, 2048])
def test_hard_rows(spark, capacity):
    rows = hard_rows() if capacity == 2048 else hard_rows()[:8]
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    check(packing.pack_documents(df, capacity=capacity, end_id=5).collect(), rows, capacity, 5)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCUMENTS)).count() == 0


def best_possible(items, capacity):
    """The fewest bins, by trying everything."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= capacity:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def solve(items, capacity, **options):
    """A packing, checked to hold exactly ``items``."""
    counts = np.bincount(items, minlength=capacity + 1)
    solution = packing.complete_bins(counts, **options)
    used = sum((np.bincount(p.lengths, minlength=capacity + 1) * p.times for p in solution.patterns), 0 * counts)
    assert (used == counts).all() and all(sum(p.lengths) <= capacity for p in solution.patterns)
    assert packing.lower_bound(counts) == solution.bound <= solution.bins
    return solution


def test_small_instances_are_solved_exactly():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.integers(8, 40))
        items = sorted(rng.integers(1, capacity + 1, int(rng.integers(1, 11))).tolist(), reverse=True)
        solution = solve(items, capacity)
        assert solution.proven and solution.bins == best_possible(items, capacity)


def test_instances_above_the_lower_bound_are_proven():
    rng = np.random.default_rng(4)
    above = 0
    for _ in range(40):
        items = sorted(rng.integers(20, 70, 12).tolist(), reverse=True)
        solution = solve(items, 100)
        assert solution.proven and solution.bins == best_possible(items, 100)
        above += solution.bins > solution.bound
    assert above


@pytest.mark.parametrize("bins, capacity", [(8, 100), (20, 100), (8, 2048), (20, 2048)])
def test_three_items_fill_each_bin(bins, capacity):
    rng = np.random.default_rng(5)
    for _ in range(12):
        items = []
        for _ in range(bins):
            first = int(rng.integers(capacity // 4, capacity // 2))
            second = int(rng.integers(capacity // 4, max(capacity - first - capacity // 4, capacity // 4) + 1))
            items += [first, second, capacity - first - second]
        solution = solve(items, capacity)
        assert solution.bins == bins and solution.proven


def every_filling(left, capacity):
    """All undominated fillings around the largest item, by trying every selection."""
    largest = max(left)
    rest = list(left)
    rest.remove(largest)
    room = capacity - largest
    chosen = set()
    for size in range(len(rest) + 1):
        chosen.update(tuple(sorted(c, reverse=True)) for c in combinations(rest, size) if sum(c) <= room)

    def dominated(items):
        over = Counter(rest) - Counter(items)
        parts = {c for size in range(len(items) + 1) for c in combinations(items, size)}
        return any(sum(c) <= y <= sum(c) + room - sum(items) and c != (y,) for y in over for c in parts)

    return {(largest, *items) for items in chosen if not dominated(items)}


def test_undominated_fillings_are_all_met():
    rng = np.random.default_rng(6)
    for _ in range(150):
        capacity = int(rng.integers(5, 40))
        left = rng.integers(1, capacity + 1, int(rng.integers(1, 10))).tolist()
        met = list(packing.Fillings(np.bincount(left, minlength=capacity + 1))(lambda: capacity))
        met = [f for f in met if f]
        assert len(met) == len(set(met)) and set(met) == every_filling(left, capacity)
        assert [capacity - sum(f) for f in met] == sorted(capacity - sum(f) for f in met)


def test_an_ended_search_says_so():
    rng = np.random.default_rng(7)
    items = [x for a in rng.integers(26, 49, 20).tolist() for x in (a, 26, 74 - a)]
    assert solve(items, 100, budget=0).proven == (solve(items, 100, budget=0).bins == 20)
    assert solve(items, 100).bins <= solve(items, 100, budget=0).bins


def test_work_does_not_grow_with_the_counts():
    counts = np.bincount([1500, 1400, 700, 640, 500, 300, 48, 3], minlength=2049)
    few, many = packing.complete_bins(counts * 10), packing.complete_bins(counts * 10**9)
    assert len(many.patterns) <= 4 * len(few.patterns) + 10
    assert many.bins >= packing.lower_bound(counts * 10**9)


def test_no_items():
    solution = packing.complete_bins(np.zeros(9, np.int64))
    assert solution.patterns == [] and solution.proven
