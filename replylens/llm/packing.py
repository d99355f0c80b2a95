"""Best-fit packing of tokenised documents by bin completion."""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window, functions as F

from replylens.llm.common import each_value, map_batches, store

CAPACITY = 2048
END_ID = 0
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

BUCKETS = 64  # in which pieces of one length are numbered side by side
SEARCH_BUDGET = 20_000  # fillings looked at before the best packing so far is taken

CACHED_CHUNKS = 600_000
CACHED_PARTS = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int"
PLACES = "sequence_id long, offset long, search string"

# How the tokenizer cuts what white space leaves.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
LATIN_END = "ɏ"  # up to here lower case and composition need no look at neighbours


def byte_characters() -> dict[int, str]:
    """The characters by which a byte-level model spells bytes: printable ones are
    themselves, the others follow from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}


class Tokenizer:
    """Token ids of whole texts as little-endian 32-bit numbers.

    Tokens never cross white space, so a text's ids are those of its chunks one after
    another; equal chunks and equal parts of chunks are encoded once and kept in bounded
    tables. Chunks with special tokens or beyond Latin letters go to the library whole.
    """

    def __init__(self, path: str = TOKENIZER) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.model = self.library.model
        self.characters = byte_characters()
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        """Ids of what the library's model sees as one piece, in its spelling of bytes."""
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= CACHED_PARTS:
                self.parts.clear()
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)
            found = [token.id for token in self.model.tokenize(spelled)]
            ids = self.parts[part] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        lower = text.lower()
        if lower.isascii() and lower.isalpha():
            ids = self.part(lower)
        elif "<|" in text or max(lower) > LATIN_END or not lower.isprintable():
            found = self.library.encode(text, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        else:
            ids = b"".join([self.part(part) for part in PARTS.findall(lower)])
        if len(self.chunks) >= CACHED_CHUNKS:
            self.chunks.clear()
        self.chunks[chunk] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        known, missing = self.chunks.get, self.chunk
        out = []
        for chunk in (text or "").encode().split():
            ids = known(chunk)
            out.append(missing(chunk) if ids is None else ids)
        return b"".join(out)


def tokenised_pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Every document's ids with ``end_id`` after them, cut at ``capacity``, without the ids.

    A task has a tokenizer of its own, whose tables go with it: a Python worker is used again
    by later stages, which need its memory.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        encode = Tokenizer(path)

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), each_value(batch.column(1))):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    check = zlib.crc32(part)
                    bucket = zlib.crc32(repr((doc, piece)).encode(), check) % BUCKETS
                    rows.append((doc, piece, at // 4, len(part) // 4, check, bucket))
            columns = zip(*rows) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                [column.split()[0] for column in PIECES.split(", ")],
            )

        return each

    return map_batches(df.select(id_col, text_col), make, PIECES)


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs; ``counts`` by length, its last index is the capacity.

    For a threshold k, items over capacity - k share a bin with none of k or more, and
    those over half the capacity are alone among themselves.
    """
    capacity = len(counts) - 1
    number, weight = np.cumsum(counts), np.cumsum(np.arange(capacity + 1) * counts)
    half = capacity // 2
    k = np.arange(1, half + 1)
    large = number[-1] - number[half]
    room = (number[capacity - k] - number[half]) * capacity - (weight[capacity - k] - weight[half])
    rest = weight[half] - weight[k - 1] - room
    needed = large + np.maximum(0, -(-rest // capacity))
    return int(max(-(-weight[-1] // capacity), needed.max(initial=large)))


@dataclass
class Pattern:
    lengths: tuple[int, ...]
    times: int


@dataclass
class Solution:
    """Bins that hold all items; ``proven`` if no packing has fewer."""

    patterns: list[Pattern]
    bound: int
    proven: bool

    @property
    def bins(self) -> int:
        return sum(pattern.times for pattern in self.patterns)


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Around the largest item that is left, always the largest that still fits."""
    left, patterns = counts.copy(), []
    while left.any():
        room, now, items = len(left) - 1, left.copy(), []
        while room > 0 and (fits := np.flatnonzero(now[: room + 1])).size:
            x = int(fits[-1])
            times = min(int(now[x]), room // x)
            items += [x] * times
            now[x] -= times
            room -= times * x
        times = fitting_times(left, items)
        left -= np.bincount(items, minlength=len(left)) * times
        patterns.append(Pattern(tuple(items), times))
    return patterns


def fitting_times(left: np.ndarray, items: list[int] | tuple[int, ...]) -> int:
    needed = np.bincount(items, minlength=len(left))
    return int((left[needed > 0] // needed[needed > 0]).min())


def spread(bits: int, reach: int) -> int:
    """The set of ``x + d`` for every x of the bit set and d from 0 to ``reach``."""
    width = 1
    while width <= reach:
        step = min(width, reach + 1 - width)
        bits |= bits << step
        width += step
    return bits


class Fillings:
    """The undominated ways to fill one bin around the largest item of ``left``.

    They come one by one, least waste first, those with longer items before those with
    shorter. ``sums[i]`` has the totals that the i shortest lengths can give, so every
    selection that is begun can be ended.
    """

    def __init__(self, left: np.ndarray) -> None:
        self.largest = int(np.flatnonzero(left)[-1])
        self.room = len(left) - 1 - self.largest
        rest = left[: self.room + 1].copy()
        if self.largest <= self.room:
            rest[self.largest] -= 1
        self.have = rest.tolist()
        self.lengths = np.flatnonzero(rest).tolist()
        self.there = sum(1 << x for x in self.lengths)
        self.sums, inside = [1], (1 << self.room + 1) - 1
        for x in self.lengths:
            now, times, step = self.sums[-1], min(self.have[x], self.room // x), 1
            while times:
                step = min(step, times)
                now |= now << step * x & inside
                times, step = times - step, 2 * step
            self.sums.append(now)

    def selections(self, number: int, total: int) -> Iterator[list[int]]:
        """Selections of the ``number`` shortest lengths that add up to ``total``."""
        if total == 0:
            yield []
            return
        for i in range(bisect_right(self.lengths, total, 0, number) - 1, -1, -1):
            x, below = self.lengths[i], self.sums[i]
            for times in range(min(self.have[x], total // x), 0, -1):
                if below >> total - times * x & 1:
                    for others in self.selections(i, total - times * x):
                        yield [x] * times + others
            if not below >> total & 1:
                return

    def dominated(self, items: list[int], waste: int) -> bool:
        """Whether an item that is left over can take the place of some of ``items``: of one
        that is shorter, of several together, or of the waste."""
        unused = self.there
        for x in set(items):
            if items.count(x) == self.have[x]:
                unused &= ~(1 << x)
        few, several = 1, 0  # totals of at most one item, of two and more
        for x in items:
            several |= several << x | (few & ~1) << x
            few |= 1 << x
        replaced = spread(several, waste)
        if waste:
            replaced |= spread(few << 1, waste - 1)
        return bool(replaced & unused)

    def __call__(self, allowed: Callable[[], int]) -> Iterator[tuple[int, ...] | None]:
        """Fillings that waste no more than ``allowed()``; None for one that is dominated."""
        for waste in range(self.room + 1):
            if waste > allowed():
                return
            if self.sums[-1] >> self.room - waste & 1:
                for items in self.selections(len(self.lengths), self.room - waste):
                    yield None if self.dominated(items, waste) else (self.largest, *items)


@dataclass
class _Node:
    left: np.ndarray
    options: Iterator[Pattern]
    deviations: int
    tried: int = 0


class Completion:
    """Bin completion on a histogram of lengths, within a budget of fillings looked at."""

    def __init__(self, counts: np.ndarray, budget: int) -> None:
        self.counts, self.budget = counts.astype(np.int64), budget
        self.capacity = len(counts) - 1
        self.total = int((np.arange(len(counts)) * self.counts).sum())
        self.bound = lower_bound(self.counts)
        self.best = best_fit(self.counts)
        self.bins = sum(pattern.times for pattern in self.best)

    def allowed(self, wasted: int) -> int:
        """Waste that a packing with fewer bins than the incumbent can still have."""
        return (self.bins - 1) * self.capacity - self.total - wasted

    def options(self, left: np.ndarray, wasted: int) -> Iterator[Pattern]:
        """All fillings around the largest item, each as often as it fits and may waste and
        then, in turn with the fillings that follow, once less."""
        found, capacity = Fillings(left)(lambda: self.allowed(wasted)), self.capacity
        waiting: deque[Pattern] = deque()
        more = True
        while more or waiting:
            filling = next(found, ()) if more and self.budget > 0 else ()
            self.budget -= 1
            more = filling != ()
            if filling:
                waste, times = capacity - sum(filling), fitting_times(left, filling)
                if waste:
                    times = min(times, self.allowed(wasted) // waste)
                if times > 0:
                    yield (now := Pattern(filling, times))
                    waiting.append(now)
            if waiting and filling is not None:
                last = waiting.popleft()
                if last.times > 1:
                    yield (now := Pattern(last.lengths, last.times - 1))
                    waiting.append(now)

    def search(self, limit: int) -> bool:
        """Looks for a better packing; True if it left nothing out.

        ``limit`` bounds by how many options in all a packing may deviate from the first
        ones. A branch ends when its waste or the lower bound of what is left rule out
        fewer bins than the incumbent has, or when the same items were left before.
        """
        whole = True
        path: list[Pattern] = []
        seen: dict[bytes, tuple[int, int]] = {}
        bins = wasted = 0
        stack = [_Node(self.counts, self.options(self.counts, 0), 0)]
        while stack and self.bins > self.bound:
            node = stack[-1]
            deviations = node.deviations + node.tried
            open_ = deviations <= limit and self.budget > 0
            whole &= open_
            choice = next(node.options, None) if open_ else None
            if choice is None:
                whole &= self.budget > 0
                stack.pop()
                if path:
                    last = path.pop()
                    bins -= last.times
                    wasted -= last.times * (self.capacity - sum(last.lengths))
                continue
            node.tried += 1
            waste = choice.times * (self.capacity - sum(choice.lengths))
            if waste > self.allowed(wasted):
                continue
            left = node.left - np.bincount(choice.lengths, minlength=len(node.left)) * choice.times
            if bins + choice.times + lower_bound(left) >= self.bins:
                continue
            if not left.any():
                self.best, self.bins = [*path, choice], bins + choice.times
                continue
            key = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
            before = seen.get(key)
            if before and before[0] <= bins + choice.times and before[1] <= deviations:
                continue
            seen[key] = bins + choice.times, deviations
            path.append(choice)
            bins, wasted = bins + choice.times, wasted + waste
            stack.append(_Node(left, self.options(left, wasted), deviations))
        return whole

    def solve(self) -> Solution:
        limit, whole = 0, False
        while self.bins > self.bound and self.budget > 0 and not whole:
            whole = self.search(limit)
            limit = 2 * limit + 1
        return Solution(self.best, self.bound, whole or self.bins <= self.bound)


def complete_bins(counts: np.ndarray, budget: int = SEARCH_BUDGET) -> Solution:
    """Patterns, each used some times, that hold all items of a histogram of lengths.

    Bins are built around the largest item that is left, with every undominated filling,
    used as often as it fits or less often. The best-fit packing is the first incumbent.
    The search first keeps to the first options, then deviates from them more and more; it
    ends when the incumbent has as many bins as the lower bound, when nothing was left out
    (both prove it least) or when ``budget`` fillings were looked at. It only sees the
    histogram: its work depends on the capacity and the budget, not on the data's size.
    """
    return Completion(counts, budget).solve()


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset`` and ``search``.

    The histogram of lengths, at most ``capacity`` numbers, is all that leaves the
    executors. Pieces of one length are alike: they are numbered (in buckets, so that no
    length is a hot key) and the number says which sequence of which pattern they are in.
    """
    sizes = store(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    solution = complete_bins(counts)
    search = "proven" if solution.proven else "budget"

    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for pattern in solution.patterns:
        offset = 0
        for length in sorted(set(pattern.lengths), reverse=True):
            times = pattern.lengths.count(length)
            entries.setdefault(length, []).append((int(used[length]), sequence, offset, times))
            used[length] += times * pattern.times
            offset += times * length
        sequence += pattern.times
    rows = [(length, *entry) for length in sorted(entries) for entry in entries[length]]
    table = np.array(rows, np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) + table[:, 1]

    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most BUCKETS rows for each possible length.
    offsets = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("number", F.row_number().over(order)).join(
        F.broadcast(offsets), ["length", "bucket"]
    ).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number") - 1).alias("number"))

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            number = batch.column(5).to_numpy(zero_copy_only=False)
            entry = table[np.searchsorted(keys, (length << 48) + number, side="right") - 1]
            inside = number - entry[:, 1]
            places = (entry[:, 2] + inside // entry[:, 4], entry[:, 3] + inside % entry[:, 4] * length)
            columns = [*batch.columns[:5], *(pa.array(x, pa.int64()) for x in places)]
            columns.append(pa.array([search] * batch.num_rows, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:5], "sequence_id", "offset", "search"])

        return each

    narrow = PIECES.removesuffix(", bucket int")
    return map_batches(ranked, make, f"{narrow}, {PLACES}")


def pack_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset, search``: one row per
    piece. ``search`` is ``proven`` in all rows if no packing has fewer sequences, ``budget``
    if the search ended before that was known.

    A null or empty text is the end id alone. Documents of more than ``capacity`` ids are
    cut into pieces of that size; nothing else is cut. Each sequence holds at most
    ``capacity`` ids without gaps. Repeated rows and null ids are packed like any other row;
    other columns are not read. An empty table gives no rows.
    """
    return place_pieces(
        store(tokenised_pieces(df, id_col, text_col, path, capacity, end_id), "pieces"), capacity
    )
