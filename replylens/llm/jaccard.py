"""N-gram Jaccard join: size-aware, with subsets for small sets and inverted lists for large ones.

Two documents link when the Jaccard similarity of their shingle sets reaches ``percent``.
A pair of sets of sizes s <= t links exactly when they share ``shared(s, t)`` shingles.

Small sets list all their subsets of that fixed size: sets with a subset in common link
without another look. Large sets have far too many subsets, so they go into inverted lists
of their shingles: all shingles are ordered by how often they occur, rare ones first, and a set is
in the lists of as many of its first shingles as a linking pair cannot both do without.
A passage in many documents is last in their order, and so makes no list of theirs. The
boundary between both ways is the size at which the rows that they make cost least.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from replylens.llm.common import each_value, map_batches, store

WORDS = 3
PERCENT = 90
LARGEST_SMALL = 30  # sizes above are never worth their subsets
LIST_COST = 4  # a row of a list against one of a subset, as its pairs must be compared
COUNTERS = 1 << 20  # of shingles, by hash; they settle the order only, in which any order is exact
CHUNKS = 64  # in which counters are summed
CACHED_WORDS = 50_000  # more take memory and are no faster
KEPT_SETS = 2_000  # of texts just compared
ROUNDS = 6  # of comparing each row with one centre before all open pairs are compared
GAINFUL = 4  # a round is worth another one if it links one of so many rows that it compares
SCARCE = 100  # and one of so many rows whose texts it moves
PARITY_WORDS = 32  # of 64 bits, in which sets of open rows are held against each other
FIRST_LISTS = 32  # of a row that are looked through for an earlier meeting of a pair; any number is exact
MIX = np.uint64(0x9E3779B97F4A7C15)

SETS = "id long, row long, n_shingles long, first long, second long, small array<long>, parity array<long>, chunk int, counts binary"
SUBSETS = "key long, row long, n int, gap int"
LISTED = "key long, row long, n int, most int"


def shared(s: int, t: int, percent: int) -> int:
    """Shingles that sets of sizes s and t must share: 100 * i >= percent * (s + t - i)."""
    return -(-percent * (s + t) // (100 + percent))


def parities(tokens: np.ndarray) -> np.ndarray:
    """2,048 bits: of each residue, whether the set has an odd number of shingles with it. Bits in which
    two sets differ are at most as many as shingles that only one of them has."""
    residues = (tokens % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = (np.bincount(residues, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def largest_partner(s: int, percent: int) -> int:
    return 100 * s // percent


def list_length(n: int, percent: int) -> int:
    """Of a set's shingles so many: a linking partner lacks at most one less of them."""
    return n + (percent * n) // -100 + 1


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def key_of(*parts: int | bytes) -> int:
    return xxhash.xxh64_intdigest(repr(parts)) - 2**63


class Shingler:
    """The set of a text as sorted 64-bit hashes of its shingles."""

    def __init__(self, words: int) -> None:
        self.words, self.seen = words, {}
        self.lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

    def word(self, word: bytes) -> int:
        if len(self.seen) >= CACHED_WORDS:
            self.seen.clear()
        value = self.seen[word] = xxhash.xxh64_intdigest(word)
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().translate(self.lower).split()
        get, make = self.seen.get, self.word
        hashes = np.array([get(w) or make(w) for w in found], np.uint64)
        if len(hashes) == 0:
            return hashes
        span = min(self.words, len(hashes))
        value = np.full(len(hashes) - span + 1, len(found) if span < self.words else 0, np.uint64)
        for i in range(span):
            value = mixed(value + hashes[i : len(hashes) - span + 1 + i])
        return np.unique(value)


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    digest = xxhash.xxh128_intdigest(tokens.tobytes())
    return (digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63


def subset_keys(tokens: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """``(key, gap)`` for every partner size and every subset that such a pair must share.

    Sets under one key link if their sizes differ by the gap: they have the whole subset.
    """
    n = len(tokens)
    for other in range(-(-percent * n // 100), largest_partner(n, percent) + 1):
        low, high = min(n, other), max(n, other)
        for subset in combinations(tokens.tolist(), shared(n, other, percent)):
            yield key_of(low, high, subset), high - low


def list_keys(tokens: np.ndarray, weights: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles in whose lists the set is, and beside each the size of the largest partner
    with which it can be the first shingle that both share: what comes before is lost to both."""
    n = len(tokens)
    order = np.argsort(weights[(tokens % np.uint64(COUNTERS)).astype(np.int64)], kind="stable")
    place = np.arange(list_length(n, percent))
    most = (n - place) * (100 + percent) // percent - n
    return tokens[order[: len(place)]].view(np.int64), most.astype(np.int32)


def _row_id(id_col: str, text_col: str) -> Column:
    """Tells rows apart that share an id (or have none) but not the text."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _sets(words: int) -> Callable:
    """``SETS`` from ``id, row, text``: a row for each text, and at the end of a task its counts
    of shingles, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, counters = Shingler(words), np.zeros(COUNTERS, np.int64)
        names = [field.split()[0] for field in SETS.split(", ")]
        for batch in batches:
            sizes, first, second, small, bits = [], [], [], [], []
            for text in each_value(batch.column(2)):
                tokens = shingle(text)
                a, b = signature(tokens)
                sizes.append(len(tokens)), first.append(a), second.append(b)
                small.append(tokens.view(np.int64).tolist() if len(tokens) <= LARGEST_SMALL else None)
                bits.append(parities(tokens) if len(tokens) else None)
                # A set's shingles differ, but their counters may not.
                np.add.at(counters, (tokens % np.uint64(COUNTERS)).astype(np.int64), 1)
            numbers = [pa.array(x, pa.int64()) for x in (sizes, first, second)]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (small, bits)]
            rest = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), *numbers, *lists, *rest], names
            )
        if counters.any():
            parts = [c.tobytes() for c in np.minimum(counters, 65_535).astype("<u2").reshape(CHUNKS, -1)]
            empty = [pa.nulls(CHUNKS, pa.int64())] * 5 + [pa.nulls(CHUNKS, pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays(
                [*empty, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names
            )

    return run


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks' counts, sorted by chunk, added up."""
    current, total = None, None

    def summed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["chunk", "counts"]
        )

    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if chunk != current:
                if current is not None:
                    yield summed()
                current, total = chunk, np.zeros(COUNTERS // CHUNKS, "<i8")
            total += np.frombuffer(counts, "<u2")
    if current is not None:
        yield summed()


def shingle_weights(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each counter occur, on a logarithmic scale of 16 bits. This
    table of 2 MB is all that leaves the executors."""
    counts = sets.filter("chunk IS NOT NULL").select("chunk", "counts")
    ordered = counts.repartition("chunk").sortWithinPartitions("chunk")
    total = np.zeros((CHUNKS, COUNTERS // CHUNKS), np.int64)
    for row in ordered.mapInArrow(_sum_chunks, "chunk int, counts binary").collect():
        total[row["chunk"]] = np.frombuffer(row["counts"], "<i8")
    return (np.log2(1.0 + total.ravel()) * 1024).astype(np.uint16)


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest size whose sets list subsets, by the rows that both ways make.

    ``sizes`` counts sets by size up to ``LARGEST_SMALL``. Sets just below the boundary go
    into the lists as well, as they may be partners of larger ones.
    """

    def subsets(n: int) -> int:
        partners = range(-(-percent * n // 100), largest_partner(n, percent) + 1)
        return sum(math.comb(n, shared(n, t, percent)) for t in partners)

    def cost(boundary: int) -> int:
        small = sum(m * subsets(n) for n, m in sizes.items() if n <= boundary)
        return small + LIST_COST * sum(
            m * list_length(n, percent) for n, m in sizes.items() if largest_partner(n, percent) > boundary
        )

    return min(range(LARGEST_SMALL + 1), key=cost)


def _subset_rows(percent: int) -> Callable[[], Callable]:
    """From ``row, small``: the keys of a small set's subsets."""

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for row, small in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(set(subset_keys(np.array(small, np.int64).view(np.uint64), percent)))
                keys, gaps = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([row] * len(keys), pa.int64()),
                        pa.array([len(small)] * len(keys), pa.int32()),
                        pa.array(gaps, pa.int32()),
                    ],
                    ["key", "row", "n", "gap"],
                )

        return each

    return make


def _list_rows(words: int, percent: int, boundary: int, shared_weights) -> Callable[[], Callable]:
    """From ``row, text``: the lists of all sets that can have a large partner."""

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        shingle, weights = Shingler(words), shared_weights.value

        def block(keys: list, rows: list, sizes: list, most: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else [], k) for x, k in zip((keys, rows, sizes, most), kinds)],
                ["key", "row", "n", "most"],
            )

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            columns, made = ([], [], [], []), 0
            for row, text in zip(each_value(batch.column(0)), each_value(batch.column(1))):
                tokens = shingle(text)
                if len(tokens) == 0 or largest_partner(len(tokens), percent) <= boundary:
                    continue
                keys, most = list_keys(tokens, weights, percent)
                same_row = (np.full(len(keys), row), np.full(len(keys), len(tokens)))
                for column, values in zip(columns, (keys, *same_row, most)):
                    column.append(values)
                made += len(keys)
                if made > 200_000:
                    yield block(*columns)
                    columns, made = ([], [], [], []), 0
            yield block(*columns)

        return each

    return make


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose sets really link, compared shingle by shingle; ``texts``
    has each row once."""

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        shingle, kept = Shingler(words), {}

        def tokens_of(row: int, text: str) -> np.ndarray:
            tokens = kept.get(row)
            if tokens is None:
                if len(kept) >= KEPT_SETS:
                    kept.clear()
                tokens = kept[row] = shingle(text)
            return tokens

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            linked = []
            for a, b, text_a, text_b in zip(*map(each_value, batch.columns)):
                tokens_a, tokens_b = tokens_of(a, text_a), tokens_of(b, text_b)
                both = len(np.intersect1d(tokens_a, tokens_b, assume_unique=True))
                linked.append(100 * both >= percent * (len(tokens_a) + len(tokens_b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

        return each

    left = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return map_batches(both, make, "a long, b long")


def components(edges: DataFrame, limit: int = 100) -> DataFrame:
    """``row, component``: the smallest row that each row of ``edges`` (a, b) can reach.

    Alternates two steps: every larger neighbour is tied to the smallest neighbour, then
    every smaller one, which shortens long chains quickly. Edges are stored after each step.
    """
    edges = store(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )

    def is_settled() -> bool:
        """Each row has one edge, to a row that has none itself: nothing is left to do."""
        several = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
        inner = edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        return several.union(inner).isEmpty()

    for _ in range(limit):
        if is_settled():
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = store(
            edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(),
            "large_star",
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = store(
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(),
            "small_star",
        )
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("u").alias("row"), F.col("v").alias("component"))
    return found.union(edges.select("v", F.col("v").alias("component"))).distinct()


def _merged(pairs: DataFrame, members: DataFrame | None) -> DataFrame:
    """Components of the rows after adding links to what was joined before."""
    if members is None:
        return store(components(pairs), "components")
    known = members.select(F.col("row").alias("a"), F.col("component").alias("b"))
    return store(components(known.union(pairs)), "components")


def jaccard_components(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, row, main``: the size of each document's set and the
    smallest id that can be reached from it by links. ``row`` tells rows of one id apart,
    and ``main`` is that of the row with the smallest id, then the smallest ``row``.

    Words are what ASCII white space leaves, with A-Z lower-cased. A text of fewer than
    ``words`` words is one shingle. Texts that are null, empty or blank have no shingle and
    are linked with nothing. Rows repeated with the same id and text are in one component
    and each is returned; a null id stays null and counts in a component only if there is
    no other id. Columns other than the two named are not read. An empty table gives no rows.

    A list's entry knows the size of the largest partner with which its shingle can be the first
    one shared. Sets that differ by too many rare shingles thus do not meet, however many
    others they share. Hot groups: copies of one set are tied by its signature, and one of them
    stands in the lists. Then each row is compared with one centre of its lists, up to ``ROUNDS``
    times with other centres as long as that links many, and rows that are connected are never
    compared again. Only in lists where several components remain are all pairs across them that sizes,
    places and parities of their sets allow compared, so that no link is lost. Lists of the same rows
    count as one there, and a pair is made in the first list that both are in.
    """
    spark = df.sparkSession
    texts = df.select(
        F.col(id_col).cast("long").alias("id"),
        _row_id(id_col, text_col).alias("row"),
        F.col(text_col).alias("text"),
    )
    found = store(texts.mapInArrow(_sets(words), SETS), "sets")
    weights = spark.sparkContext.broadcast(shingle_weights(found))
    sets = found.filter("chunk IS NULL").drop("chunk", "counts")
    filled = sets.filter("n_shingles > 0")
    by_set = filled.groupBy("first", "second").agg(F.min("row").alias("b"), F.count("*").alias("n"))
    copies = store(
        filled.join(by_set.filter("n > 1"), ["first", "second"]).select(F.col("row").alias("a"), "b").distinct(),
        "copies",
    )
    sizes = {
        r[0]: r[1]
        for r in filled.filter(F.col("n_shingles") <= LARGEST_SMALL).groupBy("n_shingles").count().collect()
    }
    boundary = choose_boundary(sizes, percent)
    # Of a subset's key all members link, if two sizes that go together are there.
    small = filled.filter(F.col("n_shingles") <= boundary).select("row", "small")
    subsets = store(map_batches(small, _subset_rows(percent), SUBSETS), "subsets")
    linking = store(
        subsets.groupBy("key", "gap")
        .agg(F.min("row").alias("b"), F.max("row").alias("last"), F.min("n").alias("low"), F.max("n").alias("high"))
        .filter("b < last and high - low = gap").select("key", "gap", "b"),
        "linking",
    )
    sure = subsets.join(linking, ["key", "gap"]).select(F.col("row").alias("a"), "b").distinct()
    members = _merged(copies.union(sure), None)

    # Nearly all shingles that are listed have one row; those are combined away before the join,
    # and so are entries that no other entry of their list suits.
    entries = store(
        map_batches(texts.select("row", "text"), _list_rows(words, percent, boundary, weights), LISTED), "entries"
    )
    lists = (
        entries.groupBy("key")
        .agg(F.count("*").alias("rows"), F.min("n").alias("least"), F.max("most").alias("top"))
        .filter("rows > 1").select("key", "least", "top")
    )
    listed = entries.join(lists, "key").filter("most >= least AND n <= top").select("key", "row", "n", "most")
    again = copies.filter("a <> b").select(F.col("a").alias("row"))
    open_rows = _open_lists(store(listed, "listed").join(again, "row", "left_anti"), members)
    # Texts move once, those of rows that have anything to be compared with.
    needed = open_rows.select("row").distinct()
    compared = store(
        texts.select("row", "text").join(needed, "row", "left_semi").dropDuplicates(["row"]), "compared_texts"
    )
    bits = store(sets.select("row", "parity").join(needed, "row", "left_semi").dropDuplicates(["row"]), "bits")
    moved = bits.count()
    for number in range(ROUNDS):
        pairs = _pairs_with_centres(open_rows, bits, number, percent)
        links = store(_verified(pairs, compared, words, percent), "links")
        linked = links.count()
        if linked:
            members = _merged(links, members)
            open_rows = _open_lists(open_rows, members)
        # What a round hardly helps is left to the last step.
        if linked * GAINFUL <= pairs.count() or linked * SCARCE < moved:
            break
    pairs = store(_open_pairs(open_rows, bits, percent).distinct(), "open_pairs")
    members = _merged(store(_verified(pairs, compared, words, percent), "links"), members)
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row"))
    names = members.join(sets.select("row", "id").distinct(), "row").groupBy("component").agg(
        F.min("id").alias("component_id"), first["row"].alias("main")
    )
    named = members.join(names, "component").select("row", "component_id", "main")
    return sets.join(named, "row", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        "row",
        F.coalesce("main", "row").alias("main"),
    )


def _with_component(rows: DataFrame, members: DataFrame, row: str, name: str) -> DataFrame:
    """``rows`` with the component of the row in column ``row``, which is itself if it has none."""
    known = members.select(F.col("row").alias("of"), F.col("component").alias(name))
    return (
        rows.join(known, F.col(row) == F.col("of"), "left").drop("of")
        .withColumn(name, F.coalesce(name, row))
    )


def _suits(n: str, most: str, m: str, other_most: str) -> Column:
    """Whether two entries of a list can be of a linking pair whose first shared shingle it is."""
    return (F.col(n) <= F.col(other_most)) & (F.col(m) <= F.col(most))


def _spare(percent: int) -> Column:
    """Of sets of ``n, parity`` and ``m, other_parity``: by how many fewer bits they differ than
    sets of a linking pair may have shingles that only one of them has."""
    total = F.col("n") + F.col("m")
    common = F.ceil(total * percent / (100 + percent))
    differ = sum(
        (F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("other_parity")[i])) for i in range(PARITY_WORDS)), F.lit(0)
    )
    return total - 2 * common - differ


def _may_reach(percent: int) -> Column:
    """Whether the sets of ``n, parity`` and ``m, other_parity`` differ in no more bits than sets
    of a linking pair have shingles that only one of them has."""
    return _spare(percent) >= 0


def _open_lists(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of lists in which more than one component is left, with their component, as far
    as another entry of the list suits theirs.

    Lists of the same rows, such as those of a passage's shingles, become one under a hash of their
    rows. A row's place in it is that of the first of them in its order, with the largest partner.
    Lists that such a hash mistakes for one only make more pairs.
    """
    placed = _with_component(rows.select("key", "row", "n", "most"), members, "row", "component")
    code = F.xxhash64("row")
    several = (
        placed.groupBy("key")
        .agg(
            F.min("component").alias("x"), F.max("component").alias("y"),
            F.min("n").alias("least"), F.max("most").alias("top"),
            F.xxhash64(
                F.count("*"), F.min("row"), F.max("row"),
                F.sum(F.shiftright(code, 32)), F.sum(code.bitwiseAND(0xFFFFFFFF)),
            ).alias("rows"),
        ).filter("x <> y").select("key", "least", "top", "rows")
    )
    kept = placed.join(several, "key").filter("most >= least AND n <= top")
    merged = kept.groupBy(F.col("rows").alias("key"), "row").agg(
        F.max("n").alias("n"), F.max("most").alias("most"), F.max("component").alias("component")
    )
    return store(merged, "open_rows")


def _pairs_with_centres(open_rows: DataFrame, bits: DataFrame, number: int, percent: int) -> DataFrame:
    """Each row with one row of another component, to be compared.

    Each list has one centre a round, drawn by hash. A row is compared with that of its centres
    whose set differs least from its own by their parities, if it may reach any, so a round compares
    no more pairs than there are rows.
    """
    drawn = F.struct(F.xxhash64("row", F.lit(number)).alias("draw"), "row", "n", "most", "component")
    centres = open_rows.groupBy("key").agg(F.max(drawn).alias("centre")).select(
        "key",
        F.col("centre.row").alias("centre"),
        F.col("centre.n").alias("m"),
        F.col("centre.most").alias("other_most"),
        F.col("centre.component").alias("other"),
    )
    met = (
        open_rows.join(centres, "key")
        .filter((F.col("component") != F.col("other")) & _suits("n", "most", "m", "other_most"))
        .select("row", "n", "centre", "m").distinct()
    )
    others = bits.select(F.col("row").alias("centre"), F.col("parity").alias("other_parity"))
    near = (
        met.join(others, "centre").join(bits, "row")
        .select("row", "centre", _spare(percent).alias("spare")).filter("spare >= 0")
    )
    best = near.groupBy("row").agg(F.max(F.struct("spare", "centre"))["centre"].alias("b"))
    return store(best.select(F.col("row").alias("a"), "b"), "pairs")


def _open_pairs(open_rows: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that lists with several components still leave to be compared.

    One of any two components in a list is not its largest, so rows outside the largest
    are compared with all rows of other components. Most rows of a large family that just
    miss the threshold are told by the parities of their sets, before a pair is made. All sets
    have shingles in one order, so a linking pair meets in the first list that both are in:
    a pair is made there, and in no list for which both are in the same one of their first lists.
    """
    sizes = open_rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = store(
        sizes.groupBy("key").agg(F.max(F.struct("size", "component"))["component"].alias("main")), "largest"
    )
    ordered = F.sort_array(F.collect_list(F.struct("most", "key")), asc=False)
    firsts = open_rows.groupBy("row").agg(F.slice(ordered, 1, FIRST_LISTS).alias("firsts"))
    earlier = F.filter("firsts", lambda first: first["most"] > F.col("most"))
    placed = store(
        open_rows.join(largest, "key").join(firsts.join(bits, "row"), "row")
        .withColumn("before", F.transform(earlier, lambda first: first["key"])).drop("firsts"),
        "placed",
    )
    others = placed.filter("component <> main").select(
        "key",
        F.col("row").alias("a"),
        F.col("n").alias("m"),
        F.col("most").alias("other_most"),
        F.col("component").alias("x"),
        F.col("parity").alias("other_parity"),
        F.col("before").alias("other_before"),
    )
    return (
        others.join(placed, "key")
        .filter((F.col("x") != F.col("component")) & _suits("n", "most", "m", "other_most") & _may_reach(percent))
        .filter(~F.arrays_overlap("before", "other_before"))
        .filter((F.col("component") == F.col("main")) | (F.col("a") < F.col("row")))
        .select(F.least("a", "row").alias("a"), F.greatest("a", "row").alias("b"))
    )


def keep_one_of_each(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Of rows that link, directly or through others, the one with the smallest id stays; rows
    that share an id, or have none, are told apart by their text, and rows without id come
    after all others. Rows without shingles stay. Rows repeated with the same id and text are one
    row here and stay or go together: exact deduplication comes before. An empty table stays
    empty, and all columns stay as they are."""
    found = jaccard_components(df, id_col, text_col, words, percent)
    dropped = store(
        found.filter("row <> main").select(F.col("row").alias("__dropped")).distinct(), "dropped"
    )
    packed = df.select(F.struct("*").alias("__row"), _row_id(id_col, text_col).alias("__id"))
    return packed.join(dropped, F.col("__id") == F.col("__dropped"), "left_anti").select("__row.*")
