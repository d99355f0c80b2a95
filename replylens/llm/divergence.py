"""Source divergence audit: how far each source of a language uses other words than the rest.

In-mapper stripes: a task folds whole documents into a hash table from term to its stripe, the
number of documents and the count in each source, and spills the table when it is full. The
stripes of a term meet once, sorted by key, and merged stripes give all divergences directly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from replylens.llm.common import store

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000  # of a term's share; taken in three steps of a thousand

CELLS = 250_000  # counts that a task's hash table holds before it is spilled
ROWS = 20_000  # of an Arrow batch that is sent on
PART_TERMS = 8_192  # terms whose divergences are summed as one unit
UNIT_SUMS = 4_000_000  # sums of pairs that a unit holds; more sources are dealt in slices
CHUNK_CELLS = 2_000_000  # terms x sources that are looked at at once

STRIPES = "lang string, term string, documents long, sources array<string>, counts array<long>"
FOUND = "lang string, source string, part string, item string, value long"

# Letters: A-Z (as a-z), a-z and every byte of a character beyond ASCII; the rest separates.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


def _stripe_batches(stripes: dict[str, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
    """The table's stripes; a stripe is {None: documents, source: count, ...}."""
    for lang, own in stripes.items():
        terms = list(own)
        for at in range(0, len(terms), ROWS):
            some = terms[at : at + ROWS]
            documents, offsets, sources, counts = [], [0], [], []
            for term in some:
                stripe = own[term]
                documents.append(stripe.pop(None))
                sources.extend(stripe)
                counts.extend(stripe.values())
                offsets.append(len(counts))
            cut = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some), pa.string()),
                    pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array(documents, pa.int64()),
                    pa.ListArray.from_arrays(cut, pa.array(sources, pa.string())),
                    pa.ListArray.from_arrays(cut, pa.array(counts, pa.int64())),
                ],
                ["lang", "term", "documents", "sources", "counts"],
            )


def _fold(cells: int):
    """Whole documents ``lang, source, text`` to stripes, spilled whenever ``cells`` are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, dict]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                own = stripes.setdefault(lang, {})
                for term, times in Counter(terms_of(text)).items():
                    stripe = own.get(term)
                    if stripe is None:
                        own[term] = {None: 1, source: times}
                        held += 1
                        continue
                    stripe[None] += 1
                    if source in stripe:
                        stripe[source] += times
                    else:
                        stripe[source] = times
                        held += 1
                if held >= cells:
                    yield from _stripe_batches(stripes)
                    stripes, held = {}, 0
        yield from _stripe_batches(stripes)

    return run


def _flat(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).flatten()


def _row_of_cells(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lengths)), lengths)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe for each run of rows with one key; the rows are sorted by it."""
    keys = [batch.column(i) for i in (0, 1)]
    new = np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        changed = pc.or_(*(pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)) for k in keys))
        new[1:] = changed.to_numpy(zero_copy_only=False)
    run = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    documents = np.add.reduceat(batch.column(2).to_numpy(zero_copy_only=False), starts)
    coded = _flat(batch, "sources").dictionary_encode()
    width = max(1, len(coded.dictionary))
    cell = run[_row_of_cells(batch, "sources")] * width + coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    counts = np.add.reduceat(_flat(batch, "counts").to_numpy(zero_copy_only=False)[order], first)
    cut = pa.array(np.searchsorted(cell[first] // width, np.arange(len(starts) + 1)), pa.int32())
    sources = coded.dictionary.take(pa.array(cell[first] % width))
    return pa.RecordBatch.from_arrays(
        [
            *(k.take(pa.array(starts)) for k in keys),
            pa.array(documents, pa.int64()),
            pa.ListArray.from_arrays(cut, sources),
            pa.ListArray.from_arrays(cut, pa.array(counts, pa.int64())),
        ],
        batch.schema.names,
    )


def _merge(min_documents: int):
    """Sorted partial stripes to whole ones of terms in enough documents. Only the last
    stripe of a batch, which may go on in the next one, is carried over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_stripe = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if open_stripe is not None:
                batch = pa.concat_batches([open_stripe.cast(batch.schema), batch])
            merged = _merged(batch)
            open_stripe = merged.slice(merged.num_rows - 1)
            done = merged.slice(0, merged.num_rows - 1)
            yield done.filter(pc.greater_equal(done.column(2), min_documents))
        if open_stripe is not None:
            yield open_stripe.filter(pc.greater_equal(open_stripe.column(2), min_documents))

    return run


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 1) / total)`` by long division: no product leaves 64 bits
    for totals below 9 * 10^15."""
    rest = counts + 1
    share = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest = rest % total
    return share + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Unit:
    """Divergences of the terms of one part of a language, for one slice of its sources."""

    def __init__(self, lang: str, piece: int, pieces: int) -> None:
        self.lang, self.piece, self.pieces = lang, piece, pieces
        self.names: list[str] = []
        self.sizes: list[int] = []
        self.vocabulary = 0
        self.sums: np.ndarray | None = None

    def add_groups(self, names: list[str], sizes: list[int], vocabulary: int) -> None:
        self.names += names
        self.sizes += sizes
        self.vocabulary = vocabulary

    def _begin(self) -> None:
        """All groups are known: the unit's own sources are every ``pieces``-th."""
        self.own = np.arange(self.piece, len(self.names), self.pieces)
        self.sums = np.zeros((len(self.own), len(self.names)), np.int64)
        self.labels = pa.array(self.names, pa.string())
        self.totals = np.array(self.sizes, np.int64) + self.vocabulary
        self.total = sum(self.sizes) + self.vocabulary

    def add_terms(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.sums is None:
            self._begin()
        rows = max(1, CHUNK_CELLS // len(self.names))
        for at in range(0, batch.num_rows, rows):
            yield self._add(batch.slice(at, rows))

    def _add(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        term = _row_of_cells(batch, "sources")
        source = pc.index_in(_flat(batch, "sources"), value_set=self.labels).to_numpy(zero_copy_only=False)
        counts = _flat(batch, "counts").to_numpy(zero_copy_only=False)
        table = np.zeros((batch.num_rows, len(self.names)), np.int64)
        table[term, source] = counts
        here = table > 0
        overall = shares(table.sum(1), self.total)
        p = shares(table, self.totals)
        absent = shares(np.zeros(len(self.names), np.int64), self.totals)
        own = p[term, source]

        for i, a in enumerate(self.own):
            # Terms that the source has are compared in full. Of the others only the counts
            # of other sources differ from the divergence of two absent terms.
            of_source = p[here[:, a]]
            sums = divergence(of_source[:, a : a + 1], of_source).sum(0)
            none = divergence(absent[a], absent)
            others = ~here[term, a]
            np.add.at(sums, source[others], divergence(absent[a], own[others]) - none[source[others]])
            self.sums[i] += sums + (batch.num_rows - len(of_source)) * none

        over = (own > overall[term]) & (source % self.pieces == self.piece)
        n = int(over.sum())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.lang] * n, pa.string()),
                self.labels.take(pa.array(source[over])),
                pa.array(["term"] * n, pa.string()),
                batch.column(batch.schema.get_field_index("name")).take(pa.array(term[over])),
                pa.array(divergence(own[over], overall[term[over]]), pa.int64()),
            ],
            ["lang", "source", "part", "item", "value"],
        )

    def pairs(self) -> Iterator[pa.RecordBatch]:
        if self.sums is None:
            self._begin()
        for i, a in enumerate(self.own):
            others = np.flatnonzero(np.arange(len(self.names)) != a)
            n = len(others)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.lang] * n, pa.string()),
                    pa.array([self.names[a]] * n, pa.string()),
                    pa.array(["pair"] * n, pa.string()),
                    self.labels.take(pa.array(others)),
                    pa.array(self.sums[i][others], pa.int64()),
                ],
                ["lang", "source", "part", "item", "value"],
            )


def _diverge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit, groups before terms, to the unit's divergences."""
    unit, key = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(i).to_pylist() for i in range(5)]
        runs = list(zip(*columns))
        starts = [i for i in range(len(runs)) if i == 0 or runs[i] != runs[i - 1]] + [len(runs)]
        for start, stop in zip(starts, starts[1:]):
            lang, part, piece, pieces, kind = runs[start]
            if (lang, part, piece) != key:
                if unit is not None:
                    yield from unit.pairs()
                unit, key = Unit(lang, piece, pieces), (lang, part, piece)
            rows = batch.slice(start, stop - start)
            if kind == 0:
                names, sizes, words = (rows.column(i).to_pylist() for i in (5, 6, 7))
                unit.add_groups(names, sizes, words[0])
            else:
                yield from unit.add_terms(rows)
    if unit is not None:
        yield from unit.pairs()


def merged_stripes(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, cells: int = CELLS) -> DataFrame:
    """``lang, term, documents, sources, counts`` of the terms in enough documents of a
    language, from rows ``lang, source, text`` without nulls."""
    partial = documents.select("lang", "source", "text").mapInArrow(_fold(cells), STRIPES)
    sorted_rows = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return store(sorted_rows.mapInArrow(_merge(min_documents), STRIPES), "stripes")


def _ranked(found: DataFrame) -> Column:
    group = Window.partitionBy("lang", "source", "part")
    return F.row_number().over(group.orderBy(F.desc("value"), "item"))


def source_divergence(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` holds every other source of the
    language with the divergence from it, part ``term`` the ``top`` terms that a source
    uses more than its language does. All arithmetic is on whole numbers.

    Nulls in the three columns count as ''. A row is a document, also if it is repeated. Ties
    go by the item's bytes. A source alone in its language has no pairs; with no term in enough
    documents all pairs have 0 and there are no terms. An empty table gives no rows. Other
    columns are not read.

    A frequent term is folded in every task, so its key carries one stripe for each task and
    spill, not its occurrences. What is unlike the number of terms is the number of sources: all of
    a language's sources are in memory at once, as the result has a row for each pair of them.
    """
    documents = df.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text")))
    )
    stripes = merged_stripes(documents, min_documents)
    sizes = (
        stripes.select("lang", F.inline(F.arrays_zip("sources", "counts")))
        .groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("size"))
    )
    words = stripes.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    groups = documents.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
    groups = store(groups.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size")), "groups")

    # A language's terms are dealt into parts, and its sources into pieces if there are many.
    numbers = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(words, "lang", "left")
    dealt = store(
        numbers.select(
            "lang",
            F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"),
            F.ceil(F.coalesce("vocabulary", F.lit(0)) / PART_TERMS + F.lit(1e-9)).alias("parts"),
            F.ceil(F.col("sources") * F.col("sources") / UNIT_SUMS).alias("pieces"),
        ),
        "dealt",
    )
    piece = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    nothing = F.lit(None)
    group_rows = groups.join(dealt, "lang").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    ).select(
        "lang", "part", piece, "pieces", F.lit(0).alias("kind"), F.col("source").alias("name"), "size", "vocabulary",
        nothing.cast("array<string>").alias("sources"), nothing.cast("array<long>").alias("counts"),
    )
    term_rows = stripes.drop("documents").join(dealt, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "parts").alias("part"), piece, "pieces", F.lit(1).alias("kind"),
        F.col("term").alias("name"), nothing.cast("long").alias("size"), nothing.cast("long").alias("vocabulary"),
        "sources", "counts",
    )
    unit = ["lang", "part", "piece"]
    units = group_rows.unionByName(term_rows).repartition(*unit).sortWithinPartitions(*unit, "kind", "name")
    found = store(units.mapInArrow(_diverge, FOUND), "divergences")

    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", _ranked(pairs))
    terms = found.filter("part = 'term'")
    terms = terms.withColumn("rank", _ranked(terms)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
