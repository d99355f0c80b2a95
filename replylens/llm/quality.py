"""Quality rules: divergence of a document's histograms from those of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from replylens.llm.common import filter_batches, map_batches, store

# Character classes by byte: lower case, upper case, digits, blanks, line breaks,
# sentence marks, other ASCII marks, control characters, other code points.
CLASSES = 9
SENTENCE_MARKS = b".,;:?'\"()-"
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"

COMMON_WORDS = 50
MIN_REFERENCE_WORDS = 5_000  # a language with fewer words, in all its rows, gets no reference
MIN_WORDS = 50
MIN_WORDS_FOR_WORDS = 100  # fewer words are too few for a histogram of words
MAX_CLASS_DISTANCE = 0.25
SLACK_WORDS = 20  # a text of n words may be further away by the share SLACK_WORDS / n
MAX_WORD_DISTANCE = 0.5
FLUSH_WORDS = 500_000
# Classes that differ between scripts, not between prose and other matter: letters of either
# case and code points beyond ASCII are one class where a text has no fitting reference.
LETTERS = [0, 1, 8]

STATISTICS = "lang string, kind string, item string, n long"
VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, reference string, "
    "class_distance double, word_distance double"
)


@dataclass
class References:
    """Histograms by language. Of the common words only those that a language has are held:
    entries ``starts[w]`` to ``starts[w + 1]`` of ``places`` (languages) and ``values``
    (shares) belong to word ``w``, the last one being all other words."""

    languages: list[str]
    classes: np.ndarray  # language x class, rows add up to one
    words: list[str]  # common words of all languages
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        """The whole table, language x (word ..., rest), rows add up to one."""
        table = np.zeros((len(self.languages), len(self.words) + 1))
        table[self.places, np.repeat(np.arange(len(self.words) + 1), np.diff(self.starts))] = self.values
        return table

    def word_distances(self, words: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Jensen-Shannon distance, from each language, of a histogram with the shares ``p``
        of ``words``; only words that both have need adding up."""
        first, sizes = self.starts[words], self.starts[words + 1] - self.starts[words]
        at = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        p, q = np.repeat(p, sizes), self.values[at]
        both = p * np.log2(p / (p + q)) + q * np.log2(q / (p + q))
        summed = np.bincount(self.places[at], weights=both, minlength=len(self.languages))
        return np.sqrt(np.clip(1 + summed / 2, 0, 1))


def _class_of_byte() -> np.ndarray:
    table = np.full(256, 6)
    table[:32] = table[127] = 7
    for members, number in (
        (range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t", 3),
        (b"\n\r", 4), (SENTENCE_MARKS, 5), (range(0xC0, 256), 8), (range(128, 0xC0), CLASSES),
    ):
        table[list(members)] = number
    return table  # continuation bytes count for nothing, in a column that is cut off


def class_counts(body: bytes, table: np.ndarray) -> np.ndarray:
    sizes = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    return np.bincount(table, weights=sizes, minlength=CLASSES + 1)[:CLASSES]


def common_form(text: str) -> list[bytes]:
    """Words in lower case, without the marks around them."""
    return [word.strip(b".,;:!?'\"()") for word in text.lower().encode().split()]


def without_script(classes: np.ndarray) -> np.ndarray:
    """Class histograms (last axis) with one class for all letters."""
    return np.concatenate([classes[..., LETTERS].sum(axis=-1, keepdims=True), np.delete(classes, LETTERS, -1)], -1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of ``p`` from each row of ``q``."""
    middle = (p + q) / 2

    def divergence(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / middle), 0).sum(axis=-1)

    both = divergence(np.broadcast_to(p, q.shape)) + divergence(q)
    return np.sqrt(np.clip(both / 2, 0, 1))


def _statistics() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    table = _class_of_byte()

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            found = [(lang, "word", w.decode(), n) for lang, c in words.items() for w, n in c.items() if w]
            found += [(lang, "class", str(i), int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            columns = zip(*found) if found else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "kind", "item", "n"]
            )

        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(common_form(text))
            classes[lang] = classes.get(lang, 0) + class_counts(text.encode(), table)
            if sum(map(len, words.values())) > FLUSH_WORDS:
                yield flush()
                words.clear(), classes.clear()
        yield flush()

    return count


def fit_references(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", common_words: int = COMMON_WORDS
) -> References:
    """Histograms of each language over all its rows: character classes and common words.

    Every language with ``MIN_REFERENCE_WORDS`` words has a reference, whatever its share of
    the table. Rows without text or language give nothing. What comes to the driver: for
    each such language its character classes and its ``common_words`` most common words,
    and how often it has any of those words, as Arrow columns without the zeros.
    """
    texts = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    counted = (
        map_batches(texts, _statistics, STATISTICS)
        .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    )
    counted = store(counted, "language_statistics")
    totals = counted.filter("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("total"))
    large = store(totals.filter(F.col("total") >= MIN_REFERENCE_WORDS), "languages")
    found = large.orderBy("lang").toArrow()
    if not found.num_rows:
        return References([], np.zeros((0, CLASSES)), [], np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0))
    known = counted.join(large, "lang")
    languages = found["lang"].combine_chunks()
    classes = np.zeros((len(languages), CLASSES))
    in_classes = known.filter("kind = 'class'").select("lang", F.col("item").cast("int").alias("item"), "n").toArrow()
    classes[pc.index_in(in_classes["lang"], languages).to_numpy(), in_classes["item"].to_numpy()] = in_classes["n"]
    classes /= np.maximum(classes.sum(axis=1, keepdims=True), 1)
    in_words = known.filter("kind = 'word'").select("lang", "item", "n")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    top = (
        in_words.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= common_words).select("item").distinct()
    )
    top = store(top, "common_words")
    words = pa.array(sorted(top.toArrow()["item"].to_pylist()), pa.string())
    chosen = in_words.join(top, "item").toArrow()
    places = pc.index_in(chosen["lang"], languages).to_numpy()
    items = pc.index_in(chosen["item"], words).to_numpy()
    counts, total = chosen["n"].to_numpy(), found["total"].to_numpy()
    rest = total - np.bincount(places, weights=counts, minlength=len(languages))
    others = np.flatnonzero(rest > 0)
    places = np.concatenate([places, others]).astype(np.int64)
    items = np.concatenate([items, np.full(len(others), len(words))])
    values = np.concatenate([counts, rest[others]]) / total[places]
    by_word = np.lexsort((places, items))
    starts = np.searchsorted(items[by_word], np.arange(len(words) + 2))
    return References(languages.to_pylist(), classes, words.to_pylist(), starts, places[by_word], values[by_word])


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a window of three words that occurs twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, place, times = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    repeated = times[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(repeated)] |= repeated
    return int(covered.sum())


class Judge:
    """Base counts and verdict of one text after another."""

    def __init__(self, references: References, max_class: float, max_word: float) -> None:
        self.references, self.max_class, self.max_word = references, max_class, max_word
        self.table = _class_of_byte()
        self.place = {w.encode(): i for i, w in enumerate(references.words)}
        self.languages = set(references.languages)
        self.prose = without_script(references.classes)

    def distance_from_prose(self, body: bytes) -> float:
        """How far the text's classes are from any language, whatever its script."""
        counts = without_script(class_counts(body, self.table))
        return float(js_distance(counts / max(counts.sum(), 1), self.prose).min())

    def distances(
        self, text: str, body: bytes, n_words: int, lang: str | None
    ) -> tuple[str | None, float, float]:
        """The nearest language and the distances from it; zero where the text is too short
        or its own language has no reference."""
        known, classes, words = self.references, 0.0, 0.0
        if not known.languages or n_words < MIN_WORDS or not (lang is None or lang in self.languages):
            return None, classes, words
        counts = class_counts(body, self.table)
        by_class = js_distance(counts / max(counts.sum(), 1), known.classes)
        by_word = np.zeros(len(known.languages))
        if n_words >= MIN_WORDS_FOR_WORDS:
            rest = len(known.words)
            found = Counter(self.place.get(w, rest) for w in common_form(text))
            counts = np.array(list(found.values()))
            by_word = known.word_distances(np.array(list(found)), counts / counts.sum())
        nearest = int(np.argmin(by_class + by_word))
        return known.languages[nearest], float(by_class[nearest]), float(by_word[nearest])

    def __call__(self, text: str | None, lang: str | None = None) -> tuple:
        text = text or ""
        body = text.encode()
        words = body.split()
        blanks = sum(body.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
        lines = [line for line in body.split(b"\n") if line.strip(BLANKS)]
        repeats = repeated_words(words)
        failed = len(words) < MIN_WORDS or 100 * repeats > 50 * len(words)
        language, by_class, by_word = self.distances(text, body, len(words), lang)
        slack = 1 + SLACK_WORDS / max(len(words), 1)
        if lang is None and not failed and by_class > self.max_class * slack:
            language, by_class, by_word = None, self.distance_from_prose(body), 0.0
        fits = by_class <= self.max_class * slack and by_word <= self.max_word * slack
        return (
            len(words),
            len(text) - blanks,
            len(body) - len(body.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeats,
            failed,
            not failed and fits,
            language,
            by_class,
            by_word,
        )


def quality_rules(
    df: DataFrame,
    references: References,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_class: float = MAX_CLASS_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    lang_col: str = "lang",
) -> DataFrame:
    """The counts, the distances and the verdict for every row of ``df``, in the columns
    of ``VERDICT``.

    A document that passes the base rules is rejected if its histograms lie further than
    ``max_class`` or ``max_word`` from the nearest language reference; histograms of short
    texts vary more by chance, so their limits are wider. Documents under
    ``MIN_WORDS`` words have no distances (0), those under ``MIN_WORDS_FOR_WORDS`` only the
    one of character classes. A null or empty text has no words and fails. Repeated rows
    are judged one by one, ids (null included) are passed on. Only the base rules decide,
    with no ``reference`` and distances of 0, where there is no fitting reference: on rows
    whose ``lang_col`` names a language without one, and everywhere if no language has one.
    Rows without a label (null, or no such column) are held against all references. If the
    classes of the nearest do not fit, they may be in another script: then no ``reference``
    is named, and they are kept if their classes, with letters of all scripts as one, lie
    within ``max_class`` of a language's (``class_distance``; words are not compared). Other
    columns are not read.
    """

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        judge = Judge(references, max_class, max_word)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 2
        names = [column.split()[0] for column in VERDICT.split(", ")]

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = list(map(judge, batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            columns = zip(*rows) if rows else [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

        return each

    lang = F.col(lang_col) if lang_col in df.columns else F.lit(None).cast("string")
    return map_batches(df.select(id_col, text_col, lang.alias("lang")), make, VERDICT)


def keep_good(
    df: DataFrame,
    references: References,
    text_col: str = "text",
    max_class: float = MAX_CLASS_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``df`` that the rules keep, in one pass without a shuffle."""
    labels = [lang_col] if lang_col in df.columns else []

    def make() -> Callable[..., list]:
        judge = Judge(references, max_class, max_word)
        return lambda *columns: [judge(*row)[6] for row in zip(*columns)]

    return filter_batches(df, [text_col, *labels], make)
