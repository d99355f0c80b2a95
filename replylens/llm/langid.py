"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from replylens.llm.common import filter_batches, map_batches, store

DIMENSIONS = 512
GRAM = 3
SEED = 20_240_229
MIN_SCORE = 0.2
FLUSH_LANGUAGES = 256
CACHED_GRAMS = 40_000
PREDICTION = "doc_id long, lang_pred string, score double"


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # language x dimension, rows of length one


class Encoder:
    """Texts as vectors: letters have random vectors of +1 and -1, a run of three letters
    is the product of its letters' vectors, shifted by their places, and a text is the sum
    over its runs, scaled to length one.

    Everything but letters is one word boundary. A letter's vector follows from its code
    point and the seed alone, so every task has the same ones.
    """

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.is_letter = np.zeros(0x110000, bool)
        self.is_letter[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        self.letters: dict[int, np.ndarray] = {}
        self.row_of: dict[int, int] = {}
        self.rows = np.zeros((CACHED_GRAMS, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions)
            self.letters[code] = (2 * bits - 1).astype(np.float32)
        return self.letters[code]

    def gram(self, key: int) -> np.ndarray:
        vector = np.ones(self.dimensions, np.float32)
        for place in range(GRAM):
            code = (key >> (21 * (GRAM - 1 - place))) & 0x1FFFFF
            vector = vector * np.roll(self.letter(code), GRAM - 1 - place)
        return vector

    def grams(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of many runs of letters, kept for the next text."""
        if len(self.row_of) + len(keys) > CACHED_GRAMS:
            self.row_of.clear()
        if len(keys) > CACHED_GRAMS:
            return np.stack([self.gram(int(k)) for k in keys])
        places = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys.tolist()):
            place = self.row_of.get(key)
            if place is None:
                place = self.row_of[key] = len(self.row_of)
                self.rows[place] = self.gram(key)
            places[i] = place
        return self.rows[places]

    def __call__(self, text: str | None) -> np.ndarray | None:
        """None if the text is null or has no letters."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.is_letter[codes]
        if not letter.any():
            return None
        codes = np.concatenate([[32], np.where(letter, codes, 32), [32]]).astype(np.int64)
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        keys, counts = np.unique(
            (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True
        )
        vector = np.zeros(self.dimensions, np.float32)
        for at in range(0, len(keys), CACHED_GRAMS // 4):  # bounded memory for any alphabet
            part = slice(at, at + CACHED_GRAMS // 4)
            vector += counts[part].astype(np.float32) @ self.grams(keys[part])
        return vector / max(float(np.linalg.norm(vector)), 1e-9)


def in_training(id_col: str = "doc_id") -> Column:
    """Rows to learn from: the checksum of the id, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def _sums() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    encode = Encoder()

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.string()),
                    pa.array([rows[x] for x in sums], pa.int64()),
                    pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64())),
                ],
                ["lang", "n", "total"],
            )

        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            vector = encode(text)
            if vector is not None:
                sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
                rows[lang] = rows.get(lang, 0) + 1
                if len(sums) >= FLUSH_LANGUAGES:
                    yield flush()
                    sums.clear(), rows.clear()
        yield flush()

    return each


def fit_profiles(
    df: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang"
) -> Profiles:
    """The sum of the vectors of all training rows of each language, scaled to length one.

    Every language that a training row names is learned, however rare. Tasks send one sum a
    language and batch; one prototype a language reaches the driver, as Arrow columns of
    ``DIMENSIONS`` numbers. Rows without text, letters or language are not learned from.
    """
    texts = df.filter(train).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    summed = store(
        map_batches(texts.dropna(), _sums, "lang string, n long, total array<double>"), "profiles"
    )
    totals = (
        summed.select("lang", F.posexplode("total").alias("place", "value"))
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("total"))
        .select("lang", F.col("total.value").cast("array<float>").alias("total"))
        .toArrow()
    )
    languages = totals["lang"].to_pylist()
    order = sorted(range(len(languages)), key=languages.__getitem__)
    vectors = totals["total"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    prototypes = vectors.astype(np.float32).reshape(-1, DIMENSIONS)[order]
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return Profiles([languages[i] for i in order], prototypes / np.maximum(lengths, 1e-9))


class Classifier:
    def __init__(self, profiles: Profiles) -> None:
        self.profiles, self.encode = profiles, Encoder()

    def __call__(self, text: str | None) -> tuple[str, float]:
        vector = self.encode(text)
        if vector is None or not self.profiles.languages:
            return "und", 0.0
        cosines = self.profiles.prototypes @ vector
        best = int(np.argmax(cosines))
        return self.profiles.languages[best], float(min(max(cosines[best], 0.0), 1.0))


def identify_languages(
    df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row: the language whose prototype has the
    largest cosine with the text's vector (of equal ones the first by name), and the cosine.

    ``und`` with score 0 if the text is null or has no letters, or if nothing was learned.
    Repeated rows and null ids are passed on; other columns are not read.
    """

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        classify = Classifier(profiles)

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = [classify(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

        return each

    return map_batches(df.select(id_col, text_col), make, PREDICTION)


def keep_identified(
    df: DataFrame, profiles: Profiles, text_col: str = "text", min_score: float = MIN_SCORE
) -> DataFrame:
    """The rows of ``df`` whose language is recognised with at least ``min_score``.

    If nothing was learned, no language can be told: every row whose text has letters stays.
    """

    def make() -> Callable[[list], list]:
        classify = Classifier(profiles)

        def accept(texts: list) -> list:
            if not profiles.languages:
                return [classify.encode(text) is not None for text in texts]
            found = [classify(text) for text in texts]
            return [lang != "und" and score >= min_score for lang, score in found]

        return accept

    return filter_batches(df, text_col, make)
