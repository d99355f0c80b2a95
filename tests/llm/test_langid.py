import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from replylens.llm import langid
from tests.llm.helpers import DOCUMENTS, clash, hard_rows


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def profiles(documents):
    return langid.fit_profiles(documents, langid.in_training())


def test_held_out_accuracy(documents, profiles):
    found = langid.identify_languages(documents, profiles).join(documents.select("doc_id", "lang"), "doc_id")
    held = found.filter(~langid.in_training()).collect()
    assert len(held) > 30
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_training_rows(documents):
    for r in documents.select("doc_id", langid.in_training().alias("train")).collect():
        assert r["train"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2)


def test_vector_by_hand():
    encode = langid.Encoder(64)

    def bind(a, b, c):
        return np.roll(encode.letter(ord(a)), 2) * np.roll(encode.letter(ord(b)), 1) * encode.letter(ord(c))

    total = bind(" ", "a", "b") + bind("a", "b", " ") + bind("b", " ", "a") + bind(" ", "a", " ")
    assert encode("AB, 3 a!") == pytest.approx(total / np.linalg.norm(total), abs=1e-6)
    assert langid.Encoder(64)("ab a") == pytest.approx(encode("AB a"))
    assert encode("12 !?") is None and encode(None) is None and encode("") is None


def test_a_small_table_of_grams_changes_nothing(monkeypatch):
    text = " ".join(chr(c) * 2 + chr(c + 1) for c in range(0x4E00, 0x4E00 + 300))
    whole = langid.Encoder(32)(text)
    monkeypatch.setattr(langid, "CACHED_GRAMS", 40)
    assert langid.Encoder(32)(text) == pytest.approx(whole, abs=1e-5)


def test_profile_is_the_mean_direction(documents, profiles):
    encode = langid.Encoder()
    rows = documents.filter(langid.in_training() & (F.col("lang") == "es")).collect()
    total = sum(encode(r["text"]).astype(float) for r in rows)
    place = profiles.languages.index("es")
    assert profiles.prototypes[place] == pytest.approx(total / np.linalg.norm(total), abs=1e-4)


def test_hard_rows(spark, profiles):
    rows = hard_rows()
    found = langid.identify_languages(clash(spark.createDataFrame(rows, DOCUMENTS)), profiles).collect()
    assert len(found) == len(rows)
    blank = [r for r in found if r["lang_pred"] == "und"]
    assert len(blank) == sum(1 for _, t, *_ in rows if not any(c.isalpha() for c in t or ""))
    assert all(r["score"] == 0 for r in blank)


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    none = langid.fit_profiles(empty, F.lit(True))
    assert none.languages == []
    assert langid.identify_languages(empty, none).count() == 0
    one = spark.createDataFrame([(1, "hola", None, None, None)], DOCUMENTS)
    assert tuple(langid.identify_languages(one, langid.fit_profiles(one, F.lit(True))).first()) == (1, "und", 0.0)


def test_filter_keeps_columns(documents, profiles):
    df = clash(documents)
    kept = langid.keep_identified(df, profiles, min_score=0.5)
    assert kept.columns == df.columns
    good = langid.identify_languages(documents, profiles).filter("score >= 0.5")
    assert kept.count() == good.count() < documents.count()


def test_rare_languages_are_learned_in_a_large_table(spark, documents):
    filler = spark.range(10_000).selectExpr(
        "id AS doc_id", "'the words of a short row' AS text", "'en' AS lang", "'s' AS source", "24L AS n_chars"
    )
    rare = [(-1, "это длинный русский текст о погоде", "ru", "s", 0), (-2, "ένα ελληνικό κείμενο", "el", "s", 0)]
    df = documents.unionByName(filler).unionByName(spark.createDataFrame(rare, DOCUMENTS))
    profiles = langid.fit_profiles(df, F.lit(True))
    assert profiles.languages == ["de", "el", "en", "es", "fr", "ru"]
    new = [(1, "русский текст о длинной погоде", None, None, 0), (2, "ελληνικό κείμενο", None, None, 0)]
    found = langid.identify_languages(spark.createDataFrame(new, DOCUMENTS), profiles).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1: "ru", 2: "el"}
    assert langid.keep_identified(df, profiles).filter("doc_id < 0").count() == 2


def test_many_languages(spark):
    rows = [(i, "".join(chr(0x4E00 + i * 5 + k) for k in range(5)), f"l{i:04}", None, 0) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    profiles = langid.fit_profiles(df, F.lit(True))
    assert len(profiles.languages) == 3000
    found = langid.identify_languages(df, profiles).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id']:04}" for r in found)
