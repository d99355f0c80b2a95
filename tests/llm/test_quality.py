import random
import re
from collections import Counter

import numpy as np
import pytest

from replylens.llm import quality
from tests.llm.helpers import DOCUMENTS, clash, hard_rows

BLANK = r"[^\x20\x09-\x0D]+"


def base(text):
    text = text or ""
    words = re.findall(BLANK, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(BLANK, line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def references(documents):
    return quality.fit_references(documents)


def test_counts_match_brute_force(documents, references):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in quality.quality_rules(documents, references).collect():
        assert tuple(r)[1:7] == base(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_hard_rows(spark, references):
    rows = hard_rows() + [(50, "a\na\n\n \n a\nb b b b b b", "en", None, None)]
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    found = Counter(tuple(r)[:7] for r in quality.quality_rules(df, references).collect())
    assert found == Counter((doc, *base(text)) for doc, text, *_ in rows)


def test_references_cover_all_rows(documents, references):
    rows = documents.collect()
    assert references.languages == sorted({r["lang"] for r in rows})
    place = references.languages.index("fr")
    letters = "".join(r["text"] for r in rows if r["lang"] == "fr")
    assert references.classes[place, 0] == pytest.approx(len(re.findall("[a-z]", letters)) / len(letters))
    words = Counter(w for r in rows if r["lang"] == "fr" for w in quality.common_form(r["text"]))
    assert references.shares[place, references.words.index("de")] == pytest.approx(words[b"de"] / (words.total() - words[b""]))
    assert references.shares.sum(axis=1) == pytest.approx(1)


def test_distance():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]])
    assert quality.js_distance(p, q) == pytest.approx([0, 1])


def test_verdicts_follow_the_labels(spark, documents, references):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality.quality_rules(documents, references).join(labels, "doc_id").collect()
    clean = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in rows if r["quality"] == 0]
    assert all(r["kept"] for r in clean)
    assert sum(r["kept"] for r in junk) <= 0.15 * len(junk)


def test_filter_keeps_columns(spark, documents, references):
    df = clash(documents)
    kept = quality.keep_good(df, references)
    assert kept.columns == df.columns
    expected = quality.quality_rules(documents, references).filter("kept")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in expected.collect()}


def test_no_rows_and_no_languages(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    none = quality.fit_references(empty)
    assert none.languages == [] and quality.quality_rules(empty, none).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    bare = spark.createDataFrame([(1, text, None, None, None)], DOCUMENTS)
    assert quality.quality_rules(bare, quality.fit_references(bare)).first()["kept"]


def cyrillic(seed, words):
    rng = random.Random(seed)
    common = ["и", "в", "не", "на", "что", "он", "как", "это", "по", "но"]
    word = lambda: "".join(rng.choice("оеаинтсрвлкмдпуяыьгз") for _ in range(rng.randint(3, 9)))
    return " ".join(rng.choice(common) if rng.random() < 0.4 else word() for _ in range(words)).capitalize() + "."


def test_small_languages_are_kept_in_a_large_table(spark, documents):
    """60 documents of a language, and 3 of another, among 100,000 labelled rows."""
    filler = spark.range(100_000).selectExpr(
        "id AS doc_id", "'the words of a short row' AS text", "'en' AS lang", "'s' AS source", "24L AS n_chars"
    )
    rare = [(-i, cyrillic(i, 120), "ru" if i > 3 else "bg", "s", 0) for i in range(1, 64)]
    df = documents.unionByName(filler).unionByName(spark.createDataFrame(rare, DOCUMENTS))
    references = quality.fit_references(df)
    assert references.languages == ["de", "en", "es", "fr", "ru"]
    found = {r["doc_id"]: r for r in quality.quality_rules(df, references).filter("doc_id < 0").collect()}
    assert len(found) == 63 and all(r["kept"] for r in found.values())
    assert {i: r["reference"] for i, r in found.items()} == {-i: "ru" if i > 3 else None for i in range(1, 64)}
    assert quality.keep_good(df, references).filter("doc_id < 0").count() == 63
    unlabelled = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in rare], DOCUMENTS)
    assert {r["reference"] for r in quality.quality_rules(unlabelled, references).collect()} == {"ru"}


def test_no_verdict_by_a_foreign_reference(spark, references):
    """Unlabelled Russian beside four Latin languages is kept, junk is not."""
    rng = random.Random(9)
    marks = [" ".join("".join(rng.choice("=+~^_@#{}[]/0123456789") for _ in range(6)) for _ in range(200)) for _ in range(5)]
    digits = [" ".join(str(rng.randrange(10**6)) for _ in range(200)) for _ in range(5)]
    rows = [(i, cyrillic(i, 150), None, "s", 0) for i in range(20)]
    rows += [(-1 - i, text, None, "s", 0) for i, text in enumerate(marks + digits)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for frame in (df, df.drop("lang")):
        found = quality.quality_rules(frame, references).collect()
        assert all(r["kept"] == (r["doc_id"] >= 0) and r["reference"] is None for r in found)
        assert {r["doc_id"] for r in quality.keep_good(frame, references).collect()} == set(range(20))


def test_labels_change_no_clean_document(spark, documents, references):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality.quality_rules(documents.drop("lang"), references).join(labels, "doc_id").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])
    junk = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in junk) <= 0.15 * len(junk)


def test_script_is_one_class():
    classes = np.arange(9.0)
    assert quality.without_script(classes).tolist() == [9.0, 2, 3, 4, 5, 6, 7]


def test_word_distances_match_the_whole_table(references):
    counts = np.random.default_rng(1).integers(0, 3, len(references.words) + 1)
    words = np.flatnonzero(counts)
    found = references.word_distances(words, counts[words] / counts.sum())
    assert found == pytest.approx(quality.js_distance(counts / counts.sum(), references.shares))
