import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from replylens.llm import exact
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text


def expected(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[text or ""].append(doc)
    out = Counter()
    for text, docs in groups.items():
        best = max((d for d in docs if d is not None), default=None)
        seen = False
        for doc in docs:
            kept = doc == best and not seen
            seen |= kept
            out[doc, best, len(docs), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def found(df, **how):
    return Counter(tuple(r) for r in exact.exact_duplicates(df, **how).collect())


def test_hard_rows(spark):
    rows = hard_rows()
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    assert found(df) == expected(rows)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_every_depth_of_blocks(spark, block):
    texts = ["", "a", "aa", "aaa", "aaaa", "aaaaa", "aaaaab", "baaaa", "aabaa", "ñandú", "ñandu", "aaaa", "ñandú"]
    texts += [make_text(i % 7, 40) for i in range(20)] + [make_text(3, 40) + "x"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, DOCUMENTS), block_bytes=block) == expected(rows)


def test_one_text_with_a_third_of_all_rows(spark):
    rows = [(i, make_text(0 if i % 3 else i, 30), None, None, None) for i in range(3000)]
    assert found(spark.createDataFrame(rows, DOCUMENTS), block_bytes=32) == expected(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCUMENTS)) == Counter()
    assert exact.drop_exact_duplicates(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_rows_that_stay_have_their_columns(spark):
    rows = hard_rows()
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    kept = exact.drop_exact_duplicates(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert Counter(r["text"] or "" for r in got) == Counter({t or "": 1 for _, t, *_ in rows})
    assert all(r["shard"] == "x" for r in got)


def test_a_row_repeated_a_million_times(spark):
    """Rows alike in id and text: counted, written out in parts, and one of them stays."""
    alike = spark.range(0, 1_000_000, 1, 8).selectExpr(
        "cast(null as long) AS doc_id", "'' AS text", "'en' AS lang", "concat('s', 9 - id % 7) AS source", "0L AS n_chars"
    )
    others = [(1, "uno", "es", None, 3), (2, "uno", "es", None, 3), (None, None, None, "s0", None)]
    df = alike.unionByName(spark.createDataFrame(others, DOCUMENTS))
    flags = exact.exact_duplicates(df)
    got = {tuple(r)[:4]: r["n"] for r in flags.groupBy("doc_id", "keep_id", "group_size", "kept").agg(F.count("*").alias("n")).collect()}
    assert got == {
        (None, None, 1_000_001, True): 1, (None, None, 1_000_001, False): 1_000_000, (1, 2, 2, False): 1, (2, 2, 2, True): 1,
    }
    kept = exact.drop_exact_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, ""), (2, "uno")]


def test_copies_are_written_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(exact, "COPIES_AT_ONCE", 4)
    rows = [(i, make_text(i, 5), None, None, None) for i in range(12) for _ in range(i + 1)]
    assert found(spark.createDataFrame(rows, DOCUMENTS)) == expected(rows)
