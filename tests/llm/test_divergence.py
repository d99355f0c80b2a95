import re
from collections import Counter, defaultdict

import pytest

from replylens.llm import divergence
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, min_documents=3, top=200):
    documents, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        documents[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang, found in documents.items():
        kept = [t for t, n in found.items() if n >= min_documents]
        sources = [s for own, s in counts if own == lang]

        def share(count, total):
            return 1 + 1_000_000_000 * (count + 1) // (total + len(kept))

        size = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], size[s]) for t in kept} for s in sources}
        whole = sum(size.values())
        q = {t: share(sum(counts[lang, s][t] for s in sources), whole) for t in kept}
        for a in sources:
            pairs = [(b, sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept)) for b in sources if b != a]
            terms = [(t, (p[a][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, a, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return Counter(out)


def found(df, **more):
    return Counter(map(tuple, divergence.source_divergence(df, **more).select(COLUMNS).collect()))


def rows_of(df):
    return [(r["lang"], r["source"], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("limits", [{}, {"PART_TERMS": 50, "UNIT_SUMS": 3, "CHUNK_CELLS": 64}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    words = [f"{'xyz'[i % 3]}{make_text(i % 11, 1 + i % 40)} the The é{i % 9}" for i in range(240)]
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}" if i % 5 else "hot", 0) for i, t in enumerate(words)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert found(df, top=7) == brute_force(rows_of(df), top=7)


def test_spills_change_nothing(spark):
    df = spark.createDataFrame([(i, make_text(i % 5, 50), "en", f"s{i % 3}", 0) for i in range(60)], DOCUMENTS)
    named = df.select("lang", "source", "text")
    key = lambda d: sorted(
        (r["term"], r["documents"], tuple(sorted(zip(r["sources"], r["counts"])))) for r in d.collect()
    )
    assert key(divergence.merged_stripes(named, cells=7)) == key(divergence.merged_stripes(named))


def test_hard_rows(spark):
    df = spark.createDataFrame(hard_rows() + [(50 + i, "", "xx", f"s{i}", 0) for i in range(3)], DOCUMENTS)
    expected = brute_force(rows_of(df))
    assert found(clash(df)) == expected
    # Without a term in three documents every pair is there and has 0.
    assert {r[4] for r in expected if r[0] == "xx"} == {0}


def test_empty_table(spark):
    assert not found(spark.createDataFrame([], DOCUMENTS))


def test_shares_are_exact_for_large_counts():
    import numpy as np

    for count, total in ((10**12, 3 * 10**15), (8 * 10**15, 8 * 10**15 + 1), (0, 10**15)):
        assert divergence.shares(np.array([count]), total)[0] == 1 + 10**9 * (count + 1) // total
