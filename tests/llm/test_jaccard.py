import random
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from replylens.llm import jaccard
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text


def shingles(text, n=3):
    lower = (text or "").encode().lower().split()
    if len(lower) < n:
        return frozenset([tuple(lower)] if lower else [])
    return frozenset(zip(*(lower[i:] for i in range(n))))


def test_words_kept_by_a_task_take_little_memory():
    text = " ".join(f"word{i}" for i in range(300_000))
    shingle = jaccard.Shingler(5)
    tracemalloc.start()
    found = shingle(text)
    kept = tracemalloc.get_traced_memory()[0] - found.nbytes
    tracemalloc.stop()
    assert len(found) == 299_996 and kept < 16e6


def brute_force(rows, n=3, percent=90):
    sets = [shingles(t, n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both, same_row = len(sets[i] & sets[j]), rows[i][:2] == rows[j][:2]
        if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) or same_row:
            root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            ids[find(i)] = min(ids.get(find(i), row[0]), row[0])
    return Counter((row[0], len(sets[i]), ids.get(find(i), row[0])) for i, row in enumerate(rows))


def found(df, **how):
    rows = jaccard.jaccard_components(df, **how).collect()
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def near_copies(seed, words, copies, changes):
    rng = random.Random(seed)
    base = make_text(seed, words).split()
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(len(text))] = make_text(rng.random(), 1)
        yield " ".join(text)


def test_hard_rows(spark):
    rows = hard_rows()
    assert found(clash(spark.createDataFrame(rows, DOCUMENTS))) == brute_force(rows)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_near_copies_of_all_sizes(spark, words, percent):
    texts = []
    for i, size in enumerate([3, 4, 5, 6, 8, 11, 12, 13, 14, 20, 22, 23, 24, 31, 45, 80, 200]):
        texts += near_copies(i, size, 12, max(1, size // 20))
    passage = make_text(99, 60)
    texts += [f"{make_text(500 + i, 40)} {passage}" for i in range(40)]
    rows = [(i * 7 % 1000, t, None, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert found(df, words=words, percent=percent) == brute_force(rows, words, percent)


def test_a_group_with_a_third_of_all_rows(spark):
    texts = list(near_copies(5, 120, 150, 3)) + [make_text(900 + i, 60) for i in range(300)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, DOCUMENTS)) == brute_force(rows)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_common_passages_and_large_groups_together(spark, words, percent):
    passage = make_text(77, 50)
    texts = [f"{make_text(i, 30 + i)} {passage} {make_text(1000 + i, 20)}" for i in range(60)]
    texts += list(near_copies(6, 100, 40, 4)) + list(near_copies(8, 90, 30, 30))
    for i in range(0, 60, 4):
        texts += list(near_copies(0, 1, 0, 0)) + [texts[i] + " end", "start " + texts[i]]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, DOCUMENTS), words=words, percent=percent) == brute_force(rows, words, percent)


def test_the_bounds_behind_the_lists():
    for percent in (60, 80, 90):
        for s in range(1, 400):
            listed = jaccard.list_length(s, percent)
            assert 1 <= listed <= s
            for t in range(s, jaccard.largest_partner(s, percent) + 1):
                both = jaccard.shared(s, t, percent)
                assert 100 * both >= percent * (s + t - both) and 100 * (both - 1) < percent * (s + t - both + 1)
                assert s - both < listed and t - both < jaccard.list_length(t, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_linking_sets_meet_in_the_list_of_their_first_shared_shingle(percent):
    rng = np.random.default_rng(0)
    weights = rng.integers(0, 9, jaccard.COUNTERS).astype(np.uint16)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(3, 200))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        other = rng.integers(0, 2**63, int(rng.integers(0, max(2, n // 5)))).astype(np.uint64)
        b = np.unique(np.concatenate([a[int(rng.integers(0, max(2, n // 5))) :], other]))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both):
            continue
        linked += 1
        of_a, of_b = (dict(zip(*(x.tolist() for x in jaccard.list_keys(t, weights, percent)))) for t in (a, b))
        assert any(len(b) <= of_a[key] and len(a) <= of_b[key] for key in of_a.keys() & of_b.keys())
    assert linked > 100


def test_rare_shingles_come_first():
    tokens = np.arange(100, dtype=np.uint64)
    weights = np.zeros(jaccard.COUNTERS, np.uint16)
    weights[:90] = 7
    keys, most = jaccard.list_keys(tokens, weights, 90)
    assert keys.tolist() == [*range(90, 100), 0] and most[0] == 111
    # After six shingles that the other lacks, only smaller sets can be partners.
    assert most[6] < 100 <= most[5]


def test_counts_of_shingles_cover_all_texts(spark):
    rows = [(i, "one two three four" if i % 2 else f"w{i} x y", None, None, None) for i in range(40)]
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(5).selectExpr("doc_id AS id", "doc_id AS row", "text")
    weights = jaccard.shingle_weights(df.mapInArrow(jaccard._sets(3), jaccard.SETS))
    common = jaccard.Shingler(3)("one two three four") % np.uint64(jaccard.COUNTERS)
    assert (weights > 0).sum() == 22
    assert (weights[common.astype(int)] == int(np.log2(21) * 1024)).all()


def test_boundary_follows_the_cost():
    assert jaccard.choose_boundary({}, 90) == 0
    assert 5 <= jaccard.choose_boundary({n: 100 for n in range(1, 31)}, 90) < 25


def test_chains_become_one_component(spark):
    edges = spark.range(200).selectExpr("(id * 7919) % 200 AS a", "((id * 7919) % 200 + 1) AS b")
    rows = jaccard.components(edges.unionByName(spark.createDataFrame([(900, 901)], "a long, b long"))).collect()
    assert {r["component"] for r in rows if r["row"] <= 200} == {0}
    assert {r["row"]: r["component"] for r in rows if r["row"] >= 900} == {900: 900, 901: 900}
    assert len(rows) == 203


def test_empty_table_and_rows_that_stay(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert found(empty) == Counter() and jaccard.keep_one_of_each(empty).count() == 0
    rows = [(i, t, "en", None, None) for i, t in enumerate(near_copies(3, 150, 6, 2))] + [(9, None, "en", None, None)]
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    kept = jaccard.keep_one_of_each(df, words=5, percent=80)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, n, c in brute_force(rows, 5, 80)}


def test_survivors_under_repeated_and_null_ids(spark):
    """Of near copies one stays, also where ids repeat or are missing."""
    texts = list(near_copies(3, 150, 5, 2))
    for ids in ([1, 1, 1, None, None], [None] * 5, [4, 2, 2, 9, None]):
        rows = [(i, t, "en", None, None) for i, t in zip(ids, texts)]
        df = spark.createDataFrame(rows, DOCUMENTS)
        kept = jaccard.keep_one_of_each(df, words=5, percent=80).collect()
        assert len(kept) == 1
        assert kept[0]["doc_id"] == min((i for i in ids if i is not None), default=None)


@pytest.mark.parametrize("percent", [80, 90])
def test_parities_never_part_a_linking_pair(spark, percent):
    """And they part most pairs of a family that stays below the threshold."""
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 400))).astype(np.uint64))
        lost = rng.integers(0, max(2, len(base) * (110 - percent) // 100), 2)
        a, b = base[int(lost[0]) :], base[: len(base) - int(lost[1])]
        if len(a) == 0 or len(b) == 0:
            continue
        both = len(np.intersect1d(a, b))
        links = 100 * both >= percent * (len(a) + len(b) - both)
        rows.append((len(a), len(b), jaccard.parities(a).tolist(), jaccard.parities(b).tolist(), links))
    df = spark.createDataFrame(rows, "n int, m int, parity array<long>, other_parity array<long>, links boolean")
    counts = {tuple(r)[:2]: r["count"] for r in df.groupBy("links", jaccard._may_reach(percent).alias("may")).count().collect()}
    assert (True, False) not in counts and counts[True, True] > 50
    assert counts[False, False] > counts[False, True] > 0


def test_large_families_around_the_threshold(spark):
    """Many copies of one text, most pairs of which just miss the threshold, beside some that reach it."""
    texts = list(near_copies(21, 100, 150, 9)) + list(near_copies(22, 60, 80, 5))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, DOCUMENTS)) == brute_force(rows)
    assert len({c for _, _, c in brute_force(rows)}) > 20


@pytest.mark.parametrize(("words", "percent", "first_lists"), [(3, 90, 32), (5, 80, 32), (2, 60, 32), (5, 80, 1)])
def test_a_pair_is_made_in_one_of_its_lists(spark, monkeypatch, words, percent, first_lists):
    """Without rounds all pairs are left to the last join; it makes each once, however many lists both are in."""
    made, join = [], jaccard._open_pairs

    def counted(*given):
        pairs = jaccard.store(join(*given), "made")
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard, "_open_pairs", counted)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "FIRST_LISTS", first_lists)
    passage = make_text(78, 90)
    texts = list(near_copies(31, 100, 60, 12)) + list(near_copies(32, 70, 30, 4))
    texts += [f"{make_text(2000 + i, 8)} {passage} {make_text(3000 + i, 4 + i % 9)}" for i in range(40)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    rows += rows[::7] + [(1000 + i, t, None, None, None) for i, t in enumerate(texts[::9])]
    assert found(spark.createDataFrame(rows, DOCUMENTS), words=words, percent=percent) == brute_force(rows, words, percent)
    if first_lists > 1:
        assert made[0][0] == made[0][1] > 0


def test_lists_of_the_same_rows_become_one(spark):
    """Of a passage's shingles each has a list of the same rows."""
    entries = [(key, row, 50, 60 - key) for key in range(10) for row in (1, 2, 3)]
    entries += [(20, 1, 50, 40), (20, 2, 50, 70), (21, 1, 50, 39), (21, 4, 50, 60), (22, 5, 50, 60), (22, 6, 50, 60)]
    rows = spark.createDataFrame(entries, "key long, row long, n int, most int")
    members = spark.createDataFrame([(5, 5), (6, 5)], "row long, component long")
    kept = jaccard._open_lists(rows, members).collect()
    # The larger one of a row's own partners counts; 20 and 21 lose a row that suits no other.
    assert Counter((r["row"], r["most"], r["component"]) for r in kept) == Counter([(1, 60, 1), (2, 60, 2), (3, 60, 3), (2, 70, 2), (4, 60, 4)])
    assert len({r["key"] for r in kept}) == 3
