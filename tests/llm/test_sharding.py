import zlib
from collections import Counter, defaultdict

import pytest

from replylens.llm import sharding
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text


def check(found, rows, shards=sharding.SHARDS):
    facts = Counter((doc, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for doc, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == facts
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [sizes[s] for s in range(shards)]


def test_documents_of_a_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sharding.shard_rows(documents).collect()
    sizes = check(found, [tuple(r) for r in documents.collect()])
    assert max(sizes) <= 1.03 * min(sizes)
    shards_of = defaultdict(set)
    for r in found:
        shards_of[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards_of.values())


def test_a_text_with_a_third_of_all_rows(spark):
    rows = [(i, make_text(0 if i % 3 else i, 20), None, None, None) for i in range(6000)]
    sizes = check(sharding.shard_rows(spark.createDataFrame(rows, DOCUMENTS)).collect(), rows)
    assert max(sizes) <= 1.1 * min(sizes)


def test_hard_rows(spark):
    rows = hard_rows()
    check(sharding.shard_rows(clash(spark.createDataFrame(rows, DOCUMENTS))).collect(), rows)
    check(sharding.shard_rows(spark.createDataFrame(rows, DOCUMENTS), shards=3, ranges=4).collect(), rows, 3)


def test_empty_table(spark):
    assert sharding.shard_rows(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_assignment_is_even():
    chosen = sharding.assign_ranges({(i, 0): 100 - i for i in range(50)}, 4)
    sizes = Counter()
    for (place, _), shard in chosen.items():
        sizes[shard] += 100 - place
    assert max(sizes.values()) - min(sizes.values()) <= 60


def test_written_shards(spark, tmp_path):
    rows = hard_rows()
    df = spark.createDataFrame(rows, DOCUMENTS)
    sharding.write_shards(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, back.select(df.columns).collect())) == sorted(map(key, rows))


def test_texts_with_one_checksum_are_written_once(spark, tmp_path):
    seen, texts, number = {}, None, 0
    while texts is None:
        for text in (f"t{number}", f"longer text {number}"):
            other = seen.setdefault(zlib.crc32(text.encode()), text)
            if len(other) != len(text):
                texts = [other, text]
        number += 1
    rows = [(None, t, "en", None, 0) for t in texts] + [(None, None, None, None, 0)]
    sharding.write_shards(spark.createDataFrame(rows, DOCUMENTS), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(str(r["text"]) for r in back) == sorted(str(r[1]) for r in rows)
