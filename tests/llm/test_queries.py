"""The registered queries: names, shapes, and the SQL of those that have some."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from replylens.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
EXPECTED = {
    "op1_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op2_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op3_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op4_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op5_chat_format": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op6_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op10_pieces": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op11_conversation_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    "op12_source_divergence": {"lang", "source", "part", "item", "value", "rank"},
    "op13_nearest_neighbours": {"query_id", "rank", "vec_id", "score"},
}


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline") == list(range(1, 14))
    assert set(names) <= set(contract.queries())
    assert set(oracle.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", EXPECTED)
def test_columns(spark, name):
    result = queries.queries()[name](spark, SF_DIR)
    assert EXPECTED[name] <= set(result.columns)
    small = ("op5_chat_format", "op8_warc", "op11_conversation_repair", "op13_nearest_neighbours")
    assert result.count() >= 200 or name in small


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    result = queries.queries()[name](spark, SF_DIR)
    assert set(columns) == set(result.columns)
    assert Counter(map(tuple, result.select(columns).collect())) == Counter(cursor.fetchall())
