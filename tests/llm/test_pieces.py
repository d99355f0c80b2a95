import hashlib
from collections import Counter

import pytest
import sentencepiece

from replylens.llm import pieces
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n", "a\nb", " \n \n", "\na b", "a \n b", "▁", "a▁b", "▁▁a",
    "<s>x</s>", "<unk>", "<0x0A>", "tab\tx", "\r\n", "日本 語", "🙂 x", "e\u0301", "\x00\x01", "Ünï çödé", "a" * 300,
    " " * 40 + "x", "\u00a0x\u3000y", make_text(4, 500),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_ids_are_those_of_the_library(library):
    table = pieces.ChunkTable()
    assert table.exact
    for _ in range(2):
        assert table.encode(TEXTS) == [library.encode(t) for t in TEXTS]


def test_each_chunk_is_segmented_once(monkeypatch):
    table, asked = pieces.ChunkTable(), []
    segment = table.segment
    monkeypatch.setattr(table, "segment", lambda chunks: (asked.extend(chunks), segment(chunks)))
    table.encode(["one two one", "two three\none"])
    table.encode(["three two"])
    assert max(Counter(asked).values()) == 1 and len(asked) == 5


def test_table_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 2)
    table = pieces.ChunkTable()
    for text in TEXTS:
        assert table.encode([text]) == [library.encode(text)]


def test_blocks_keep_all_texts():
    texts = ["a" * 5, None, "b" * 30, "", "c", "d" * 9]
    found = list(pieces.blocks(texts, 10))
    assert [t for _, block in found for t in block] == [t or "" for t in texts]
    assert [start for start, _ in found] == [0, 2, 3]


def expected(library, rows):
    out = Counter()
    for doc, text, *_ in rows:
        ids = library.encode(text or "")
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids) if ids else "")]
        out[doc, len(ids), *digests] += 1
    return out


def test_rows(spark, library):
    rows = hard_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    assert Counter(tuple(r) for r in pieces.encode_digests(df).collect()) == expected(library, rows)
    first = pieces.encode_documents(df.filter("doc_id = 5")).first()
    assert (first["ids"], first["decoded"]) == (library.encode(rows[5][1]), library.decode(library.encode(rows[5][1])))


def test_documents_of_a_table(spark, library):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in documents.collect()]
    assert Counter(tuple(r) for r in pieces.encode_digests(documents).collect()) == expected(library, rows)


def test_empty_table(spark):
    assert pieces.encode_digests(spark.createDataFrame([], DOCUMENTS)).count() == 0
