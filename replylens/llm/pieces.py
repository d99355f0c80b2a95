"""SentencePiece encoding through a table of distinct chunks, and decoding."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame

from replylens.llm.common import map_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"  # the white-space marker of the library
BLOCK_CHARS = 16_000_000  # texts of one block; its table of chunks can be no larger
KEPT_CHUNKS = 400_000  # carried over from block to block

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
FULL = "doc_id long, ids array<int>, decoded string"


class ChunkTable:
    """Segments each distinct chunk once and joins the ids back by position.

    A piece of the model never holds a marker after another character, so no piece crosses
    the place before a marker: a text is cut there. Characters that stand in no longer
    piece (the line break is one) are cut off as well. The library puts a marker before
    what it encodes, hence a chunk is encoded after a line break, and the ids of both are
    then taken off. The assumptions are read off the model; where one does not hold, whole
    texts are encoded.
    """

    def __init__(self, path: str = MODEL) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            self.model.id_to_piece(i)
            for i in range(self.model.get_piece_size())
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
        ]
        self.prefix = self.model.encode("\n")
        self.exact = (
            not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
            and not any("\n" in piece and piece != "\n" for piece in pieces)
            and self.model.encode("\na")[: len(self.prefix)] == self.prefix
            and self.model.encode("a  b") == self.model.encode("a") + self.model.encode(" b")
        )
        self.cut = regex.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.table: dict[str, tuple[int, ...]] = {}

    def segment(self, chunks: list[str]) -> None:
        """Add new chunks to the table."""
        asked = ["\n" + chunk for chunk in chunks]
        for chunk, ids in zip(chunks, self.model.encode(asked, num_threads=1)):
            self.table[chunk] = tuple(ids[len(self.prefix) :])

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.exact:
            return self.model.encode(texts, num_threads=1)
        # The library marks the beginning of every text that is not empty.
        cut = [self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        if len(self.table) > KEPT_CHUNKS:
            self.table.clear()
        self.segment(sorted(set(chain.from_iterable(cut)) - self.table.keys()))
        known = self.table
        return [list(chain.from_iterable([known[chunk] for chunk in chunks])) for chunks in cut]


_tables: dict[str, ChunkTable] = {}


def chunk_table(path: str) -> ChunkTable:
    """One for each Python worker, so that its table outlives a task."""
    if path not in _tables:
        _tables[path] = ChunkTable(path)
    return _tables[path]


def blocks(texts: list[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of ``limit`` characters together, or one longer text, with the
    place of the first."""
    start, block, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if block and size + len(text) > limit:
            yield start, block
            start, block, size = i, [], 0
        block.append(text)
        size += len(text)
    if block:
        yield start, block


def encode_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL
) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of every text, without begin and end, and what the
    library's ``decode(ids)`` makes of them.

    A null or empty text has no ids and decodes to an empty text. Rows are independent:
    repeated rows and null ids are passed on, other columns are not read. Nothing is
    shuffled; memory holds one block of texts and its distinct chunks.
    """
    return _encoded(df, id_col, text_col, path, FULL, lambda ids, decoded: (ids, decoded))


def encode_digests(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL
) -> DataFrame:
    """As ``encode_documents``, with the number of ids and digests instead of the lists."""

    def digests(ids: list[int], decoded: str) -> tuple[int, str, str]:
        joined = ",".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _encoded(df, id_col, text_col, path, ENCODED, digests)


def _encoded(
    df: DataFrame, id_col: str, text_col: str, path: str, schema: str, row: Callable[..., tuple]
) -> DataFrame:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    columns = [column.split() for column in schema.split(", ")]

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        table = chunk_table(path)

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            docs = batch.column(0).cast(pa.int64())
            for start, texts in blocks(batch.column(1).to_pylist()):
                encoded = table.encode(texts)
                rows = [row(ids, table.model.decode(ids) if ids else "") for ids in encoded]
                values = [pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*rows), columns[1:])]
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(start, len(texts)), *values], [name for name, _ in columns]
                )

        return each

    return map_batches(df.select(id_col, text_col), make, schema)
