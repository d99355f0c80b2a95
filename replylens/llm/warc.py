"""WARC archives in Zstandard with a shared dictionary: writer and reader.

An archive begins with a skippable frame that holds the dictionary; each record is one
frame of its own after it. Files are written and read through Arrow's file systems, so the folder may be
in any store that they know.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from replylens.llm.common import map_batches, new_folder, same, store

MIN_PAYLOAD = 100  # smaller payloads are never replaced by a reference
ARCHIVE_BYTES = 64_000_000  # of payload, after which a task begins another archive
DICTIONARY_BYTES = 64_000
SAMPLE_PAGES = 500  # pages to train the dictionary on, at most
SAMPLE_BYTES = 40_000  # a longer page is not taken as a sample
LEVEL = 3
DICTIONARY_FRAME = 0x184D2A5D  # of the skippable frame, by the format's description
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 20

ARCHIVES = "path string, records long"
RECORDS = (
    "path string, record_type string, page_id long, refers_to long, url string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample of whole pages; empty if there are too few.

    Pages are drawn by a hash of their text, about four times as many as are taken, so
    that no more come to the driver however many tasks there are. Copies count once.
    """
    body = F.col(html_col).cast("binary")
    fitting = pages.filter(F.octet_length(html_col).between(MIN_PAYLOAD, SAMPLE_BYTES)).select(body.alias("body"))
    share = min(1.0, 4 * SAMPLE_PAGES / max(fitting.count(), 1))
    drawn = F.pmod(F.xxhash64("body"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = fitting.filter(drawn).distinct().orderBy(F.xxhash64("body")).limit(SAMPLE_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r["body"]) for r in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response, or a revisit without its payload, with headers and closing line breaks."""
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%-._~")))
    if revisit:
        headers.append(("WARC-Refers-To", _uri(refers_to)))
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    body = b"" if revisit else payload
    headers.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body; raises if a header is missing or malformed or a length is wrong."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header: {line}")
        headers[name.strip().lower()] = value.strip()
    for needed in ("warc-type", "warc-record-id", "warc-payload-digest", "content-length"):
        if needed not in headers:
            raise ValueError(f"no {needed}")
    body, tail = rest[: int(headers["content-length"])], rest[int(headers["content-length"]) :]
    if len(body) != int(headers["content-length"]) or tail != b"\r\n\r\n":
        raise ValueError("the record's length is not that of its header")
    return headers, body


def frames(stream: io.RawIOBase) -> Iterator[bytes]:
    """The contents of the frames after the dictionary, one after another."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the beginning")
    held = stream.read(size)
    if len(held) != size:
        raise ValueError("the dictionary is cut off")
    if held[:4] == zstandard.FRAME_HEADER:
        held = zstandard.ZstdDecompressor().decompress(held)
    options = {"dict_data": zstandard.ZstdCompressionDict(held)} if held else {}
    pending = b""
    while True:
        decoder, parts = zstandard.ZstdDecompressor(**options).decompressobj(), []
        while not decoder.eof:
            if not pending:
                pending = stream.read(READ_BYTES)
                if not pending:
                    if parts:
                        raise ValueError("the last frame is cut off")
                    return
            parts.append(decoder.decompress(pending))
            pending = decoder.unused_data if decoder.eof else b""
        yield b"".join(parts)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(pages: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write ``pages`` (page_id, url, payload, digest, refers_to, revisit) and return
    ``path, records`` of the archives.

    Every attempt of a task writes files of its own name, and the result names only those
    of the attempt that counts, so a repeated task does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        coder = zstandard.ZstdCompressor(level=LEVEL, **options)
        out, name, records, size = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    name, records, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(name, compression=None)
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                data = record(*row)
                out.write(coder.compress(data))
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["path", "records"],
        )

    columns = pages.select("page_id", "url", "payload", "digest", "refers_to", "revisit")
    return store(columns.mapInArrow(run, ARCHIVES), "archives")


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of ``archives`` (path, records), one row each: the columns of ``RECORDS``.

    Headers, lengths, the digest of every payload and the number of records are checked; a
    fault ends the job with the archive's name. A task holds one record at a time. Without
    ``payloads`` that column is null.
    """

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        system, _ = _place(folder)

        def rows_of(path: str, count: int) -> Iterator[tuple]:
            with system.open_input_stream(path, compression=None) as stream:
                found = 0
                for data in frames(stream):
                    headers, body = parse_record(data)
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    revisit = headers["warc-type"] == "revisit"
                    if not revisit and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError("the payload does not have its digest")
                    target = headers.get("warc-target-uri")
                    yield (
                        path, headers["warc-type"], _page(headers["warc-record-id"]),
                        _page(headers["warc-refers-to"]) if revisit else None,
                        None if target is None else unquote(target),
                        digest, None if revisit else len(body), body if payloads and not revisit else None,
                    )
                    found += 1
                if found != count:
                    raise ValueError(f"{found} records instead of {count}")

        def block(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            columns = zip(*rows) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                [column.split()[0] for column in RECORDS.split(", ")],
            )

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                try:
                    for row in rows_of(path, count):
                        rows.append(row)
                        size += 100 + len(row[-1] or b"")
                        if size > READ_BYTES:
                            yield block(rows)
                            rows, size = [], 0
                except (ValueError, zstandard.ZstdError) as fault:
                    raise ValueError(f"{path}: {fault}") from fault
                yield block(rows)

        return each

    spread = archives.select("path", "records").repartition(archives.sparkSession.sparkContext.defaultParallelism * 4)
    return map_batches(spread, make, RECORDS)


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None
) -> tuple[DataFrame, str]:
    """Write every row of ``pages`` as a record; returns the archives and their folder.

    A null html is an empty payload, a null url leaves its header out. Of equal payloads of
    at least ``MIN_PAYLOAD`` bytes the one with the smallest id is a response and those
    with a larger id (or none) refer to it; rows repeated with the smallest id are all responses. Where
    only null ids have a payload, all of them are responses. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.octet_length("payload") >= MIN_PAYLOAD)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    )
    first = store(first.filter("n > 1 and first is not null").select("digest", "first"), "first_pages")
    joined = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~same(F.col("page_id"), F.col("first"))
    planned = joined.select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )
    return write_archives(planned, folder, train_dictionary(pages, html_col)), folder


def page_digests(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record read back; a revisit has the size of the response it refers to."""
    records = store(read_archives(archives, folder, payloads=False), "records")
    responses = (
        records.filter("record_type = 'response'")
        .join(
            records.filter("refers_to is not null").select(F.col("refers_to").alias("page_id")).distinct(), "page_id"
        )
        .groupBy(F.col("page_id").alias("of"), F.col("payload_digest").alias("digest"))
        .agg(F.max("payload_bytes").alias("bytes"))
    )
    matched = records.join(
        store(responses, "responses"),
        (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("digest")),
        "left",
    )
    return matched.select(
        "page_id",
        F.coalesce("payload_bytes", "bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
