import hashlib
import io
import struct
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import zstandard

from replylens.llm import warc
from tests.llm.helpers import make_text

PAGES = "page_id long, url string, html string"


def rows():
    big, other = "<html>" + make_text(1, 60), "<p>" + make_text(2, 2000)
    out = [(i, f"http://x/{i}?a=b&c=ñ d\r\nX: y", big if i % 3 == 0 else f"<p>{i} {make_text(i, 40)}") for i in range(5, 60)]
    out += [(1, None, "short"), (2, "u", "short"), (3, "", ""), (4, "u", None), (70, "u", other), (61, "u", other)]
    return out + [(61, "u", other), (None, "u", other), (None, "u", None), (62, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]


def expected(pages):
    groups = defaultdict(list)
    for page, _, html in pages:
        groups[html or ""].append(page)
    out = Counter()
    for html, ids in groups.items():
        body = html.encode()
        first = min((i for i in ids if i is not None), default=None)
        for page in ids:
            revisit = len(body) >= 100 and first is not None and page != first
            kind = ("revisit", first) if revisit else ("response", None)
            out[page, len(body), hashlib.sha256(body).hexdigest(), *kind] += 1
    return out


def test_pages_are_read_back(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], PAGES + ", digest string")
    archives, folder = warc.archive_pages(df)
    found = warc.page_digests(archives, folder)
    assert Counter(tuple(r) for r in found.collect()) == expected(rows())
    records = warc.read_archives(archives, folder).filter("record_type = 'response'").collect()
    texts = Counter((p, h or "") for p, _, h in rows())
    assert all((r["page_id"], bytes(r["payload"]).decode()) in texts for r in records)
    urls = {p: u for p, u, _ in rows()}
    assert all(r["url"] == urls[r["page_id"]] for r in records if r["page_id"] not in (None, 61))


def test_pages_of_a_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = warc.page_digests(*warc.archive_pages(pages))
    assert Counter(tuple(r) for r in found.collect()) == expected([tuple(r) for r in pages.collect()])


def test_empty_table(spark):
    assert warc.page_digests(*warc.archive_pages(spark.createDataFrame([], PAGES))).count() == 0


def archive(spark, count=30):
    pages = spark.createDataFrame([(i, "u", f"<p>{make_text(i, 300)}") for i in range(count)], PAGES).coalesce(1)
    archives, folder = warc.archive_pages(pages)
    return archives, folder, Path(archives.first()["path"])


def test_layout(spark):
    archives, _, path = archive(spark)
    data = path.read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME and data[8 + size : 12 + size] == zstandard.FRAME_HEADER
    assert data[8 + size :].count(zstandard.FRAME_HEADER) == 30 == archives.first()["records"]
    assert len(list(warc.frames(io.BytesIO(data)))) == 30


def test_compressed_dictionary():
    dictionary = zstandard.train_dictionary(4000, [make_text(i, 80).encode() for i in range(300)])
    held = zstandard.compress(dictionary.as_bytes())
    record = warc.record(1, None, b"x", "0", None, False)
    frame = zstandard.ZstdCompressor(dict_data=dictionary).compress(record)
    data = struct.pack("<II", warc.DICTIONARY_FRAME, len(held)) + held + frame * 3
    assert list(warc.frames(io.BytesIO(data))) == [record] * 3


@pytest.mark.parametrize("fault", ["cut", "lost", "magic", "digest"])
def test_faults_are_found(spark, fault):
    archives, folder, path = archive(spark, 5)
    data = path.read_bytes()
    if fault == "cut":
        path.write_bytes(data[:-3])
    elif fault == "lost":
        path.write_bytes(data[: data.rindex(zstandard.FRAME_HEADER)])
    elif fault == "magic":
        path.write_bytes(b"x" + data[1:])
    else:
        size = struct.unpack("<I", data[4:8])[0]
        options = {"dict_data": zstandard.ZstdCompressionDict(data[8 : 8 + size])} if size else {}
        bad = warc.record(9, "u", b"payload", "0" * 64, None, False)
        path.write_bytes(data[: data.rindex(zstandard.FRAME_HEADER)] + zstandard.ZstdCompressor(**options).compress(bad))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="warc.zst"):
        warc.read_archives(archives, folder).collect()


@pytest.mark.parametrize(
    "data",
    [b"x", b"WARC/1.1\r\nno colon\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n",
     warc.record(1, None, b"abc", "0", None, False)[:-1], warc.record(1, None, b"abc", "0", None, False) + b"x"],
)
def test_records_are_validated(data):
    with pytest.raises(ValueError):
        warc.parse_record(data)
