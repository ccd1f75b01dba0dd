"""WARC archives: exact round trip, revisits, and damaged files."""

import base64
import hashlib
import struct

import plain
import pytest
import zstandard
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareline.llm import warc
from fareline.session import scratch_path

PAGES = StructType(
    [
        StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()),
        StructField("first", StringType()), StructField("sha1", StringType()), StructField("payload", StringType()),
    ]
)
ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/é", "<p>two</p>"), (3, None, "<p>one</p>"), (4, "http://d/", None),
    (5, "bad\r\nWARC-Type: x", ""), (None, "http://f/", "<p>one</p>"), (None, "http://g/", "alone"),
    (None, "http://h/", "alone"), (7, "http://i/", "x" * 300_000), (8, "http://j/", "tail\r\n\r\nWARC/1.1\r\n"),
    (9, "http://k/", "<p>two</p>"), (9, "http://k/", "<p>two</p>"), (2, "http://b/é", "<p>two</p>"),
    (10, "http://l/", "日本 \x00 é"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "f", "s", "p") for r in rows], PAGES).repartition(3)


def expected(rows, revisit_from=0):
    by_payload = {}
    for page_id, _, html in rows:
        if page_id is not None:
            by_payload[html or ""] = min(page_id, by_payload.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = by_payload.get(html or "") if len(data) >= revisit_from else None
        again = first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", first if again else None))
    return plain.sorted_rows(out)


def got(df):
    return plain.sorted_rows((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


@pytest.mark.parametrize("revisit_from", [0, 11])
def test_round_trip_of_odd_pages(spark, revisit_from):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark), path, revisit_from)
    records = warc.read_archives(spark, path)
    assert got(records) == expected(ROWS, revisit_from)
    texts = {(r.page_id, bytes(r.payload).decode()) for r in records.collect() if r.record_type == "response"}
    assert texts <= {(i, h or "") for i, _, h in ROWS}
    uris = {r.target_uri for r in records.collect()}
    assert "urn:page:3" in uris and "bad%0D%0AWARC-Type:%20x" in uris


def test_round_trip_of_all_pages(spark):
    table = spark.read.parquet(f"{plain.SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    path = scratch_path(spark, "archives")
    warc.write_archives(table, path)
    assert got(warc.read_archives(spark, path)) == expected(rows)


def test_no_pages_no_archive(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def archive(count=40):
    records = [warc.record(k, f"http://x/{k}", b"<html>" + b"word " * k, warc.base32_sha1(b"<html>" + b"word " * k), None, False, "2020-01-01T00:00:00Z") for k in range(count)]
    separator = warc.EMPTY_FRAME.encode("latin-1")
    return records, b"".join(f + separator for f in warc._compressed(iter(records)))


def test_archive_layout():
    """The dictionary leads; any Zstandard reader finds one frame per record."""
    records, data = archive()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC and 0 < size <= warc.DICTIONARY_BYTES
    assert [d for _, d in warc.frames(data)] == records
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    assert reader.stream_reader(data, read_across_frames=True).read() == b"".join(records)
    few, small = archive(2)  # too little to train on: no dictionary, still readable
    assert small[:4] == struct.pack("<I", warc.FRAME_MAGIC) and [d for _, d in warc.frames(small)] == few


@pytest.mark.parametrize("harm, message", [
    (lambda d: d[:-9], "cut off|stray"),
    (lambda d: d + b"rubbish!", "no Zstandard frame"),
    (lambda d: d[: len(d) // 2], "cut off|stray"),
    (lambda d: d[: len(d) // 2] + bytes([d[len(d) // 2] ^ 255]) + d[len(d) // 2 + 1 :], "."),
    (lambda d: d[8 + struct.unpack_from("<II", d)[1] :], "dictionary|Dictionary"),
])
def test_damaged_archives_are_refused(harm, message):
    _, data = archive()
    with pytest.raises(ValueError, match=message):
        for _, record in warc.frames(harm(data)):
            warc.page_record(record)


@pytest.mark.parametrize("old, new, message", [
    (b"WARC/1.1", b"WARC/9.9", "version"),
    (b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b"", "WARC-Date is missing"),
    (b"Content-Length: 8\r\n\r\n", b"Content-Length: 9\r\n\r\n", "."),
    (b"<html>", b"<htmL>", "does not match its digest"),
    (b"WARC-Type: response", b"WARC-Type: metadata", "unexpected record type"),
    (b"WARC-Type: response", b"WARC-Type response", "bad header line"),
    (b"\r\n\r\n<p", b"\r\n<p", "."),
])
def test_damaged_records_are_refused(old, new, message):
    payload = b"<html><p"
    good = warc.record(1, "http://x/", payload, warc.base32_sha1(payload), None, False, "2020-01-01T00:00:00Z")
    assert warc.page_record(good)[6] == payload
    bad = good.replace(old, new) if old in good else good[:-3]
    assert bad != good
    with pytest.raises(ValueError, match=message):
        warc.page_record(bad)


@pytest.mark.parametrize("limits", [(1 << 40, 16), (2_000, 16), (1, 16), (1 << 40, 2)])
def test_archives_end_at_their_limits(spark, limits):
    """A partition gives as many archives as the limits ask for, each readable alone."""
    rows = [(k, f"http://x/{k}", f"<html>{k} " + "word " * k) for k in range(60)]
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, rows).coalesce(1), path, archive_bytes=limits[0], archive_frames=limits[1])
    assert got(warc.read_archives(spark, path)) == expected(rows)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) >= 60 // limits[1]
    assert sum(len(list(warc.frames(bytes(f.content)))) for f in files) == 60


def foreign(kind, fields, block):
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    start = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Date: 2024-05-01T00:00:00Z\r\n{head}content-length: {len(block)}\r\n\r\n"
    return start.encode() + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Other record types and ids, names of fields in any case, a compressed dictionary."""
    block = b"software: x\r\n" * 40
    sha256 = hashlib.sha256(block).hexdigest()
    page = b"<p>one</p>"
    records = [
        foreign("warcinfo", [("warc-record-id", "<urn:uuid:1>"), ("WARC-Block-Digest", f"sha256:{sha256}")], block),
        foreign("request", [("WARC-RECORD-ID", "<urn:uuid:2>"), ("WARC-Concurrent-To", "<urn:uuid:1>"), ("WARC-Concurrent-To", "<urn:uuid:3>")], b"GET / HTTP/1.1\r\n\r\n"),
        foreign("metadata", [("WARC-Record-ID", "<urn:uuid:4>"), ("WARC-Block-Digest", "other:123")], b""),
        warc.record(7, None, page, warc.base32_sha1(page), None, False, "2020-01-01T00:00:00Z"),
    ]
    dictionary = zstandard.train_dictionary(4096, [f"{k} WARC/1.1\r\nWARC-Type: response {k * k}".encode() * 9 for k in range(300)])
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    data = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed
    compressor = zstandard.ZstdCompressor(dict_data=dictionary)
    (tmp_path / "a.warc.zst").write_bytes(data + b"".join(compressor.compress(r) for r in records))
    found = sorted(warc.read_records(spark, str(tmp_path)).collect(), key=lambda r: r.offset)
    assert [r.record_type for r in found] == ["warcinfo", "request", "metadata", "response"]
    assert [r.record_id for r in found] == ["<urn:uuid:1>", "<urn:uuid:2>", "<urn:uuid:4>", "<urn:page:7>"]
    assert bytes(found[0].block) == block and found[1].fields["warc-concurrent-to"] == "<urn:uuid:1>, <urn:uuid:3>"
    assert [(r.page_id, bytes(r.payload)) for r in warc.read_archives(spark, str(tmp_path)).collect()] == [(7, page)]
    with pytest.raises(ValueError, match="block does not match"):
        warc.parse(records[0].replace(b"software: x", b"software: y"))
