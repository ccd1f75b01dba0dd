"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing. Payload digests are counted first; of equal payloads the row with the smallest page id
becomes a `response`, the others `revisit` records without payload. Each task trains a
dictionary on the first records of an archive and writes the skippable frame with the
dictionary, then a frame per record. The files go through Spark's text writer, so
only files of finished tasks appear and any file system works; its line separator is an empty
skippable frame, which every Zstandard reader passes over. An archive ends after
`ARCHIVE_BYTES` (or with the record that reaches them) and after `ARCHIVE_FRAMES` frames, so
files stay small enough to be read back whole however large a partition is. The writer begins
a file every `ARCHIVE_FRAMES` lines; an archive that its bytes end earlier is filled up with
empty lines, 8 bytes each.

Reading. An archive is a row of Spark's `binaryFile` source, so one from elsewhere may have 2 GiB
at most. The reader takes the dictionary from the leading frame, plain or itself compressed,
walks the frames by their block headers, decodes each alone, and checks
the version line, required fields, `Content-Length`, the end of the record, and the digests.
Anything wrong raises ValueError with the file and the offset. `read_records` reads any archive,
whatever its types of record and ids; `read_archives` gives the pages of archives that
`write_archives` wrote, and passes over records of other standard types. Names of fields have no
case, and `WARC-Concurrent-To` may repeat. Digests are checked if their algorithm is known,
in base32 or hexadecimal digits.

Defined results: a null payload is empty; equal payloads count from `revisit_from` bytes on,
shorter ones are all responses. Rows that repeat id and payload of a response are responses
too. A row without id revisits an equal payload with one; equal payloads that all lack ids are
all responses. A null url becomes `urn:page:ID`. Control characters in urls are
percent-encoded. An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import bounded_batches, stored, table
from fareline.session import scratch_path

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
OTHER_TYPES = ("warcinfo", "resource", "request", "metadata", "conversion", "continuation")
ALGORITHMS = ("md5", "sha1", "sha256", "sha512")

DICTIONARY_BYTES = 32 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 256, 2 << 20
LEVEL = 3
ARCHIVE_BYTES, ARCHIVE_FRAMES = 128 << 20, 16_384
RECORD_FIELDS = (
    "page_id long, record_type string, target_uri string, refers_to long, "
    "payload_bytes long, payload_digest string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    revisit: bool, date: str,
) -> bytes:
    """One WARC/1.1 record with an HTTP response as its block."""
    uri = _urn(page_id) if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if not revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_urn(page_id)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_urn(refers_to)}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _compressed(records: Iterator[bytes], most_bytes: int | None = None, most_frames: int | None = None) -> Iterator[bytes]:
    """The frames of one archive; the dictionary comes from its first records. Takes no more
    records than the limits allow, but at least one."""
    first, held = [], 0
    for data in records:
        first.append(data)
        held += len(data)
        if len(first) >= min(SAMPLE_RECORDS, (most_frames or SAMPLE_RECORDS + 1) - 1) or held >= SAMPLE_BYTES:
            break
    if not first:
        return
    options = {"level": LEVEL, "write_content_size": True, "write_checksum": True}
    count = size = 0
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, first, level=LEVEL)
        dictionary.precompute_compress(level=LEVEL)
    except zstandard.ZstdError:  # too few or too small records to train on
        compressor = zstandard.ZstdCompressor(**options)
    else:
        data = dictionary.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
        compressor = zstandard.ZstdCompressor(dict_data=dictionary, **options)
        count = 1
    for data in first:
        frame = compressor.compress(data)
        yield frame
        count, size = count + 1, size + len(frame)
    while (most_bytes is None or size < most_bytes) and (most_frames is None or count < most_frames):
        data = next(records, None)
        if data is None:
            break
        frame = compressor.compress(data)
        yield frame
        count, size = count + 1, size + len(frame)


def _archives(records: Iterator[bytes], most_bytes: int, most_frames: int) -> Iterator[bytes]:
    """The lines of archives one after another, `most_frames` for each but the last."""
    while (head := next(records, None)) is not None:
        count = 0
        for frame in _compressed(chain([head], records), most_bytes, most_frames):
            yield frame
            count += 1
        head = next(records, None)
        if head is None:
            return
        records = chain([head], records)
        yield from (b"" for _ in range(most_frames - count))


def write_archives(
    pages: DataFrame, path: str, revisit_from: int = 0, date: str = "2020-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES, archive_frames: int = ARCHIVE_FRAMES,
) -> None:
    """Archives below `path`, one or more for each partition with pages.

    An archive of over `archive_bytes` holds what its dictionary was trained on, or one record more."""
    if archive_frames < 2:
        raise ValueError("an archive has room for a dictionary and a record at least")
    bounded_batches(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    # Written, so that the join has a plain exchange on both sides and a hot payload can be split.
    firsts = stored(
        rows.filter(F.octet_length("payload") >= revisit_from)
        .groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("sha1", "first"),
        "first-pages",
    )
    same = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts.hint("shuffle_hash"), "sha1", "left").select(
        "page_id", "url", "payload", "sha1", "first",
        (same & (F.octet_length("payload") >= revisit_from)).alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for page_id, url, payload, sha1, first, revisit in zip(*columns):
                    digest = base64.b32encode(sha1).decode()
                    yield record(page_id, url, payload, digest, first, revisit, date)

        frames, held = [], 0
        for frame in _archives(records(), archive_bytes, archive_frames):
            frames.append(frame)
            held += len(frame)
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
                frames, held = [], 0
        if frames:
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    frames = joined.mapInArrow(run, "frame binary")
    # The cast keeps the bytes as they are, and the writer puts them out unchanged.
    lines = frames.select(F.col("frame").cast("string")).write.option("lineSep", EMPTY_FRAME)
    lines.option("maxRecordsPerFile", archive_frames).text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at `at` ends, from its block headers."""
    checksum = data[at + 4] & 4
    end = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError("the frame is cut off")
        head = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 if checksum else 0
    if end > len(data):
        raise ValueError("the frame is cut off")
    return end


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame of an archive."""
    view, at, decoder = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError(f"offset {at}: {len(view) - at} stray bytes")
        magic, size = struct.unpack_from("<II", view, at)
        if magic >> 4 == DICTIONARY_MAGIC >> 4:
            if at + 8 + size > len(view):
                raise ValueError(f"offset {at}: a skippable frame is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                content = bytes(view[8 : 8 + size])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    try:
                        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                    except zstandard.ZstdError as error:
                        raise ValueError(f"offset 0: the dictionary cannot be decompressed: {error}") from error
                dictionary = zstandard.ZstdCompressionDict(content)
                decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"offset {at}: no Zstandard frame begins here")
        try:
            end = frame_end(view, at)
            decoded = decoder.decompress(view[at:end])
        except (ValueError, zstandard.ZstdError) as error:
            raise ValueError(f"offset {at}: {error}") from error
        yield at, decoded
        at = end


def matches(stated: str, data: bytes) -> bool:
    """Whether data has the digest stated as `algorithm:digits`; true if the algorithm is unknown."""
    algorithm, _, digits = stated.partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in ALGORITHMS:
        return True
    found = hashlib.new(algorithm, data).digest()
    return digits.upper().rstrip("=") in (base64.b32encode(found).decode().rstrip("="), found.hex().upper())


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (by lower-case name; repeated ones joined by a comma) and block of one
    record, checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC version line but {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        name, value = name.lower(), value.strip()
        if not colon or not name or name in fields and name != "warc-concurrent-to":
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[name] = f"{fields[name]}, {value}" if name in fields else value
    for name in REQUIRED:
        if name.lower() not in fields:
            raise ValueError(f"{name} is missing")
    stated = fields["content-length"]
    if not (stated.isascii() and stated.isdecimal()):
        raise ValueError(f"Content-Length is {stated!r}")
    length = int(stated)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block and its end have {len(rest)} bytes")
    block = rest[:length]
    if not matches(fields.get("warc-block-digest", ""), block):
        raise ValueError("the block does not match its digest")
    return fields, block


def _page(uri: str) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+|none)>", uri)
    if not number:
        raise ValueError(f"not the id of a page: {uri}")
    return None if number[1] == "none" else int(number[1])


def page_record(data: bytes) -> tuple:
    """(page id, type, uri, page referred to, payload bytes, digest, payload) of a record."""
    return _page_fields(*parse(data))


def _page_fields(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    http, gap, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?mi)^Content-Length: *(\d+)\r?$", http)
    if not gap or not stated:
        raise ValueError("the block holds no HTTP response with a length")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(stated[1]):
            raise ValueError(f"HTTP states {int(stated[1])} bytes, the payload has {len(payload)}")
        if digest != base32_sha1(payload):
            raise ValueError("the payload does not match its digest")
        refers = None
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise ValueError("a revisit record has a payload, or refers to nothing")
        refers, payload = _page(fields["warc-refers-to"]), None
    else:
        raise ValueError(f"unexpected record type {kind}")
    return (
        _page(fields["warc-record-id"]), kind, fields.get("warc-target-uri"), refers,
        int(stated[1]), digest, payload,
    )


def _read(spark: SparkSession, path: str, make, kinds: dict[str, pa.DataType], fields: str) -> DataFrame:
    """A row for each record that `make` (file, offset, fields, block) does not answer with None."""
    bounded_batches(spark)

    def rows_of(name: str, content: bytes) -> Iterator[tuple[tuple, int]]:
        for offset, data in _named(frames(content), name):
            try:
                row = make(name, offset, *parse(data))
            except ValueError as error:
                raise ValueError(f"{name}, offset {offset}: {error}") from error
            if row is not None:
                yield row, len(data)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds.values())]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row, size in rows_of(name.as_py(), content.as_py()):
                    rows.append(row)
                    held += size
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, fields)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of any archive: file, offset of its frame, type, id, date, target, all
    header fields by lower-case name, and the block."""

    def make(name: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
        return (
            name, offset, fields["warc-type"], fields["warc-record-id"], fields["warc-date"],
            fields.get("warc-target-uri"), list(fields.items()), block,
        )

    text = pa.string()
    kinds = {
        "file": text, "offset": pa.int64(), "record_type": text, "record_id": text, "date": text,
        "target_uri": text, "fields": pa.map_(text, text), "block": pa.binary(),
    }
    return _read(
        spark, path, make, kinds,
        "file string, offset long, record_type string, record_id string, date string, "
        "target_uri string, fields map<string,string>, block binary",
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per page record; `payloads` adds the payload (null for revisit records)."""
    width = len(_PAGE_KINDS) - (not payloads)

    def make(name: str, offset: int, fields: dict[str, str], block: bytes) -> tuple | None:
        return None if fields["warc-type"] in OTHER_TYPES else _page_fields(fields, block)[:width]

    kinds = dict(list(_PAGE_KINDS.items())[:width])
    return _read(spark, path, make, kinds, RECORD_FIELDS + (", payload binary" if payloads else ""))


def _named(found: Iterator, name: str) -> Iterator:
    try:
        yield from found
    except ValueError as error:
        raise ValueError(f"{name}, {error}") from error


_PAGE_KINDS = {
    "page_id": pa.int64(), "record_type": pa.string(), "target_uri": pa.string(), "refers_to": pa.int64(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
}


def op3_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP3_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
), digits AS (
  SELECT page_id, payload_bytes, first, hex,
         list_transform(range(32), lambda k: (('0x' || substr(hex, (k // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31) AS fives
  FROM hashed
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(fives, lambda f: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (f + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM digits
"""
