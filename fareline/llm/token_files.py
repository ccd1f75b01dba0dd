"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are range-partitioned and sorted by id, and each task writes one file, so files and
the stripes in them are in ascending id order. A row is a document: `doc_id`, its place
`token_offset` among the file's ids, `n_tokens` and `ids`; ORC stores the numbers run-length
encoded. Stripes are read in parallel, and a filter on `doc_id` skips files, stripes and row
groups by their minimum and maximum and by the Bloom filters. `part` numbers the files; the
ids before a file are summed from `part` and `n_tokens` alone, without reading an id.

Texts are cut at ASCII white space, which the tokenizer drops, and A-Z is lower-cased, as the
tokenizer does itself (not where a text may hold a special token, which is matched before);
so are words before punctuation behind a letter, where the tokenizer's own parts end. Distinct
pieces are kept per worker and looked up for whole batches. New ones are encoded many at a time: those
of plain small letters joined by spaces and told apart by their word ends, all others one by one.

Defined results: a null text is empty and has the end id only; null ids come first; rows with
the same id are ordered by a hash of the text; rows equal in both are interchangeable. An
empty table gives an empty dataset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline.llm.common import PieceCache, bounded_batches, encode_words, flattened, table, text_or_empty, worker_cache
from fareline.session import scratch_path

END_ID = 1
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "part int, doc_id long, token_offset long, n_tokens int, ids array<int>"
MARK = "<|"  # special tokens begin with it
# Pieces that are one part before merging: small letters that no normalisation changes.
_PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
_LETTERS, _STOPS = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOPS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
WORD_END = "</w>"
JOINED = 2_000
_caches: dict[int, PieceCache] = worker_cache()


class Words:
    """Ids of many words from few calls of the tokenizer."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and numbers of ids of plain words joined by spaces; each has one word end. None if not."""
        ids = np.array(self._encoded([" ".join(words)])[0], np.int32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return None
        return ids, np.diff(ends, prepend=0)

    def __call__(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(pa.array(words, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        order, found, rest = [], [], np.flatnonzero(~plain).tolist()
        places = np.flatnonzero(plain)
        for begin in range(0, len(places), JOINED):
            here = places[begin : begin + JOINED].tolist()
            some = [words[k] for k in here]
            ids = self.together(some)
            if ids is None:
                rest += here
            else:
                order += some
                found.append(ids)
        others = [words[k] for k in rest]
        _, flat, lengths = flattened(others, self._encoded(others))
        found.append((flat, lengths))
        return order + others, np.concatenate([f for f, _ in found]), np.concatenate([n for _, n in found])


def stops_after_letters(data: np.ndarray) -> np.ndarray:
    """Bytes that are ASCII punctuation right behind a letter: the tokenizer's parts end there.

    Letters are those of ASCII, and of Latin-1 in two bytes (0xC3 and another, but for the two signs).
    """
    letter = _LETTERS[data]
    signs = (data == 0x97) | (data == 0xB7)
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & ~signs[1:]
    out = np.zeros(len(data), bool)
    out[1:] = letter[:-1] & _STOPS[data[1:]]
    return out


def _cache(definition: str) -> PieceCache:
    """The worker's cache for a tokenizer definition; it outlives the task."""
    key = hash(definition)
    if key not in _caches:
        _caches[key] = PieceCache(Words(definition))
    return _caches[key]


def encode(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID) -> DataFrame:
    """`docs` (doc_id, text), already ordered inside its partitions, as rows of SCHEMA."""
    with open(tokenizer_json, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, part, offset = _cache(definition.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, ids, sizes in encode_words(batch.column(1), MARK.encode(), stops_after_letters, cache):
                flat = np.insert(ids, np.cumsum(sizes), end_id)
                lengths = sizes + 1
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), part, np.int32)),
                        batch.column(0).slice(at, len(lengths)),
                        pa.array(offset + ends - lengths),
                        pa.array(lengths.astype(np.int32)),
                        pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), flat),
                    ],
                    names=["part", "doc_id", "token_offset", "n_tokens", "ids"],
                )
                offset += int(ends[-1])

    return docs.mapInArrow(run, SCHEMA)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    # The hash deals out rows without an id, or with the same one, and orders them.
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"), F.monotonically_increasing_id())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .select("doc_id", "text")
    )
    encode(ordered, tokenizer_json, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    files = spark.read.schema(SCHEMA).orc(path)
    # One row per file; the only window without partitioning sees just these.
    before = Win.partitionBy().orderBy("part").rowsBetween(Win.unboundedPreceding, -1)
    begins = files.groupBy("part").agg(F.sum("n_tokens").alias("held")).select(
        "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin")
    )
    # A row per file at most: small enough to send to every task at any size of the data.
    return files.join(F.broadcast(begins), "part").select(
        "doc_id",
        (F.col("begin") + F.col("token_offset")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids",
    )


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replace `ids` by the unsigned CRC-32 of its little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = memoryview(lists.values.to_numpy().astype("<u4")).cast("B")
            edges = lists.offsets.to_numpy() * 4
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return with_crc32(read_token_files(spark, path))
