"""SentencePiece encoding for merge-type vocabularies, and decoding.

Encoding merges adjacent symbols, best score first and leftmost among equals, until no pair of
neighbours is a piece; symbols that are no piece fall back to bytes. Two forms of the agenda:

* `merge_together` works on many chunks at once: in every round each chunk takes the best of
  its pairs, found by one sorted lookup over all symbols, and merges it.
* `merge_alone` keeps a heap of pairs for one long chunk.

No piece holds a space mark behind another character (checked when a model is loaded), and
characters that are in no longer piece never merge, so a text falls into chunks that merge
independently: marks and the word behind them. Texts are cut with spaces in place of marks, as
strings without marks take less memory. Distinct chunks are merged once per worker, and
each is compared with the library's own encoding there, in batches, before it is used; a
difference stops the job. Decoding is the library's.

Defined results: null counts as the empty text, which has only its begin and end ids; repeated
rows give repeated results; ids and other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from fareline.llm.common import (
    SLICE_BYTES, PieceCache, bounded_batches, encode_texts, flattened, strings, table, text_or_empty,
    text_slices, tidy, worker_cache,
)

MARK = "▁"
LONG_CHUNK = 64
_models: dict[int, "Model"] = worker_cache()


class Model:
    """A merge-type vocabulary, its pairs sorted for lookup, and the cut into chunks."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=proto)
        size = self.library.get_piece_size()
        special = {
            i for i in range(size)
            if self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)
        }
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.unknown = self.library.unk_id()
        self.id_of = {self.library.id_to_piece(i): i for i in range(size) if i not in special}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece holds a space mark behind another character")
        if any(self.library.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        if self.library.normalize(" a  \tb\n") != f"{MARK}{MARK}a{MARK}{MARK}\tb\n":
            raise ValueError("only models without text normalisation are supported")
        # Symbols are numbered: pieces by id, other characters behind them.
        pairs = [
            (self.id_of[p[:k]], self.id_of[p[k:]], i)
            for p, i in self.id_of.items() for k in range(1, len(p))
            if p[:k] in self.id_of and p[k:] in self.id_of
        ]
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.size = size
        self.pair_keys = keys[order]
        self.pair_into = np.array([i for _, _, i in pairs], np.int64)[order]
        scores = np.array([self.library.get_score(i) for i in range(size)])
        # Rank 0 is the best score; equal scores share a rank.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.into = dict(zip(self.pair_keys.tolist(), self.pair_into.tolist()))
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.id_of))
        self.alone = alone[:1]
        stop = re.escape(alone)
        self.chunks = re.compile(f"[{stop}]| *[^ {stop}]+| +" if alone else " *[^ ]+| +")
        self.cut_at = re.compile("(?<=[^ ]) ")
        self.cache = PieceCache(
            lambda chunks: flattened(chunks, self.encode_chunks([c.replace(" ", MARK) for c in chunks]))
        )

    def symbols(self, chunk: str) -> list[int]:
        """One number per character: its piece id, or size + code point."""
        return [self.id_of.get(c, self.size + ord(c)) for c in chunk]

    def spelled(self, symbols: list[int]) -> list[int]:
        if all(s < self.size for s in symbols):
            return symbols
        return [
            i for s in symbols
            for i in ([s] if s < self.size else [self.byte_ids[b] for b in chr(s - self.size).encode()])
        ]

    def merge_alone(self, symbols: list[int]) -> list[int]:
        """Merges of one chunk by a heap of (rank, place) over a linked list of symbols."""
        symbols, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n and symbols[left] < self.size and symbols[right] < self.size:
                into = self.into.get(symbols[left] * self.size + symbols[right])
                if into is not None:
                    heapq.heappush(heap, (int(self.rank[into]), left, symbols[left], symbols[right]))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != a or right >= n or symbols[right] != b:
                continue  # one of the two has merged with another neighbour meanwhile
            symbols[left] = self.into[a * self.size + b]
            symbols[right] = -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s >= 0]

    def merge_together(self, chunks: list[list[int]]) -> list[list[int]]:
        """Merges of many chunks: each round does the best merge of every chunk."""
        out: list[list[int]] = [[]] * len(chunks)
        symbols = np.fromiter((s for c in chunks for s in c), np.int64)
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        while len(symbols):
            left, right = symbols[:-1], symbols[1:]
            key = left * self.size + right
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            fits = (
                (self.pair_keys[at] == key) & (owner[:-1] == owner[1:])
                & (left < self.size) & (right < self.size)
            )
            places = np.flatnonzero(fits)
            # The first place of the least rank in each chunk; places and owners ascend.
            rank, own = self.rank[self.pair_into[at[places]]], owner[places]
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            if len(firsts):
                least = np.repeat(np.minimum.reduceat(rank, firsts), np.diff(firsts, append=len(own)))
                places = places[rank == least]
                chosen = places[np.diff(owner[places], prepend=-1) > 0]
            else:
                chosen = places
            busy = np.zeros(len(chunks), bool)
            busy[owner[chosen]] = True
            rest = ~busy[owner]
            if rest.any():
                self._settle(out, symbols[rest], owner[rest])
            merged = symbols.copy()
            merged[chosen] = self.pair_into[at[chosen]]
            keep = ~rest
            keep[chosen + 1] = False
            symbols, owner = merged[keep], owner[keep]
        return out

    @staticmethod
    def _settle(out: list[list[int]], symbols: np.ndarray, owner: np.ndarray) -> None:
        starts = np.flatnonzero(np.concatenate([[True], np.diff(owner) > 0]))
        numbers = symbols.tolist()
        for k, a, b in zip(owner[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(numbers)]):
            out[k] = numbers[a:b]

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk, compared with the library's."""
        plain = [self.symbols(c) for c in chunks]
        short = [k for k, s in enumerate(plain) if len(s) <= LONG_CHUNK]
        found: list[list[int]] = [[]] * len(chunks)
        for k, ids in zip(short, self.merge_together([plain[k] for k in short])):
            found[k] = ids
        for k, s in enumerate(plain):
            if len(s) > LONG_CHUNK:
                found[k] = self.merge_alone(s)
        found = [self.spelled(s) for s in found]
        self.compare(chunks, found)
        return found

    def compare(self, chunks: list[str], found: list[list[int]]) -> None:
        """The library puts a space mark before a text; chunks that begin with one drop it.

        Other chunks, and the lone mark, are encoded behind a character that stands alone. A
        vocabulary without such characters has no chunk that begins without a mark.
        """
        marked = [len(c) > 1 and c[0] == MARK for c in chunks]
        texts = [c[1:] if m else self.alone + c for c, m in zip(chunks, marked)]
        theirs = self.library.encode([t.replace(MARK, " ") for t in texts], num_threads=1)
        before = self.library.encode(self.alone)
        for chunk, m, ids, own in zip(chunks, marked, theirs, found):
            if not m and not self.alone:
                if chunk == MARK:
                    continue  # the library gives nothing for the empty text
                raise ValueError(f"no way to compare {chunk[:80]!r} with the library")
            if ids != (own if m else before + own):
                raise ValueError(f"the library encodes {chunk[:80]!r} as {ids[:40]}, not {own[:40]}")

    def encode(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """Ids of whole texts with begin and end ids, for a bounded slice of texts at a time."""
        head, tail = np.array([self.begin], np.int32), np.array([self.end], np.int32)
        spaced = [" " + t.replace(MARK, " ") if t else "" for t in texts]
        for ids in encode_texts(spaced, self.chunks, self.cut_at, self.cache):
            yield [np.concatenate([head, own, tail]) for own in ids]


def model_of(proto: bytes) -> Model:
    key = hash(proto)
    if key not in _models:
        _models[key] = Model(proto)
    return _models[key]


def encoded_batch(model: Model, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Where a bounded slice of texts begins, and the ids of its texts; only the slice is held as strings."""
    for begin, end in text_slices(texts, SLICE_BYTES // 4):
        at = begin
        for ids in model.encode(strings(texts.slice(begin, end - begin))):
            yield at, ids
            at += len(ids)


def encode(
    docs: DataFrame, model_file: str, text_col: str = "text", ids_as: str = "piece_ids"
) -> DataFrame:
    """The columns of `docs` and the ids of the text as array<int> `ids_as`."""
    return _mapped(docs, model_file, text_col, f"{ids_as} array<int>", _ids)


def digests(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """The columns of `docs`, n_tokens, and SHA-256 of the ids and of the decoded text."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, model_file, text_col, fields, _digests)


def encode_and_decode(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """The columns of `docs`, the ids as `piece_ids`, and the text decoded as `decoded_text`.

    Columns of these names stay as they are; the new ones then are `piece_ids_2` and so on.
    """
    ids_as, decoded_as = _free("piece_ids", docs), _free("decoded_text", docs)
    return _mapped(docs, model_file, text_col, f"{ids_as} array<int>, {decoded_as} string", _both)


def _free(name: str, docs: DataFrame) -> str:
    """`name`, numbered if the table has such a column in any case."""
    taken, out, nth = {c.lower() for c in docs.columns}, name, 1
    while out in taken:
        nth += 1
        out = f"{name}_{nth}"
    return out


def _both(model: Model, ids: list[np.ndarray]) -> list[pa.Array]:
    decoded = model.library.decode([own.tolist() for own in ids], num_threads=1)
    return [*_ids(model, ids), pa.array(decoded, pa.string())]


def _ids(model: Model, ids: list[np.ndarray]) -> list[pa.Array]:
    edges = np.concatenate([[0], np.cumsum([len(own) for own in ids])]).astype(np.int32)
    return [pa.ListArray.from_arrays(edges, np.concatenate(ids))]


def _digests(model: Model, ids: list[np.ndarray]) -> list[pa.Array]:
    decoded = model.library.decode([own.tolist() for own in ids], num_threads=1)
    return [
        pa.array([len(own) for own in ids], pa.int64()),
        pa.array([hashlib.sha256(own.astype("<u4").tobytes()).hexdigest() for own in ids]),
        pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in decoded]),
    ]


def _mapped(docs: DataFrame, model_file: str, text_col: str, fields: str, make) -> DataFrame:
    """`docs` with the columns that `make` computes from the ids, a batch at a time."""
    # The JVM holds a batch in both directions beside the worker's; a few slices are enough.
    bounded_batches(docs.sparkSession, 2 * SLICE_BYTES)
    with open(model_file, "rb") as file:
        proto = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [f.split()[0] for f in fields.split(", ")]
    taken = [c for c in docs.columns if c.lower() in {n.lower() for n in names}]
    if taken:
        raise ValueError(f"the input already has columns {taken}; choose other names")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(proto.value)
        for batch in batches:
            for at, ids in encoded_batch(model, batch.column(batch.num_columns - 1)):
                own = batch.slice(at, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:-1], *make(model, ids)], names=[*batch.schema.names[:-1], *names]
                )

    from pyspark.sql.types import StructType, _parse_datatype_string

    schema = StructType([*docs.schema.fields, *_parse_datatype_string(fields).fields])
    return docs.select("*", text_or_empty(text_col).alias("_whole_text")).mapInArrow(tidy(run, keep=_models), schema)


def op9_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
