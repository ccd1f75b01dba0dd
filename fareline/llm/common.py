"""Helpers shared by the operators: tables, written steps, bounded Arrow batches, ragged ids."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from fareline.session import scratch_path

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 32 << 20
SLICE_CHARS = 2_000_000
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: later jobs survive lost executors.

    What the step has shuffled is not needed once it is written; Spark is told to drop such files
    when a query ends, not when the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, name)
    df.sparkSession.conf.set(DROP_SHUFFLES, "true")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_worker_caches: list[dict] = []


def worker_cache() -> dict:
    """A dict that an operator's tasks keep in their Python worker, until those of another one want the memory."""
    _worker_caches.append({})
    return _worker_caches[-1]


def drop_caches(keep: dict | None = None) -> None:
    """Free what earlier operators left in this worker, which outlives the step that filled it; `keep` stays."""
    others = [cache for cache in _worker_caches if cache and cache is not keep]
    if others:
        for cache in others:
            cache.clear()
        gc.collect()  # a cache and its encoder refer to each other
        pa.default_memory_pool().release_unused()


def release() -> None:
    """Give memory that is free in this worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator], keep: dict | None = None) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow: its worker begins without the caches of other operators, and idles without free memory."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches(keep)
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


SMALL_ROWS = 250_000


def small_side(rows: DataFrame) -> DataFrame:
    """A stored table of a few numbers per row as the smaller side of a join: broadcast while it
    has at most `SMALL_ROWS` rows, some 10 MB, else shuffled and hashed by partition."""
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows.hint("shuffle_hash")


def staying(named: DataFrame, names: DataFrame) -> DataFrame:
    """The structs `row` of `named`, with their fields as columns, without those whose `name` leaves.

    `names` has id (a name), leave, rows; of several rows with one name one stays. Names it lacks
    stay with all rows. Only names that leave or repeat are written, no row is.
    """
    changed = stored(names.filter(F.col("leave") | (F.col("rows") > 1)).select("id", "leave"), "not-as-they-are")
    same = F.col("name") == F.col("changed.id")
    stay = named.join(small_side(changed).alias("changed"), same, "left_anti")
    several = changed.filter("not leave")
    if not several.isEmpty():
        once = named.join(small_side(several).alias("changed"), same, "left_semi").dropDuplicates(["name"])
        stay = stay.unionByName(once)
    return stay.select("row.*")


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Limit the Arrow batches sent to Python by bytes, so that long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(texts: Iterable[str]) -> list[str]:
    """A-Z lower-cased and nothing else; bytes.lower does just that."""
    return [t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") for t in texts]


def sliced(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `chars` characters together."""
    begin = held = 0
    for at, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield begin, at
            begin, held = at, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def cut(text: str, at: re.Pattern, chars: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts of about `chars` characters that begin where `at` matches."""
    begin = 0
    while len(text) - begin > chars:
        found = at.search(text, begin + chars)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def gather(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """store[s : s + n] of every pair, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return store[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class _Pieces:
    """Ids of pieces, one after another, and where those of each piece are."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)
        self.used = 0

    def add(self, pieces: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        first, last = len(self.row), len(self.row) + len(pieces)
        self.ids = _grown(self.ids, self.used + len(flat))
        self.starts, self.lengths = _grown(self.starts, last), _grown(self.lengths, last)
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:last] = lengths
        self.used += len(flat)
        self.row.update(zip(pieces, range(first, last)))

    def find(self, pieces: list[str]) -> np.ndarray:
        """The row of each piece, -1 where there is none."""
        return np.fromiter(map(self.row.get, pieces, repeat(-1)), np.int64, len(pieces))

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[rows]
        return gather(self.ids, self.starts[rows], lengths), lengths


NEW_PIECES = 50_000


class PieceCache:
    """Ids of text pieces, kept per Python worker in two generations of `limit` / 2 pieces.

    Pieces are found in the young generation, or move there from the old one. When the young one
    is full it becomes the old one, and what has not been used since goes. New pieces are encoded
    `NEW_PIECES` at a time. `encode_many` takes a list of distinct pieces and returns them in any order, with all their
    ids in that order and the number of ids of each.
    """

    def __init__(
        self, encode_many: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]], limit: int = 520_000
    ):
        self.encode_many, self.limit = encode_many, limit
        self.young, self.old = _Pieces(), _Pieces()

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each piece."""
        if not pieces:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        rows = self.young.find(pieces)
        absent = np.flatnonzero(rows < 0)
        if len(absent):
            missing = dict.fromkeys(pieces[k] for k in absent.tolist())
            if len(self.young.row) + len(missing) > self.limit // 2:
                self.young, self.old = _Pieces(), self.young
                absent, missing = np.arange(len(pieces)), dict.fromkeys(pieces)
            wanted = list(missing)
            before = self.old.find(wanted)
            known = np.flatnonzero(before >= 0)
            self.young.add([wanted[k] for k in known.tolist()], *self.old.get(before[known]))
            new = [wanted[k] for k in np.flatnonzero(before < 0).tolist()]
            for begin in range(0, len(new), NEW_PIECES):
                self.young.add(*self.encode_many(new[begin : begin + NEW_PIECES]))
            rows[absent] = self.young.find([pieces[k] for k in absent.tolist()])
        return self.young.get(rows)


def flattened(pieces: list[str], encoded: list[list[int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Id lists of pieces as `PieceCache` takes them."""
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
    return pieces, np.fromiter((i for ids in encoded for i in ids), np.int32, int(lengths.sum())), lengths


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.empty(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def encode_texts(
    texts: list[str], pieces: re.Pattern, at: re.Pattern, cache: PieceCache
) -> Iterator[list[np.ndarray]]:
    """Ids of each text, in lists for a bounded slice of texts at a time."""
    for begin, end in sliced(texts):
        parts, owner = [], []
        for k in range(begin, end):
            for part in cut(texts[k], at):
                parts.append(part)
                owner.append(k - begin)
        out: list[list[np.ndarray]] = [[] for _ in range(end - begin)]
        for first, last in sliced(parts):
            found = [pieces.findall(p) for p in parts[first:last]]
            ids, lengths = cache([p for f in found for p in f])
            edges = np.concatenate([[0], np.cumsum(lengths)])
            bounds = edges[np.concatenate([[0], np.cumsum([len(f) for f in found])])]
            for k, a, b in zip(owner[first:last], bounds[:-1], bounds[1:]):
                out[k].append(ids[a:b])
        yield [o[0] if len(o) == 1 else np.concatenate(o) if o else ids[:0] for o in out]


def encode_words(
    texts: pa.Array, whole: bytes, joints: Callable[[np.ndarray], np.ndarray], cache: PieceCache
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For bounded slices of texts: where the slice begins, all its ids, and the number of ids of each text.

    Words are found in the bytes, cut where `joints` marks a byte that begins another piece, and told apart by Arrow;
    only the distinct pieces of a slice are looked up. A-Z is lower-cased. In texts that hold
    the bytes `whole` nothing is lower-cased or cut.
    """
    for begin, end in text_slices(texts, SLICE_BYTES // 2):
        data, edges = text_bytes(texts.slice(begin, end - begin))
        folded, cuts = LOWER[data], joints(data)
        for k in _holding(data, edges, whole):
            folded[edges[k] : edges[k + 1]] = data[edges[k] : edges[k + 1]]
            cuts[edges[k] : edges[k + 1]] = False
        sizes, found, at = np.zeros(end - begin, np.int64), [], 0
        while at < len(folded):
            # Very long texts in parts that end with white space.
            stop = min(at + 2 * SLICE_BYTES, len(folded))
            if stop < len(folded):
                spaces = np.flatnonzero(_SPACES[folded[at:stop]])
                stop = at + int(spaces[-1]) + 1 if len(spaces) else len(folded)
            part = folded[at:stop]
            first, last = np.searchsorted(edges, [at, stop], "left")
            starts, ends = word_places(part, edges[first:last] - at)
            inside = cuts[at:stop].copy()
            inside[starts] = False  # a text begins there
            extra = np.flatnonzero(inside)
            starts, ends = _merged(starts, extra, len(part)), _merged(ends, extra, len(part))
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
            packed = part[~_SPACES[part]]
            words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(packed)).dictionary_encode()
            # Through NumPy, as to_pylist makes a scalar of every word.
            ids, lengths = cache(words.dictionary.to_numpy(zero_copy_only=False).tolist())
            which = words.indices.to_numpy()
            found.append(gather(ids, (np.cumsum(lengths) - lengths)[which], lengths[which]))
            owner = np.searchsorted(edges, starts + at, "right") - 1
            sizes += np.bincount(owner, lengths[which], minlength=end - begin + 1)[: end - begin].astype(np.int64)
            at = stop
        yield begin, np.concatenate(found) if found else np.empty(0, np.int32), sizes


def _merged(places: np.ndarray, more: np.ndarray, size: int) -> np.ndarray:
    """Both lists of places up to `size`, in order."""
    mark = np.zeros(size + 1, bool)
    mark[places] = True
    mark[more] = True
    return np.flatnonzero(mark)


def _holding(data: np.ndarray, edges: np.ndarray, mark: bytes) -> list[int]:
    """The texts that hold the bytes of `mark`."""
    hit = np.ones(max(0, len(data) - len(mark) + 1), bool)
    for k, byte in enumerate(mark):
        hit &= data[k : k + len(hit)] == byte
    return np.unique(np.searchsorted(edges, np.flatnonzero(hit), "right") - 1).tolist()


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def packed(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """`rows` with the text, as the last column, compressed before it is moved."""
    names = [c for c in rows.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, edges = text_bytes(batch.column(len(names)))
            texts = [packer.compress(data[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.binary())], names=[*names, "packed"]
            )

    ordered = rows.select(*names, text_col)
    schema = StructType([*(f for f in ordered.schema.fields if f.name != text_col), StructField("packed", BinaryType())])
    return ordered.mapInArrow(tidy(run), schema)


def unpacked(texts: pa.Array) -> pa.Array:
    """The string column that `packed` compressed."""
    unpacker = zstandard.ZstdDecompressor()
    return pa.array([unpacker.decompress(t.as_buffer()) for t in texts], pa.binary()).cast(pa.string())


# --- Words by name ---------------------------------------------------------------------

_names: dict[str, int] = worker_cache()
MOST_NAMES = 500_000


def names(words: list[str]) -> np.ndarray:
    """64-bit XXH3 of the UTF-8 bytes of words; those met before are kept per worker."""
    fresh = set(words).difference(_names)
    if len(_names) + len(fresh) > MOST_NAMES:
        _names.clear()
        fresh = set(words)
    digest = xxhash.xxh3_64_intdigest
    _names.update((w, digest(w.encode("utf-8", "surrogatepass"))) for w in fresh)
    return np.fromiter(map(_names.__getitem__, words), np.uint64, len(words))


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
SLICE_BYTES = 4 << 20
LONG_WORD = 256


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each text begins and ends in them."""
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[edges[0] : edges[-1]], edges - edges[0]


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `size` bytes together."""
    _, edges = text_bytes(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + size, "right")) - 1)
        yield begin, end
        begin = end


def named_words(texts: pa.Array | list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of some texts, one text after another, and the words of each text.

    A name mixes the bytes of a word, eight at a time, and their number into 64 bits. `lower`
    folds A-Z first. Bytes are handled as arrays; nothing is done per word.
    """
    if isinstance(texts, list):
        texts = pa.array(texts, pa.string())
    data, edges = text_bytes(texts)
    sizes, found, begin = np.zeros(len(texts), np.int64), [], 0
    while begin < len(data):
        # Very long texts in parts that end with white space.
        end = min(begin + 2 * SLICE_BYTES, len(data))
        if end < len(data):
            spaces = np.flatnonzero(_SPACES[data[begin:end]])
            end = begin + int(spaces[-1]) + 1 if len(spaces) else len(data)
        part = LOWER[data[begin:end]] if lower else data[begin:end]
        first, last = np.searchsorted(edges, [begin, end], "left")
        starts, ends = word_places(part, edges[first:last] - begin)
        found.append(word_names(part, starts, ends))
        owner = np.searchsorted(edges, starts + begin, "right") - 1
        sizes += np.bincount(owner, minlength=len(texts) + 1)[: len(texts)]
        begin = end
    return np.concatenate(found) if found else np.empty(0, np.uint64), sizes


def word_places(data: np.ndarray, breaks: np.ndarray, gaps: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; `breaks` are places where a text begins, `gaps` bytes between words."""
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(gaps[data], out=solid[1:-1])
    starts = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]  # the last byte of a word
    inside = breaks[(breaks > 0) & (breaks < len(data))]
    starts[inside] = solid[1:-1][inside]
    ends[inside - 1] = solid[1:-1][inside - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the 8 bytes at every place
    lengths = ends - starts
    out = mixed(lengths.astype(np.uint64), eight[starts] & _LOW_BYTES[np.minimum(lengths, 8)])
    more = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD))
    at = 8
    while len(more):
        rest = np.minimum(lengths[more] - at, 8)
        out[more] = mixed(out[more], eight[starts[more] + at] & _LOW_BYTES[rest])
        at += 8
        more = more[lengths[more] > at]
    for k in np.flatnonzero(lengths > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for an ordered pair of names."""
    with np.errstate(over="ignore"):
        out = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(31))


# --- Connected components --------------------------------------------------------------


def components(edges: DataFrame, name: str) -> DataFrame:
    """`node`, `component` (the smallest node reachable) of every node of edges (a, b).

    Every node takes the smallest label among its neighbours, then the label of its label,
    until nothing changes. Both steps are joins and `min` aggregates; each round is written.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-edges",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("component")),
        f"{name}-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        )
        lower = stored(
            labels.join(near, "node").select(
                "node", F.least("component", "low").alias("component"), F.col("component").alias("before")
            ),
            f"{name}-lower",
        )
        if lower.filter(F.col("component") != F.col("before")).isEmpty():
            return labels
        roots = lower.select(F.col("node").alias("component"), F.col("component").alias("root"))
        labels = stored(
            lower.join(roots, "component").select("node", F.least("component", "root").alias("component")),
            f"{name}-labels",
        )
