"""Near duplicates by Jaccard similarity of word shingles, through token-combination prefixes.

A document is the set of its shingles (names of five consecutive words). Documents with equal
sets form a class. Sets are ordered by one global order: rare shingles first, frequent ones
last. Two sets with similarity of at least t share o = ceil(t * size) shingles, counted for
either, so they meet in the first n - o + 1 of the order:

* A set whose prefix holds rare shingles only is indexed under each of them.
* A prefix that reaches the frequent class is extended by m shingles. Frequent shingles fall
  into m parts by their hash; sets that share no rare one of the extended prefix then share two
  frequent ones of a part, so frequent shingles are indexed as pairs of a part only. m follows
  the power of two below the larger set's size, and a set is indexed for each size class in
  which it can meet a partner; so a set of n shingles has O(n) pairs, however frequent they are.

Frequent shingles are those in at least `FREQUENT` of all shingle occurrences (and
`LEAST_FREQUENT` documents): at most 1 / FREQUENT of them exist, so their list is broadcast. They are found by counting every
chunk of the corpus exactly and passing on what exceeds half that share of the chunk, which
misses nothing frequent and errs by half the share at most. The order needs no exact counts.

Verifying. Under each index entry the set with the least name is the pivot. Every set is first
compared with the least of its pivots. Entries whose sets are not all in one component after
that have each set compared with the entry's own pivot. Entries that still are in several
components give pairs between components; there the distance to the
pivot, a metric, prunes what cannot be similar, and so does a sketch. The shingles of a small set are
counted in 256 parts, and two sets share at most the smaller count of each part. A larger set has one to
four bits a shingle that tell the parts with an odd number of them; each bit in which two sets differ is
a shingle that they do not share. Pairs under a pivot are looked at once for all its entries, set by set,
unless its entries are so short that they give fewer pairs. First only the few
pairs of two components whose sketches agree most are compared: nearly all components that belong together
are joined by these, however many pairs they have. What is left between components after that is
compared pair by pair in a last round. Length and
position filters come before every comparison, and sets are compared shingle by shingle. Nothing else is skipped, so components
are exact up to clashes of 64-bit names, and no group of near copies is expanded into its pairs.
Texts to compare travel to their pivot, whose group is dealt out when it is large.

Defined results: words are lower-cased in A-Z only. A text with fewer words than a shingle is
one shingle; texts that are null or without words have none and are linked with nothing. Null
ids are never the smallest id of a component that has others. Rows equal in id and text share
their result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import (
    SLICE_BYTES, bounded_batches, components, mixed, named_words, packed, small_side, staying, stored,
    table, text_or_empty, text_slices, tidy,
)

WORDS = 5
PERCENT = 75
FREQUENT = 5e-7
LEAST_FREQUENT = 16
CHUNK = 8_000_000
SMALL_GROUP = 64
GROUP_ROWS = 16_384
BLOCK_SETS = 4_096
MOST_PAIRS = 2_000_000
LIKELY = 4
PARTS = 256
COUNTED = 256
TIGHT = 2048
MOST_FLIPS = 1 << 16


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Ascending distinct shingle names of each text."""
    found, sizes = named_words(texts, lower=True)
    ends = np.cumsum(sizes)
    names = found
    if len(found) >= words:
        names = found[: len(found) - words + 1]
        for k in range(1, words):
            names = mixed(names, found[k : len(found) - words + 1 + k])
    out = []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        if size >= words:
            own = np.sort(names[end - size : end - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif size:
            name = found[end - size : end - size + 1]
            for k in range(end - size + 1, end):
                name = mixed(name, found[k : k + 1])
            out.append(mixed(name, np.full(1, size, np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set."""
    first = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
    low = np.array([f & 0xFFFFFFFFFFFFFFFF for f in first], np.uint64)
    return low.view(np.int64), np.array([f >> 64 for f in first], np.uint64).view(np.int64)


def required(n: int, percent: int = PERCENT) -> int:
    return -(-percent * n // 100)


def sketch(tokens: np.ndarray) -> bytes:
    """How many shingles fall into each part; empty if a count does not fit into a byte."""
    counts = np.bincount((tokens >> np.uint64(56)).astype(np.int64), minlength=PARTS)
    return counts.astype(np.uint8).tobytes() if len(tokens) and counts.max() < 256 else b""


def most_shared(left: bytes, right: bytes) -> tuple[int, int]:
    """An upper bound of the common shingles, and the two sizes together."""
    x, y = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    return int(np.minimum(x, y).sum(dtype=np.int64)), int(x.sum(dtype=np.int64) + y.sum(dtype=np.int64))


def flips(tokens: np.ndarray) -> bytes:
    """A bit for each part that holds an odd number of shingles: two to four parts a shingle, one to two in
    sets of over `TIGHT` shingles, `MOST_FLIPS` at most."""
    n = len(tokens)
    parts = min(MOST_FLIPS, 1 << max(6, ((2 * n if n <= TIGHT else n) - 1).bit_length()))
    odd = np.bincount((tokens & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches_of(tokens: np.ndarray) -> tuple[bytes, bytes]:
    """Counts of a small set, flips of a large one; those in between have both, as partners may be of either kind."""
    n = len(tokens)
    return sketch(tokens) if n <= COUNTED else b"", flips(tokens) if 3 * n > 2 * COUNTED else b""


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a binary column, and where each value begins and its length (0 for null)."""
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), edges[:-1], np.diff(edges)


def flips_apart(flipped: tuple[np.ndarray, ...], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For pairs of rows with flips, given as `_bytes_of` does, a lower bound of the shingles that only one set has.

    The longer flips are folded to the length of the shorter ones: part k joins part k + half.
    """
    data, starts, sizes = flipped
    width, apart = np.minimum(sizes[i], sizes[j]), np.zeros(len(i), np.int64)
    for short in np.unique(width).tolist():
        at = np.flatnonzero(width == short)
        rows, where = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        folded = np.empty((len(rows), short), np.uint8)
        for size in np.unique(sizes[rows]).tolist():
            own = np.flatnonzero(sizes[rows] == size)
            found = data[starts[rows[own], None] + np.arange(size)].reshape(len(own), size // short, short)
            folded[own] = np.bitwise_xor.reduce(found, axis=1)
        words, left, right = folded.view(np.uint64), where[: len(at)], where[len(at) :]
        step = max(1, SLICE_BYTES // short)
        for k in range(0, len(at), step):
            differ = words[left[k : k + step]] ^ words[right[k : k + step]]
            apart[at[k : k + step]] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
    return apart


# --- First scan: sets and frequent shingles ---------------------------------------------


def _scan(rows: DataFrame, id_type: str, words: int) -> DataFrame:
    """Two kinds of rows: documents (id, k1, k2, n, key, check, sketch, flips), and chunk counts (key, n)
    with `counted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, id_kind = [], 0, None

        def counts() -> pa.RecordBatch:
            every = np.concatenate(held)
            token, n = np.unique(every, return_counts=True)
            often = n > max(1, FREQUENT / 2 * len(every))
            token, n = token[often], n[often]
            nothing = pa.array(np.zeros(len(n), np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), id_kind), nothing, nothing, pa.array(n), pa.array(token.view(np.int64)),
                 nothing, pa.array(np.ones(len(n), bool)), pa.nulls(len(n), pa.binary()), pa.nulls(len(n), pa.binary())],
                names=["id", "k1", "k2", "n", "key", "check", "counted", "sketch", "flips"],
            )

        for batch in batches:
            id_kind = batch.column(0).type
            texts = batch.column(3)
            for begin, end in text_slices(texts):
                sets = shingle_sets(texts.slice(begin, end - begin), words)
                key, check = set_names(sets)
                sizes = np.array([len(s) for s in sets], np.int64)
                sketches = [sketches_of(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(begin, end - begin) for k in range(3)), pa.array(sizes),
                     pa.array(key), pa.array(check), pa.array(np.zeros(len(sets), bool)),
                     *(pa.array([s[k] for s in sketches], pa.binary()) for k in range(2))],
                    names=["id", "k1", "k2", "n", "key", "check", "counted", "sketch", "flips"],
                )
                held += sets
                size += int(sizes.sum())
                if size >= CHUNK:
                    yield counts()
                    held, size = [], 0
        if size:
            yield counts()

    return rows.mapInArrow(tidy(run), f"id {id_type}, k1 long, k2 long, n long, key long, check long, counted boolean, sketch binary, flips binary")


# --- Second scan: the index -------------------------------------------------------------


def levels_of(n: int, percent: int) -> list[int]:
    """Size classes in which a set can be the smaller or the larger of a similar pair."""
    own = n.bit_length() - 1
    return [own] if 100 * n // percent < 2 << own else [own, own + 1]


def parts_of(level: int) -> int:
    return max(1, (1 << level) // 16)


def entries(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set, and the place of each in the global order (0 for pairs)."""
    n = len(tokens)
    if n < 3:  # similar sets of one or two shingles are equal
        return tokens[:0], np.zeros(0, np.int64)
    prefix = n - required(n, percent) + 1
    heavy = None
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        common = frequent[at] == tokens
        if n - np.count_nonzero(common) < prefix:
            heavy = tokens[common][np.argsort(rank[at[common]], kind="stable")]
        tokens = tokens[~common]
    if heavy is None:
        return tokens[:prefix], np.arange(prefix)
    out = [tokens]
    for level in levels_of(n, percent):
        parts = parts_of(level)
        reached = heavy[: prefix + parts - len(tokens)]
        part = (reached >> np.uint64(7)) % np.uint64(parts)
        order = np.lexsort((reached, part))
        reached, part = reached[order], part[order]
        for own in np.split(reached, np.flatnonzero(np.diff(part)) + 1):
            a, b = np.triu_indices(len(own), 1)
            out.append(mixed(mixed(own[a], own[b]), np.full(len(a), level, np.uint64)))
    found = np.concatenate(out)
    places = np.zeros(len(found), np.int64)
    places[: len(tokens)] = np.arange(len(tokens))
    return found, places


def _index(rows: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """token, key, n, place; a batch gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, rank = frequent.value
        for batch in batches:
            texts, seen = batch.column(0), set()
            for begin, end in text_slices(texts):
                sets = shingle_sets(texts.slice(begin, end - begin), words)
                keys, _ = set_names(sets)
                parts = []
                for own, key in zip(sets, keys.tolist()):
                    if key not in seen:
                        seen.add(key)
                        found, places = entries(own, tokens, rank, percent)
                        parts.append((found, places, key, len(own)))
                sizes = [len(p[0]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([p[0] for p in parts] or [keys[:0].view(np.uint64)]).view(np.int64)),
                        pa.array(np.repeat(np.array([p[2] for p in parts], np.int64), sizes)),
                        pa.array(np.repeat(np.array([p[3] for p in parts], np.int32), sizes)),
                        pa.array(np.concatenate([p[1] for p in parts] or [np.zeros(0)]).astype(np.int32)),
                    ],
                    names=["token", "key", "n", "place"],
                )

    return rows.mapInArrow(tidy(run), "token long, key long, n int, place int")


def _with_pivots(index: DataFrame) -> DataFrame:
    """Entries of more than one set, with the pivot's key, n and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (token, key, n, place) of the row before the batch, and its pivot
        pivot = None
        for batch in batches:
            token, key, n, place = (c.to_numpy() for c in batch.columns)
            if not len(token):
                continue
            new_token = np.concatenate([[last is None or token[0] != last[0]], token[1:] != token[:-1]])
            again = ~new_token & np.concatenate([[last is not None and key[0] == last[1]], key[1:] == key[:-1]])
            starts = np.flatnonzero(new_token)
            # The pivot of a row is the first row of its token, which may be in an earlier batch.
            owner = np.cumsum(new_token) - 1
            at = np.where(owner >= 0, starts[np.maximum(owner, 0)] if len(starts) else 0, -1)
            pivots = [
                np.where(at >= 0, column[np.maximum(at, 0)], 0 if pivot is None else pivot[k])
                for k, column in enumerate((key, n, place))
            ]
            last = (token[-1], key[-1])
            pivot = tuple(p[-1] for p in pivots)
            member = ~new_token & ~again
            if member.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[member]) for a in (token, key, n, place, *pivots)],
                    names=["token", "key", "n", "place", "pivot", "pivot_n", "pivot_place"],
                )

    fields = "token long, key long, n int, place int, pivot long, pivot_n int, pivot_place int"
    return index.repartition("token").sortWithinPartitions("token", "key").mapInArrow(tidy(run), fields)


def _possible(n, place, other_n, other_place, percent: int):
    """Length and position filters; the latter holds at the first entry that a pair shares."""
    smaller, larger = F.least(n, other_n), F.greatest(n, other_n)
    most = F.least(n - place, other_n - other_place)
    return (smaller * 100 >= larger * percent) & (most * (100 + percent) >= (n + other_n) * percent)


# --- Verifying --------------------------------------------------------------------------


def _compared(pairs: DataFrame, texts: DataFrame, words: int, split: int = 512) -> DataFrame:
    """a, b, common, either of each pair (a, b); `texts` has key and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, last, seen = None, None, None
        for batch in batches:
            a, part, member, key = (batch.column(k).to_numpy() for k in range(4))
            unpacker = zstandard.ZstdDecompressor()
            raw = [unpacker.decompress(t.as_buffer()) for t in batch.column(4)]
            out, at = [], 0
            while at < len(raw):
                # A bounded stretch of texts at a time.
                stop, size = at, 0
                while stop < len(raw) and (stop == at or size + len(raw[stop]) <= SLICE_BYTES):
                    size += len(raw[stop])
                    stop += 1
                sets = shingle_sets(pa.array(raw[at:stop], pa.binary()).cast(pa.string()), words)
                for k, own in enumerate(sets, at):
                    if not member[k]:
                        pivot, last, seen = own, (a[k], part[k]), None
                    elif last == (a[k], part[k]) and key[k] != seen:  # a row of the same text may come twice
                        seen = key[k]
                        common = _common(pivot, own)
                        out.append((a[k], key[k], common, len(pivot) + len(own) - common))
                at = stop
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "common", "either"]
                )

    # Pairs of one pivot are dealt into parts; the pivot's text goes to each of them.
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / split).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("member"),
        F.col("b").alias("key"),
    )
    heads = parts.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"),
        F.col("a").alias("key"),
    )
    moved = stored(dealt.unionByName(heads), "to-compare")
    together = texts.join(small_side(moved), "key").select("a", "part", "member", "key", "packed")
    return (
        together.repartition("a", "part").sortWithinPartitions("a", "part", "member", "key")
        .mapInArrow(tidy(run), "a long, b long, common long, either long")
    )


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)) if len(y) else 0


def _most_alike(components: np.ndarray, share: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` pairs with the largest share of every two components, given as columns."""
    order = np.lexsort((-share, components[1], components[0]))
    of = components[:, order]
    new = np.concatenate([[True], (of[:, 1:] != of[:, :-1]).any(axis=0)])
    starts = np.flatnonzero(new)
    return order[np.arange(len(order)) - starts[np.cumsum(new) - 1] < most]


def _shapes(groups: DataFrame) -> DataFrame:
    """How the entries of each pivot are dealt: by set, in blocks, if its entries give more pairs than its sets do."""
    sets = groups.select("pivot", "key").distinct().groupBy("pivot").agg(F.count("*").alias("sets"))
    return groups.groupBy("pivot", "token").agg(F.count("*").alias("rows")).groupBy("pivot").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("rows")).alias("of_entries")
    ).join(sets, "pivot").select(
        "pivot", (F.col("sets") * F.col("sets") <= F.col("of_entries")).alias("by_set"),
        F.ceil(F.col("rows") / GROUP_ROWS).alias("parts"), F.ceil(F.col("sets") / BLOCK_SETS).cast("int").alias("blocks"),
    )


def _dealt(groups: DataFrame, shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of entries, in parts that a task can hold, with all rows of a part that may have to be compared.

    A pivot's sets mostly share many entries. Where `shapes` says so, the sets take the entries' place:
    once each, in blocks of some `BLOCK_SETS`, and every two blocks are one entry and part, `side`
    telling the blocks. Other entries are dealt into parts of some `GROUP_ROWS` rows; the second result
    names the sets of such a part once each, as rows of side 3.
    """
    own, other = F.col("own"), F.col("other")
    sets = groups.join(shapes.filter("by_set"), "pivot").select(
        "pivot", "key", "n", "component", "low", "high", "blocks"
    ).distinct()
    paired = sets.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        F.xxhash64("pivot", F.least(own, other), F.greatest(own, other)).alias("part"), "key", "n",
        F.lit(0).alias("place"), "component", "low", "high",
        F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("side"),
    ).withColumn("token", F.col("part"))
    listed = groups.join(shapes.filter("not by_set"), "pivot").select(
        F.xxhash64("pivot", F.pmod(F.xxhash64("token"), "parts")).alias("part"), "key", "n",
        "place", "component", "low", "high", F.lit(0).alias("side"), "token",
    )
    nothing = {"n": F.lit(0), "place": F.lit(0), "component": F.col("key"), "low": F.lit(0.0), "high": F.lit(0.0)}
    named = listed.select("part", "key").distinct().withColumns(nothing | {"side": F.lit(3), "token": F.lit(0).cast("long")})
    return listed, paired.unionByName(named)


def _between(groups: DataFrame, shapes: DataFrame, sketches: DataFrame, percent: int, likely: int = 0) -> DataFrame:
    """Pairs of different components under one entry that the pivot's distances leave possible.

    With `likely`, only so many pairs of every two components of a part: those whose sketches agree most.

    Rows come sorted by part, token, side and component, and a pair is put out once for all entries
    of a part. Rows of short entries are compared with the rows a fixed number of places on, for
    all entries of a batch together; in long ones every row is compared with those of earlier
    components, or of the other side. Sketches come along, once for each set of a part, so pairs they rule
    out are never put out.
    """
    near = 1 - percent / 100 + 1e-9

    def pairs(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        rows = [whole.column(k).to_numpy().astype(np.float64 if k in (5, 6) else np.int64) for k in range(8)]
        names, number = np.unique(rows[1], return_inverse=True)
        counted, flipped = (_bytes_of(whole.column(k).chunk(0)) for k in (8, 9))
        # The row that has the sketches of a set; without one, those of any row without sketches will do.
        holder = np.zeros(len(names), np.int64)
        has = (counted[2] > 0) | (flipped[2] > 0)
        holder[number[~has]], holder[number[has]] = np.flatnonzero(~has), np.flatnonzero(has)
        holder = holder[number]
        entry = rows[7] < 3
        token, _, n, place, component, low, high, side, number, holder = (c[entry] for c in (*rows, number, holder))
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.append(starts, len(token)))
        short = np.repeat(sizes <= SMALL_GROUP, sizes)
        found, kept = [], []

        def possible(i, j) -> np.ndarray:
            """What length, position and distances leave of some rows, given by places or as a range, and others or one."""
            smaller, larger = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            most = np.minimum(n[i] - place[i], n[j] - place[j])
            return (
                (smaller * 100 >= larger * percent) & (most * (100 + percent) >= (n[i] + n[j]) * percent)
                & (low[i] - high[j] <= near) & (low[j] - high[i] <= near) & (component[i] != component[j])
            )

        def sketched(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Pairs that share enough of their sketches, and the share; rows without one may share anything."""
            keep, share = np.ones(len(i), bool), np.ones(len(i))
            total, left, right = n[i] + n[j], holder[i], holder[j]
            by_flips = (flipped[2][left] > 0) & (flipped[2][right] > 0)
            at = np.flatnonzero(by_flips)
            twice = total[at] - flips_apart(flipped, left[at], right[at])
            keep[at] = twice * (100 + percent) >= 2 * total[at] * percent
            share[at] = twice / (2 * total[at])
            data, begins, lengths = counted
            both = np.flatnonzero(~by_flips & (lengths[left] == PARTS) & (lengths[right] == PARTS))
            for begin in range(0, len(both), 4096):
                at = both[begin : begin + 4096]
                x, y = (data[begins[s[at], None] + np.arange(PARTS)] for s in (left, right))
                common = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                keep[at] = common * (100 + percent) >= total[at] * percent
                share[at] = common / total[at]
            return keep, share

        def settle() -> None:
            """Look once at each pair found so far and keep what the sketches allow."""
            i, j = (np.concatenate(f) for f in zip(*found))
            found.clear()
            pair = np.minimum(number[i], number[j]) * len(names) + np.maximum(number[i], number[j])
            pair, once = np.unique(pair, return_index=True)
            i, j = i[once], j[once]
            allowed, share = sketched(i, j)
            sides = np.stack([np.minimum(component[i], component[j]), np.maximum(component[i], component[j])])
            kept.append(alike(pair[allowed], sides[:, allowed], share[allowed]))

        def alike(pair: np.ndarray, sides: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, ...]:
            if not likely or not len(share):
                return pair, sides, share
            best = _most_alike(sides, share, likely)
            return pair[best], sides[:, best], share[best]

        waiting = 0
        for apart in range(1, min(SMALL_GROUP, int(sizes.max()))):
            i = np.flatnonzero(
                short[:-apart] & (token[:-apart] == token[apart:]) & ((side[:-apart] == 0) | (side[:-apart] != side[apart:]))
            )
            i = i[possible(i, i + apart)]
            if len(i):
                found.append((i, i + apart))
                waiting += len(i)
            if waiting > MOST_PAIRS:
                settle()
                waiting = 0
        for begin, size in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
            own = component[begin : begin + size]
            first = int(np.count_nonzero(side[begin : begin + size] == 1))
            for k in range(max(1, first), size):
                earlier = first or int(np.searchsorted(own, own[k]))
                i = begin + np.flatnonzero(possible(slice(begin, begin + earlier), begin + k))
                if len(i):
                    found.append((i, np.full(len(i), begin + k)))
                    waiting += len(i)
                if waiting > MOST_PAIRS:
                    settle()
                    waiting = 0
        if found:
            settle()
        if kept:
            pair, sides, share = (np.concatenate(k, axis=-1) for k in zip(*kept))
            pair, once = np.unique(pair, return_index=True)
            pair = alike(pair, sides[:, once], share[once])[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[pair // len(names)]), pa.array(names[pair % len(names)])], names=["a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(10).to_numpy()
            last = len(parts) - int(np.argmax(np.append(parts[::-1] != parts[-1], True)))
            if last:  # every part but the batch's last one is complete
                yield from pairs([*held, batch.slice(0, last)])
                held = []
            elif held and held[-1].column(10)[0].as_py() != parts[0]:
                yield from pairs(held)
                held = []
            held.append(batch.slice(last))
        if held:
            yield from pairs(held)

    listed, sketched = _dealt(groups, shapes)
    sketched = sketched.join(small_side(sketches), "key", "left")
    every = listed.withColumns({name: F.lit(None).cast("binary") for name in ("sketch", "flips")}).unionByName(sketched)
    return (
        every.select("token", "key", "n", "place", "component", "low", "high", "side", "sketch", "flips", "part")
        .repartition("part").sortWithinPartitions("part", "token", "side", "component")
        .mapInArrow(tidy(run), "a long, b long").distinct()
    )


def _frequent(scan: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles in ascending order, and the rank of each by its count."""
    least = max(LEAST_FREQUENT, int(FREQUENT * total))
    often = (
        scan.filter("counted").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        .toArrow()  # at most 1 / FREQUENT rows
    )
    token, count = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    rank = np.empty(len(token), np.int64)
    rank[np.lexsort((token, count))] = np.arange(len(token))
    order = np.argsort(token)
    return token[order], rank[order]


def _placed(index: DataFrame, labels: DataFrame) -> DataFrame:
    """Index entries with the component of their set and of their pivot."""
    of_key = labels.select(F.col("node").alias("key"), "component")
    of_pivot = labels.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    return index.join(of_key, "key", "left").join(of_pivot, "pivot", "left").withColumns(
        {
            "component": F.coalesce("component", "key"),
            "pivot_component": F.coalesce("pivot_component", "pivot"),
        }
    )


def _open_entries(placed: DataFrame, name: str) -> DataFrame:
    """The rows of entries that are in several components."""
    several = placed.groupBy("token").agg(
        F.min(F.least("component", "pivot_component")).alias("least"),
        F.max(F.greatest("component", "pivot_component")).alias("most"),
    ).filter(F.col("least") != F.col("most"))
    return stored(placed.join(stored(several.select("token"), f"{name}-tokens"), "token", "left_semi"), name)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links).

    `percent` is 67 to 100. The index leaves out sets of one and two shingles, which may be
    similar to unequal ones up to 66, and looks at one size class up, too few under 50.
    """
    if not 67 <= percent <= 100:
        raise ValueError(f"percent must be 67 to 100, not {percent}: the index would miss links")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
        "id", F.xxhash64(F.col("id").cast("string")).alias("k1"), F.xxhash64("text").alias("k2"), "text"
    )
    scan = stored(_scan(rows, docs.schema[id_col].dataType.simpleString(), words), "shingled")
    members = scan.filter("not counted")
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = spark.sparkContext.broadcast(_frequent(scan, total))
    # A class of equal sets, the row whose text stands for it, and its smallest id.
    classes = stored(
        members.filter("n > 0").groupBy("key", "n", "check").agg(
            F.min("id").alias("low"), F.min(F.struct("k1", "k2")).alias("row")
        ),
        "classes",
    )

    index = stored(_with_pivots(_index(rows.select("text"), frequent, words, percent)), "index")
    possible = _possible(F.col("n"), F.col("place"), F.col("pivot_n"), F.col("pivot_place"), percent)
    # The texts that may have to be compared, once per class.
    wanted = index.select("key").union(index.select(F.col("pivot").alias("key"))).distinct()
    wanted = stored(
        classes.join(wanted, "key", "left_semi").select("key", F.col("row.k1").alias("k1"), F.col("row.k2").alias("k2")),
        "wanted",
    )
    texts = stored(
        packed(rows.select("k1", "k2", "text")).join(small_side(wanted), ["k1", "k2"]).select("key", "packed"),
        "texts",
    )
    similar = F.col("common") * 100 >= F.col("either") * percent

    # First every set with the least of its pivots.
    least = index.filter(possible).groupBy("key").agg(F.min("pivot").alias("a")).select("a", F.col("key").alias("b"))
    first = stored(_compared(stored(least, "first-pairs"), texts, words), "first-compared")
    links = first.filter(similar).select("a", "b")
    labels = components(links, "first")

    # Then, where entries are in several components, every set with the entry's pivot.
    open_ = _open_entries(_placed(index, labels), "open")
    pairs = open_.filter(possible).select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    pairs = stored(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), "second-pairs")
    compared = first
    if not pairs.isEmpty():
        second = stored(_compared(pairs, texts, words), "second-compared")
        compared = first.unionByName(second)
        links = compared.filter(similar).select("a", "b")
        labels = components(links, "second")
        open_ = _open_entries(_placed(open_.drop("component", "pivot_component"), labels), "still-open")

    # At last the pairs between components that the pivot's distances leave possible.
    distance = compared.select(
        F.col("a").alias("pivot"), F.col("b").alias("key"),
        (1 - F.col("common") / F.col("either")).alias("distance"),
    )
    measured = open_.join(distance, ["pivot", "key"], "left").select(
        "token", "pivot", "key", "n", "place", "component", "pivot_component",
        # Pairs that a filter kept from being compared are less similar than t: farther than that.
        F.coalesce("distance", F.lit(1 - percent / 100)).alias("low"),
        F.coalesce("distance", F.lit(1.0)).alias("high"),
    )
    measured = stored(measured, "measured")
    some = stored(measured.select("key").distinct(), "measured-keys")
    sketches = stored(
        members.select("key", "sketch", "flips").join(small_side(some), "key", "left_semi").dropDuplicates(["key"]), "sketches"
    )

    shapes = small_side(stored(_shapes(measured), "shapes"))
    # The likely ones first; if there are none, there are no pairs at all.
    likely = stored(_between(measured, shapes, sketches, percent, LIKELY), "likely")
    if not likely.isEmpty():
        likely = stored(likely.join(compared.select("a", "b"), ["a", "b"], "left_anti"), "third-pairs")
        third = stored(_compared(likely, texts, words), "third-compared")
        compared = compared.unionByName(third)
        links = compared.filter(similar).select("a", "b")
        labels = components(links, "third")
        apart = _open_entries(_placed(measured.drop("component", "pivot_component"), labels), "apart")
        rest = stored(_between(apart, shapes, sketches, percent).join(compared.select("a", "b"), ["a", "b"], "left_anti"), "between")
        if not rest.isEmpty():
            links = links.union(_compared(rest, texts, words).filter(similar).select("a", "b"))
            labels = components(links, "links")

    # From classes of equal sets to documents.
    of_class = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    lowest = stored(of_class.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    of_class = stored(of_class.join(lowest, "component").select("key", "n", "check", "component_id"), "labelled")
    linked = members.filter("n > 0").join(of_class, ["key", "n", "check"]).select(
        "id", F.col("n").alias("n_shingles"), "component_id"
    )
    alone = members.filter("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of every component, with the columns of the input.

    A row goes by its id and the hash of its text, so no whole row is written: those that go are
    looked up while the input is read once more. Of rows equal in id and text one stays, unless
    the text has no words; rows of a component with one id are told by the hash.
    """
    named = docs.select(
        F.struct("*").alias("row"),
        F.struct(
            F.col(id_col).isNull().alias("lacks"), F.col(id_col).alias("id"),
            F.xxhash64(text_or_empty(text_col)).alias("hash"),
        ).alias("name"),
    )
    found = near_duplicates(named.select("name", F.col("row")[text_col].alias("text")), "name", "text")
    names = found.filter("n_shingles > 0").groupBy("id").agg(
        F.first("component_id").alias("component_id"), F.count("*").alias("rows")
    )
    leave = F.col("id") != F.col("component_id")
    return staying(named, names.select("id", leave.alias("leave"), "rows"))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
