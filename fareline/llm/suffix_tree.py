"""Language-model scores from a probabilistic suffix tree over words.

Growing. Every string of 1 to `DEPTH + 1` words of the training documents is counted, however
rare: a passage has the same evidence in a small corpus and in a large one. Blocks (see below)
deal out the names of their distinct strings in parts by name; the sums go back to the blocks for
strings that several blocks have. A block sends a part as one row and finds the answer's places by
their order, so places do not travel, and lengths go one after another, so that the exchange of
one is dropped before the next. No list of strings passes the driver or is broadcast.

Retaining. Strings of up to `DEPTH` words are candidate contexts. A context stays if its
divergence from its suffix (the context without its first word), the sum over next words of
n * ln(P(w | context) / P(w | suffix)), reaches `LEAST_GAIN`, or if a longer retained context
ends with it. A block that knows the counts of its strings has its share of every sum; it
decides alone about contexts that no other block has, the others are summed by name, long ones
first, as each that stays keeps its suffix.

Next words. The root is the smoothed word distribution (c + 0.5) / (N + 0.5 (V + 1)). A context
s gives P(w | s) = (n(s w) + MASS * P(w | suffix of s)) / (n(s) + MASS), with n(s) the count of
s in training, all its next words included. A word is scored by the longest retained context in
front of it. Documents begin without context; their end is a token.

A caller may ask for a small tree with `p_min` above 0: strings that make up less than that
share of the training tokens then count 0, n(s) is the sum over the others, and the strings are
broadcast (at most `1 / p_min` of each length). The query does not do so.

Texts are read once. The task that reads them stores blocks of about `BLOCK_TOKENS` tokens: the
distinct words of a block, and its tokens as places among them. Counting, growing and scoring
read the blocks. A block asks once for every distinct word in it, and the answers come back to
the block's task; neither tokens nor answers pass the driver. Words go by 64-bit names (see
`named_words`), strings by the mixed names of their words.

Defined results: a null text is empty and has the end token only. Every row is scored, so
repeated rows and repeated or null ids give a row each; a null id counts as the text "" for the
fold. Without training documents N and V are 0, so every score is 0. An empty table gives no
row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import (
    bounded_batches, mixed, named_words, stored, table, text_or_empty, text_slices, tidy,
)

DEPTH = 3
P_MIN = 0.0  # every string counts
LEAST_GAIN = 8.0
MASS = 4.0
FOLDS, HELD_OUT = 5, 1
BLOCK_TOKENS = 500_000
SLICE_TOKENS = 200_000
PART_TOKENS = 2_000_000
FORCED = 1 << 61  # stands for the gain infinity
COUNTED_TOGETHER = ((1, 2), (3,), (4,))  # lengths whose names are on the disk at the same time
WORD_BITS = 31  # room for the number of a word, frequent or of one block

END = np.int64(np.uint64(xxhash.xxh3_64_intdigest(b"\n")).view(np.int64))  # the name of no word but by a clash


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of all tokens of some texts, one text after another, and the number of each text."""
    words, sizes = named_words(texts, lower=True)
    sizes = sizes + 1
    ends = np.cumsum(sizes)
    found = np.full(int(ends[-1]) if len(ends) else 0, END)
    real = np.ones(len(found), bool)
    real[ends - 1] = False
    found[real] = words.view(np.int64)
    return found, sizes


@dataclass
class Strings:
    """Frequent strings of one length, sorted by key: (number of all but the last word, last word)."""

    keys: np.ndarray
    counts: np.ndarray
    suffix: np.ndarray  # number of the string without its first word, one length down
    total: np.ndarray | None = None  # n(s), for contexts
    retained: np.ndarray | None = None


def lookup(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in an ascending array, -1 where missing."""
    if not len(ordered):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def numbered(levels: list[Strings], words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each length, the number of the frequent string that ends at each token, or -1.

    `words` has the numbers of length one, `first` marks the first token of each document.
    """
    out = [words]
    for level in levels[1:]:
        here = np.full(len(words), -1)
        place = candidates(out[-1], words, first)
        here[place] = lookup(level.keys, out[-1][place - 1] << WORD_BITS | words[place])
        out.append(here)
    return out


def firsts(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(int(sizes.sum()), bool)
    out[np.cumsum(sizes) - sizes] = True
    return out


def candidates(shorter: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where strings one longer may end: the string up to the word before is frequent,
    the word is, and so is the string without its first word."""
    ends = (shorter[1:] >= 0) & (shorter[:-1] >= 0) & (words[1:] >= 0) & ~first[1:]
    return np.flatnonzero(ends) + 1


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


# --- Blocks ----------------------------------------------------------------------------


@dataclass
class Block:
    """Tokens of some documents as places in `words`, the distinct names, most frequent first."""

    ids: pa.Array
    held_out: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    tokens: np.ndarray

    def training(self) -> "Block":
        """The training documents alone."""
        kept = ~np.repeat(self.held_out, self.sizes)
        return Block(self.ids, self.held_out, self.sizes[~self.held_out], self.words, self.tokens[kept])

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens and sizes of a bounded stretch of documents at a time."""
        ends = np.cumsum(self.sizes)
        begin = 0
        while begin < len(ends):
            start = ends[begin] - self.sizes[begin]
            end = max(begin + 1, int(np.searchsorted(ends, start + SLICE_TOKENS, "right")))
            yield self.tokens[start : ends[end - 1]], self.sizes[begin:end]
            begin = end


def _blocks(rows: DataFrame, id_type: str) -> DataFrame:
    """A row per block; the tokens are packed, as they are moved once more for scoring."""

    def whole(values) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def packed(number: int, held: list) -> pa.RecordBatch:
        sizes = np.concatenate([h[3] for h in held]).astype(np.int32)
        words, place, counts = np.unique(
            np.concatenate([h[2] for h in held]), return_inverse=True, return_counts=True
        )
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), whole(pa.concat_arrays([h[0] for h in held])),
                whole(pa.concat_arrays([h[1] for h in held])), whole(pa.array(sizes)),
                whole(pa.array(words[order])),
                pa.array([_planes(rank[place])], pa.binary()),
            ],
            names=["block", "ids", "held_out", "sizes", "words", "tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            texts = batch.column(2)
            for begin, end in text_slices(texts):
                found, sizes = tokens(texts.slice(begin, end - begin))
                held.append([batch.column(k).slice(begin, end - begin) for k in (0, 1)] + [found, sizes])
                size += len(found)
                if size >= BLOCK_TOKENS:
                    yield packed(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield packed(number, held)

    fields = (
        f"block long, ids array<{id_type}>, held_out array<boolean>, sizes array<int>, "
        "words array<long>, tokens binary"
    )
    return rows.select("id", "held_out", "text").mapInArrow(tidy(run), fields)


def _planes(values: np.ndarray) -> bytes:
    """Numbers packed with the first bytes of all, then the second ones."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _numbers(packed: pa.Buffer, kind) -> np.ndarray:
    found = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return found.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _unpacked(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, Block]]:
    for k in range(batch.num_rows):
        row = [batch.column(c)[k] for c in range(6)]
        yield row[0].as_py(), Block(
            row[1].values, row[2].values.to_numpy(zero_copy_only=False), row[3].values.to_numpy().astype(np.int64),
            row[4].values.to_numpy(),
            _numbers(row[5].as_buffer(), np.int32),
        )


# --- Growing ---------------------------------------------------------------------------


def word_counts(blocks: DataFrame) -> DataFrame:
    """word, n over all training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in _unpacked(batch):
                n = np.bincount(block.training().tokens, minlength=len(block.words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.words[n > 0]), pa.array(n[n > 0])], names=["word", "n"]
                )

    return blocks.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _longer(blocks: DataFrame, levels: list[Strings], least: int) -> Strings:
    """Frequent strings one word longer than the last level."""
    shared = blocks.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for _, block in _unpacked(batch):
                number, keys = lookup(known[0].keys, block.words), [np.empty(0, np.int64)]
                for place, sizes in block.training().slices():
                    words, first = number[place], firsts(sizes)
                    last = numbered(known, words, first)[-1]
                    at = candidates(last, words, first)
                    keys.append(last[at - 1] << WORD_BITS | words[at])
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counted = blocks.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # At most 1 / p_min rows: each makes up p_min of the tokens.
    rows = counted.filter(F.col("n") >= least).toArrow().sort_by("key")
    shared.unpersist()
    keys, counts = rows["key"].to_numpy(), rows["n"].to_numpy()
    last = keys & ((1 << WORD_BITS) - 1)
    if len(levels) == 1:
        return Strings(keys, counts, last)
    shorter = levels[-1].suffix[keys >> WORD_BITS]
    return Strings(keys, counts, lookup(levels[-1].keys, shorter << WORD_BITS | last))


def grow(
    blocks: DataFrame, counts: DataFrame, n: int, v: int,
    depth: int, p_min: float, least_gain: float = LEAST_GAIN,
) -> list[Strings]:
    """Frequent strings of 1 to depth + 1 words, with the contexts to use marked."""
    least = max(1, int(np.ceil(p_min * n)))
    words = counts.filter(F.col("n") >= least).toArrow().sort_by("word")
    levels = [Strings(words["word"].to_numpy(), words["n"].to_numpy(), np.zeros(len(words), np.int64))]
    for _ in range(depth):
        levels.append(_longer(blocks, levels, least))
    retain(levels, n, v, least_gain)
    return levels


def retain(levels: list[Strings], n: int, v: int, least_gain: float) -> None:
    """Smooth the next words of every candidate context and test its divergence."""
    below = (levels[0].counts + 0.5) / (n + 0.5 * (v + 1)) if n else np.zeros(0)
    gains = []
    for contexts, pairs in zip(levels, levels[1:]):
        context = pairs.keys >> WORD_BITS
        contexts.total = np.bincount(context, pairs.counts, len(contexts.keys))
        # P(w | suffix) of each pair: the pair of the suffix and w, one length down.
        suffix = below[pairs.suffix]
        below = (pairs.counts + MASS * suffix) / (contexts.total[context] + MASS)
        gains.append(np.bincount(context, pairs.counts * np.log(below / suffix), len(contexts.keys)))
    above = np.zeros(0, np.int64)  # suffixes of retained contexts one longer
    for contexts, gain in zip(reversed(levels[:-1]), reversed(gains)):
        contexts.retained = gain >= least_gain
        contexts.retained[above] = True
        above = contexts.suffix[contexts.retained]


def probabilities(levels: list[Strings], words: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Of each token, from its number as a frequent word and its base probability."""
    first = firsts(sizes)
    return _smoothed(levels, numbered(levels, words, first), first, base)


def _smoothed(levels: list[Strings], numbers: list[np.ndarray], first: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Of each token, from the numbers of the strings that end at it."""
    out = base.copy()
    place = np.flatnonzero(~first)
    for contexts, pairs, context, pair in zip(levels, levels[1:], numbers, numbers[1:]):
        state = context[place - 1]
        place, state = place[state >= 0], state[state >= 0]
        kept = contexts.retained[state]
        place, state = place[kept], state[kept]
        if not len(place):
            break
        count = np.where(pair[place] >= 0, pairs.counts[pair[place]], 0) if len(pairs.counts) else 0
        out[place] = (count + MASS * out[place]) / (contexts.total[state] + MASS)
    return out


# --- Every string ----------------------------------------------------------------------


@dataclass
class Own:
    """The strings of one block by length: names, training counts, and the number that ends at each token."""

    levels: list[Strings]
    names: list[np.ndarray]
    counts: list[np.ndarray]
    numbers: list[np.ndarray]


def own_strings(block: Block, depth: int) -> Own:
    words, first = block.tokens.astype(np.int64), firsts(block.sizes)
    train = ~np.repeat(block.held_out, block.sizes)
    # Numbers within a block are 32 bits wide.
    none = np.zeros(len(block.words), np.int64)
    levels, names = [Strings(np.arange(len(block.words)), none, none)], [block.words.view(np.uint64)]
    counts, numbers = [np.bincount(words[train], minlength=len(block.words))], [block.tokens]
    for _ in range(depth):
        at = candidates(numbers[-1], words, first)
        # Numbered by first appearance, the same in every step.
        number, keys = pd.factorize(numbers[-1][at - 1].astype(np.int64) << WORD_BITS | words[at])
        where = np.empty(len(keys), np.int64)
        where[number] = at
        levels.append(Strings(keys, none[:0], numbers[-1][where]))
        names.append(mixed(names[-1][keys >> WORD_BITS], names[0][keys & ((1 << WORD_BITS) - 1)]))
        counts.append(np.bincount(number[train[at]], minlength=len(keys)).astype(np.int32))
        numbers.append(np.full(len(words), -1, np.int32))
        numbers[-1][at] = number
    return Own(levels, names, counts, numbers)


def _packed(values: np.ndarray) -> bytes:
    """Counts, mostly small."""
    large = values[values >= 255].astype(np.int64)
    small = np.minimum(values, 255).astype(np.uint8)
    return zstandard.compress(np.int64(len(small)).tobytes() + small.tobytes() + large.tobytes(), 1)


def _counts(packed: pa.Buffer) -> np.ndarray:
    raw = zstandard.decompress(packed)
    size = 8 + int(np.frombuffer(raw, np.int64, 1)[0])
    values = np.frombuffer(raw, np.uint8, size - 8, 8).astype(np.int64)
    values[values == 255] = np.frombuffer(raw[size:], np.int64)
    return values


def _gains(gains: np.ndarray) -> bytes:
    """Gains to 2 ** -32, so that they take five bytes and their sum does not follow the order."""
    whole = np.where(np.isinf(gains), FORCED, np.rint(np.where(np.isinf(gains), 0, gains) * 2.0**32)).astype(np.int64)
    return _planes(whole << 1 ^ whole >> 63)


def _gains_back(packed: pa.Buffer) -> np.ndarray:
    folded = _numbers(packed, np.int64)
    whole = folded >> 1 ^ -(folded & 1)
    return np.where(whole == FORCED, np.inf, whole / 2.0**32)


def _names(names: np.ndarray) -> bytes:
    """Ascending names, as differences."""
    return _planes(np.diff(names, prepend=np.uint64(0)))


def _names_back(packed: pa.Buffer) -> np.ndarray:
    return np.cumsum(_numbers(packed, np.uint64), dtype=np.uint64)


def _dealt(names: np.ndarray, parts: int, mark: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the names part by part, for marks in ascending order, and the names of each part."""
    part = (names >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    # NumPy sorts 16 bits by counting. Parts are ranges of names.
    by_part = part.astype(np.uint16 if parts <= 1 << 16 else np.uint32)
    order = np.argsort(names) if mark else np.argsort(by_part, kind="stable")
    return order, np.bincount(part.astype(np.int64), minlength=parts)


ASKED = "block long, length int, part long, names binary, amounts binary"
TOLD = "block long, length int, part long, mark boolean, told binary"


def _asking(number: int, length: int, names: np.ndarray, amounts: np.ndarray, parts: int, mark: bool) -> pa.Table:
    """A row for each part that the block has names of: these and their counts, or gains for marks."""
    order, sizes = _dealt(names, parts, mark)
    names, amounts, ends = names[order], amounts[order], np.cumsum(sizes)
    some = np.flatnonzero(sizes)
    ranges = [slice(ends[k] - sizes[k], ends[k]) for k in some]
    pack_names, pack = (_names, _gains) if mark else (np.ndarray.tobytes, _packed)
    return _asked_rows(number, length, some, [pack_names(names[r]) for r in ranges], [pack(amounts[r]) for r in ranges])


def _asked_rows(number: int, length: int, part: np.ndarray, names: list[bytes], amounts: list[bytes]) -> pa.Table:
    return pa.table(
        [
            pa.array(np.full(len(part), number)), pa.array(np.full(len(part), length, np.int32)),
            pa.array(part.astype(np.int64)), pa.array(names, pa.binary()), pa.array(amounts, pa.binary()),
        ],
        names=["block", "length", "part", "names", "amounts"],
    )


def _answered(asked: DataFrame, mark: bool, answer) -> DataFrame:
    """For each row asked, what `answer` makes of all amounts under the number of their name.

    Rows of a part below 0 are a block's own and go back to it as they are.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block").combine_chunks()
        out = rows.select(["block", "length", "part"]).append_column("mark", pa.array(np.full(len(rows), mark)))
        if rows["part"][0].as_py() < 0:
            return out.append_column("told", rows["amounts"])
        unpack_names, unpack = (_names_back, _gains_back) if mark else (lambda x: np.frombuffer(x, np.uint64), _counts)
        names = [unpack_names(x.as_buffer()) for x in rows["names"]]
        number, _ = pd.factorize(np.concatenate(names))
        told = answer(number, np.concatenate([unpack(x.as_buffer()) for x in rows["amounts"]]))[number]
        ends = np.cumsum([len(x) for x in names])
        packed = [_packed(x) for x in np.split(told, ends[:-1])]
        return out.append_column("told", pa.array(packed, pa.binary()))

    return asked.groupBy("length", "part").applyInArrow(run, TOLD)


def _told(told: pa.Table, length: int, mark: bool, names: np.ndarray, parts: int) -> np.ndarray:
    """The answers for names that the block asked about."""
    rows = told.filter(pc.and_(pc.equal(told["length"], length), pc.equal(told["mark"], mark)))
    rows = rows.filter(pc.greater_equal(rows["part"], 0)).sort_by("part")
    out = np.zeros(len(names), np.int64)
    if len(rows):
        answers = np.concatenate([_counts(x.as_buffer()) for x in rows["told"].combine_chunks()])
        out[_dealt(names, parts, mark)[0]] = answers
    return out


def string_counts(blocks: DataFrame, lengths: tuple[int, ...], parts: int) -> DataFrame:
    """Counts in training of the strings that several blocks have, 0 for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _unpacked(batch):
                own = own_strings(block, max(lengths) - 1)
                for length in lengths:
                    names, counts = own.names[length - 1], own.counts[length - 1]
                    yield from _asking(number, length, names, counts, parts, False).to_batches()
                del own, names, counts

    def sums(number: np.ndarray, counts: np.ndarray) -> np.ndarray:
        # A name has at most a row per block.
        return np.where(np.bincount(number) > 1, np.bincount(number, counts).astype(np.int64), 0)

    return _answered(blocks.mapInArrow(tidy(run), ASKED), False, sums)


def _set_counts(own: Own, told: pa.Table, parts: int) -> list[np.ndarray]:
    """Set counts and n(s). By length: which strings other blocks have too."""
    shared = []
    for k, (level, names, mine) in enumerate(zip(own.levels, own.names, own.counts)):
        counts = _told(told, k + 1, False, names, parts)
        shared.append(counts > 0)
        level.counts = level.total = np.where(shared[-1], counts, mine)
    return shared


def _gains_of(own: Own, length: int, n: int, v: int) -> np.ndarray:
    """The block's gains of the contexts of a length."""
    below = (own.levels[0].counts + 0.5) / (n + 0.5 * (v + 1))
    for contexts, pairs in zip(own.levels[:length], own.levels[1:]):
        context, suffix = pairs.keys >> WORD_BITS, below[pairs.suffix]
        below = (pairs.counts + MASS * suffix) / (contexts.total[context] + MASS)
    return np.bincount(context, own.counts[length] * np.log(below / suffix), len(contexts.keys))


def _set_retained(own: Own, shared: list[np.ndarray], told: pa.Table, length: int, parts: int) -> None:
    """Mark the contexts of a length to use, those of this block alone and those of others too."""
    contexts, too, names = own.levels[length - 1], shared[length - 1], own.names[length - 1]
    alone = told.filter(pc.and_(pc.equal(told["length"], length), pc.less(told["part"], 0)))
    contexts.retained = _counts(alone["told"][0].as_buffer()) > 0
    contexts.retained[too] = _told(told, length, True, names[too], parts) > 0


def retained_contexts(
    blocks: DataFrame, told: DataFrame, length: int, n: int, v: int, depth: int, least_gain: float, parts: int
) -> DataFrame:
    """Which contexts of a length are to be used; `told` knows about those that are longer.

    A context that ends one to be used has the gain infinity.
    """

    def run(block_row: pa.Table, told: pa.Table) -> pa.Table:
        number, block = next(_unpacked(block_row.combine_chunks()))
        own = own_strings(block, length)
        shared = _set_counts(own, told, parts)
        gain, too, contexts = _gains_of(own, length, n, v), shared[length - 1], own.levels[length - 1]
        if length < depth:
            _set_retained(own, shared, told, length + 1, parts)
            longer = own.levels[length]
            gain[longer.suffix[longer.retained]] = np.inf
        alone = (gain >= least_gain) & (contexts.counts > 0) & ~too
        mine = _asked_rows(number, length, np.array([-1 - number]), [b""], [_packed(alone)])
        return pa.concat_tables([mine, _asking(number, length, own.names[length - 1][too], gain[too], parts, True)])

    def sums(number: np.ndarray, gains: np.ndarray) -> np.ndarray:
        return (np.bincount(number, gains) >= least_gain).astype(np.int64)

    known = told.filter((F.col("length") <= length + 1) & (~F.col("mark") | (F.col("length") == length + 1)))
    asked = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, ASKED)
    return _answered(asked, True, sums)


def _whole_scores(blocks: DataFrame, n: int, v: int, depth: int, least_gain: float, fields: str) -> DataFrame:
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size)
    parts = 1 + (blocks.agg(F.sum(sizes)).first()[0] or 0) // PART_TOKENS
    lengths = [tuple(k for k in some if k <= depth + 1) for some in COUNTED_TOGETHER]
    lengths += [(k,) for k in range(1 + max(map(max, COUNTED_TOGETHER)), depth + 2)]
    told = None
    for some in filter(None, lengths):
        counts = stored(string_counts(blocks, some, parts), "string-counts")
        told = counts if told is None else told.union(counts)
    for length in range(depth, 0, -1):
        told = told.union(
            stored(retained_contexts(blocks, told, length, n, v, depth, least_gain, parts), "retained")
        )
    base_total = n + 0.5 * (v + 1)

    def run(block_row: pa.Table, told: pa.Table) -> pa.Table:
        _, block = next(_unpacked(block_row.combine_chunks()))
        own = own_strings(block, depth)
        shared = _set_counts(own, told, parts)
        for length in range(1, depth + 1):
            _set_retained(own, shared, told, length, parts)
        return _scored(block, own.levels[0].counts, own.levels, own.numbers, n, base_total)

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, fields)


# --- Scoring ---------------------------------------------------------------------------


def _scored(
    block: Block, count: np.ndarray, levels: list[Strings], numbers: np.ndarray | list[np.ndarray],
    n: int, base_total: float,
) -> pa.Table:
    """A row per document, from the counts of the block's words and their numbers in the tree, or
    the numbers of the strings that end at each token."""
    base_of, parts, done = (count + 0.5) / base_total, [], 0
    for place, sizes in block.slices():
        base, starts = base_of[place], np.cumsum(sizes) - sizes
        if isinstance(numbers, list):
            here = [k[done : done + len(place)] for k in numbers]
            better, done = _smoothed(levels, here, firsts(sizes), base), done + len(place)
        else:
            better = probabilities(levels, numbers[place], sizes, base)
        parts.append((
            np.add.reduceat((count[place] > 0).astype(np.int64), starts),
            np.add.reduceat(np.log10(base), starts), np.add.reduceat(np.log10(better), starts),
        ))
    known, base_score, score = (np.concatenate(p) for p in zip(*parts))
    return pa.table(
        {
            "id": block.ids, "held_out": block.held_out, "n_tokens": block.sizes, "n_known": known,
            "train_tokens": np.full(len(known), n), "base_score": base_score, "score": score,
        }
    )


def _asked(blocks: DataFrame) -> DataFrame:
    """word, block, place: the distinct words of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _unpacked(batch):
                n = len(block.words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.words), pa.array(np.full(n, number)), pa.array(np.arange(n, dtype=np.int32))],
                    names=["word", "block", "place"],
                )

    return blocks.mapInArrow(run, "word long, block long, place int")


SCORES = (
    "id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def scores(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH, p_min: float = P_MIN, least_gain: float = LEAST_GAIN,
) -> DataFrame:
    """Train on the rows where `held_out` is false, and score every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col(id_col).alias("id"), held_out.alias("held_out"), text_or_empty(text_col).alias("text")
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = stored(_blocks(rows, id_type), "token-blocks")
    counts = stored(word_counts(blocks), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    fields = SCORES.replace("id string", f"id {id_type}")
    if p_min * n <= 1:
        return _whole_scores(blocks, n, v, depth, least_gain, fields)
    levels = spark.sparkContext.broadcast(grow(blocks, counts, n, v, depth, p_min, least_gain))
    answers = _asked(blocks).join(counts, "word").select("block", "place", "n")
    base_total = n + 0.5 * (v + 1)

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        _, block = next(_unpacked(own.combine_chunks()))
        count = np.zeros(len(block.words), np.int64)
        count[found["place"].to_numpy()] = found["n"].to_numpy()
        return _scored(block, count, levels.value, lookup(levels.value[0].keys, block.words), n, base_total)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, fields)


def op4_suffix_tree(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scores(docs, fold(F.col("doc_id")) == HELD_OUT).withColumnRenamed("id", "doc_id")
