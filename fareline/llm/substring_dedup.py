"""Repeated passages found by recompression.

Every round renames the symbols of all documents at once, beginning with words: maximal runs of
one symbol become a symbol, then every pair whose left symbol is of the left half and whose
right symbol is of the right half of the alphabet; the halves change with the round. A name is
a 64-bit mix of what it stands for, so it is global: equal runs and pairs get equal names in
every task and every Spark stage without a dictionary. Whether two symbols merge depends on
them and their neighbours alone, so a repeated passage is parsed alike wherever it stands, but
for its edges. With each symbol goes the range of words that decided it; a window of `window`
words that holds this range holds the symbol, and so does every equal window.

1. Each window takes the longest symbol it decides (its anchor; the window itself where no
   symbol is decided). Neighbouring windows with the same occurrence of an anchor are one row.
   Anchors are counted, and rows whose anchor occurs once are done: their windows occur once.
2. The words of a row, up to the end of its last window, have a name. All windows of rows that
   share anchor and name are repeated. Where the rows of an anchor differ, the windows of one
   row of each kind are named by 128 bits and counted, and those of single rows that occur
   elsewhere are repeated too.
3. Words under repeated windows are removed.

Rows are keyed by hashes of id and text, so copies of a row share one key and rows are never
numbered. Counts are combined on the map side, joins are on written tables with plain exchanges
on both sides, so a passage in any number of documents can be split.

Defined results: words are taken unchanged; a null or empty text has none. Windows are judged
on the input, not on what is left, and the same document counts as another place. Rows equal
in id and text both count: all their windows occur twice. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import (
    bounded_batches, cut, gather, mixed, named_words, packed, sliced, small_side, stored, strings,
    table, text_or_empty, text_slices, unpacked,
)

WINDOW = 35
ROUNDS = 6
_WORDS = re.compile(r"[^\t-\r ]+")
_SPACE = re.compile(r"[\t-\r ]")
_FAR = 1 << 40  # a context that reaches over the edge of a document


class Parse:
    """Symbols of some documents, one after another, and what decided them.

    `begin` and `end` are the words a symbol covers, `low` and `high` the words that decide it.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        at = np.arange(len(words))
        self.words, self.name, self.begin, self.end = words, words, at, at + 1
        self.low, self.high = at, at + 1
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.concatenate([[True], self.doc[1:] != self.doc[:-1]])[: len(words)]
        self.last = np.concatenate([self.doc[1:] != self.doc[:-1], [True]])[-len(words) :] if len(words) else self.first

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a symbol has one before and after it in its document."""
        joint = self.doc[1:] == self.doc[:-1]
        return np.concatenate([[False], joint]), np.concatenate([joint, [False]])

    def _take(self, starts: np.ndarray, low: np.ndarray, high: np.ndarray, name: np.ndarray) -> None:
        """Merge the symbols from each start up to the next."""
        ends = np.append(starts[1:], len(self.name)) - 1
        self.begin, self.end, self.doc = self.begin[starts], self.end[ends], self.doc[starts]
        self.low, self.high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
        self.name = name

    def runs(self) -> np.ndarray:
        """Merge maximal runs; returns which symbols are new."""
        before, after = self._neighbours()
        same = self.name[1:] == self.name[:-1]
        joined = np.concatenate([[False], same & before[1:]])
        starts = np.flatnonzero(~joined)
        lengths = np.diff(np.append(starts, len(self.name)))
        # The neighbour differs if the word next to the symbol differs from the one a repetition
        # would have there; only else the whole neighbour decides.
        low, high = self.low.copy(), self.high.copy()
        own_first, own_last = self.words[self.begin], self.words[self.end - 1]
        if len(low) > 1:
            plain = self.words[self.begin[1:] - 1] != own_last[1:]
            low[1:] = np.where(
                ~before[1:], -_FAR,
                np.where(joined[1:], low[1:], np.minimum(low[1:], np.where(plain, self.begin[1:] - 1, self.low[:-1]))),
            )
            plain = self.words[np.minimum(self.end[:-1], len(self.words) - 1)] != own_first[:-1]
            high[:-1] = np.where(
                ~after[:-1], _FAR,
                np.where(joined[1:], high[:-1], np.maximum(high[:-1], np.where(plain, self.end[:-1] + 1, self.high[1:]))),
            )
        low[:1], high[-1:] = -_FAR, _FAR
        name = self.name[starts]
        new = lengths > 1
        name = np.where(new, mixed(name, lengths.astype(np.uint64) + np.uint64(1 << 40)), name)
        self._take(starts, low, high, name)
        return new

    def pairs(self, round_: int) -> np.ndarray:
        """Merge left-half symbols with the right-half symbol after them; returns which are new."""
        before, after = self._neighbours()
        side = mixed(self.name, np.full(1, round_, np.uint64)) & np.uint64(1)
        left = side == 0
        second = np.concatenate([[False], left[:-1] & ~left[1:] & before[1:]])
        starts = np.flatnonzero(~second)
        lengths = np.diff(np.append(starts, len(self.name)))
        # A left symbol that stays alone was decided by the one after it, a right one by the
        # one before it.
        merged = second.copy()
        merged[:-1] |= second[1:]
        low, high = self.low.copy(), self.high.copy()
        if len(low) > 1:
            alone = ~merged
            low[1:] = np.where(alone[1:] & ~left[1:], np.where(before[1:], np.minimum(low[1:], self.low[:-1]), -_FAR), low[1:])
            high[:-1] = np.where(alone[:-1] & left[:-1], np.where(after[:-1], np.maximum(high[:-1], self.high[1:]), _FAR), high[:-1])
        low[:1] = np.where(merged[:1] | left[:1], low[:1], -_FAR)
        high[-1:] = np.where(merged[-1:] | ~left[-1:], high[-1:], _FAR)
        new = lengths > 1
        name = self.name[starts]
        name[new] = mixed(self.name[starts[new]], self.name[starts[new] + 1])
        self._take(starts, low, high, name)
        return new


def anchors(
    words: np.ndarray, sizes: np.ndarray, window: int, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window that begins at each word (0 where none does, or has no symbol), and
    whether that is the first window to hold one more occurrence of it.

    Equal windows hold equally many occurrences, so such a first window lies between any two.
    """
    n = len(words)
    opens = []
    top = int(window).bit_length()
    best = [np.zeros(n, np.uint64) for _ in range(top)]
    if n:
        parse = Parse(words, sizes)
        last = np.repeat(np.cumsum(sizes) - window, sizes)  # the last window of each word's document
        for round_ in range(rounds):
            for step in ("runs", "pairs"):
                new = parse.runs() if step == "runs" else parse.pairs(round_)
                new &= parse.high - parse.low <= window
                if not new.any():
                    continue
                low, high = parse.low[new], parse.high[new]
                span = (parse.end - parse.begin)[new].astype(np.uint64)
                weight = span << np.uint64(57) | parse.name[new] >> np.uint64(7)
                begin = high - window
                end = np.minimum(low, last[low])
                begin = np.maximum(begin, (np.cumsum(sizes) - sizes)[parse.doc[new]])
                ok = begin <= end
                begin, end, weight = begin[ok], end[ok], weight[ok]
                opens.append((begin, weight))
                # The range of windows as two overlapping blocks of a power of two.
                size = np.frexp((end - begin + 1).astype(np.float64))[1] - 1
                for k in range(top):
                    own = size == k
                    np.maximum.at(best[k], begin[own], weight[own])
                    np.maximum.at(best[k], end[own] - (1 << k) + 1, weight[own])
            if not np.any(parse.high - parse.low <= window):
                break
        for k in range(top - 1, 0, -1):
            half = 1 << (k - 1)
            np.maximum(best[k - 1], best[k], out=best[k - 1])
            np.maximum(best[k - 1][half:], best[k][:-half], out=best[k - 1][half:])
    first = np.zeros(n, bool)
    for begin, weight in opens:
        first[begin[best[0][begin] == weight]] = True
    return best[0], first


def window_names(words: np.ndarray, window: int, seed: int) -> np.ndarray:
    """A 64-bit name of the window that begins at each word (meaningless where none fits)."""
    part, width = mixed(words, np.full(1, seed, np.uint64)), 1
    out, covered, left = None, 0, window
    while left:
        if left & 1:
            shifted = np.concatenate([part[covered:], np.zeros(covered, np.uint64)])[: len(words)]
            out = shifted if out is None else mixed(out, shifted)
            covered += width
        left >>= 1
        if left:
            part = mixed(part, np.concatenate([part[width:], np.zeros(min(width, len(part)), np.uint64)])[: len(words)])
            width *= 2
    return out


def _fits(sizes: np.ndarray, window: int) -> np.ndarray:
    """Whether a window begins at each word."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    return np.arange(len(ends)) + window <= ends


def _anchored(rows: DataFrame, window: int) -> DataFrame:
    """anchor, body, k1, k2, begin, windows: rows of neighbouring windows with one anchor.

    `body` names the words of the row: its first and last window together hold them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            texts = batch.column(2)
            for begin, end in text_slices(texts):
                words, sizes = named_words(texts.slice(begin, end - begin))
                place = np.flatnonzero(_fits(sizes, window))
                if not len(place):
                    continue
                anchor, first = (a[place] for a in anchors(words, sizes, window))
                names = window_names(words, window, 1)[place]
                bare = anchor == 0
                anchor[bare] = names[bare] | np.uint64(1 << 63)
                doc = np.repeat(np.arange(len(sizes)), sizes)[place]
                other = np.concatenate([[True], (np.diff(doc) != 0) | (anchor[1:] != anchor[:-1])])
                new = np.flatnonzero(other | first | bare)
                last = np.append(new[1:], len(place)) - 1
                at = begin + doc[new]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[new].view(np.int64)), pa.array(mixed(names[new], names[last]).view(np.int64)),
                        pa.array(k1[at]), pa.array(k2[at]),
                        pa.array((place[new] - (np.cumsum(sizes) - sizes)[doc[new]]).astype(np.int32)),
                        pa.array((last - new + 1).astype(np.int32)),
                    ],
                    names=["anchor", "body", "k1", "k2", "begin", "windows"],
                )

    return rows.mapInArrow(run, "anchor long, body long, k1 long, k2 long, begin int, windows int")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """h1, h2, doc, at, single: names of the windows in `ranges` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, texts, ranges = batch.column(0).to_numpy(), unpacked(batch.column(1)), batch.column(2)
            for begin, end in text_slices(texts):
                words, sizes = named_words(texts.slice(begin, end - begin))
                own = ranges.slice(begin, end - begin)
                counts = np.diff(own.offsets.to_numpy())
                flat = own.flatten()
                first, many = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                single = flat.field(2).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(end - begin), counts)
                start = (np.cumsum(sizes) - sizes)[doc]
                place = gather(np.arange(len(words)), first + start, many)
                doc = np.repeat(doc, many)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(window_names(words, window, seed)[place].view(np.int64)) for seed in (1, 2)),
                        pa.array(number[begin + doc]),
                        pa.array((place - (np.cumsum(sizes) - sizes)[doc]).astype(np.int32)),
                        pa.array(np.repeat(single, many)),
                    ],
                    names=["h1", "h2", "doc", "at", "single"],
                )

    return rows.mapInArrow(run, "h1 long, h2 long, doc long, at int, single boolean")


def _cleaned(rows: DataFrame, window: int, id_type: str) -> DataFrame:
    """id, n_words, removed (ranges of words), kept text; column 2 lists ranges of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = strings(unpacked(batch.column(1))), batch.column(2)
            for begin, end in sliced(texts):
                n_words, spans, kept = [], [], []
                for k in range(begin, end):
                    words = [w for part in cut(texts[k], _SPACE) for w in _WORDS.findall(part)]
                    found = []
                    if places[k].is_valid:
                        ranges = places[k].values
                        first, many = (ranges.field(f).to_numpy().astype(np.int64) for f in (0, 1))
                        order = np.argsort(first, kind="stable")
                        first, after = first[order], np.maximum.accumulate((first + many - 1 + window)[order])
                        breaks = np.flatnonzero(first[1:] > after[:-1])
                        found = list(zip(
                            first[np.concatenate([[0], breaks + 1])].tolist(),
                            after[np.append(breaks, len(after) - 1)].tolist(),
                        ))
                    n_words.append(len(words))
                    spans.append([{"begin": a, "end": b} for a, b in found])
                    for a, b in reversed(found):
                        del words[a:b]
                    kept.append(" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin), pa.array(n_words, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                        pa.array(kept, pa.string()),
                    ],
                    names=["id", "n_words", "removed", "kept_text"],
                )

    fields = f"id {id_type}, n_words long, removed array<struct<begin:int,end:int>>, kept_text string"
    return rows.mapInArrow(run, fields)


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: id, n_words, removed (ranges [begin, end) of words), kept_text."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
        F.xxhash64(F.col("id").cast("string")).alias("k1"), F.xxhash64("text").alias("k2"), "id", "text"
    )
    keyed = rows.select("k1", "k2", "text")
    found = _anchored(keyed, window)
    shared = stored(found.groupBy("anchor").count().filter("count > 1").select("anchor"), "shared-anchors")
    # Stored, so the numbers of the rows stay.
    parts = stored(
        found.join(shared, "anchor", "left_semi").withColumn("part", F.monotonically_increasing_id()), "candidates"
    )
    kind = ["anchor", "body", "windows"]
    kinds = stored(parts.groupBy(*kind).agg(F.count("*").alias("n"), F.min("part").alias("part")), "kinds")
    repeated = parts.join(stored(kinds.filter("n > 1").select(*kind), "repeated"), kind, "left_semi")

    # Anchors whose rows differ: one row of each kind is looked at window by window.
    differ = stored(kinds.groupBy("anchor").count().filter("count > 1").select("anchor"), "differing")
    chosen = kinds.join(differ, "anchor", "left_semi").select("part", (F.col("n") == 1).alias("single"))
    ranges = stored(
        parts.join(chosen, "part").groupBy("k1", "k2").agg(
            F.collect_set(F.struct("begin", "windows", "single")).alias("ranges")
        ).withColumn("doc", F.monotonically_increasing_id()),
        "to-verify",
    )
    needed = packed(keyed.join(small_side(ranges.select("k1", "k2")), ["k1", "k2"], "left_semi"))
    texts = needed.join(ranges.hint("shuffle_hash"), ["k1", "k2"]).select("doc", "packed", "ranges")
    windows = stored(_windows(texts, window), "windows")
    twice = stored(windows.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "twice")
    single = windows.filter("single").join(twice, ["h1", "h2"], "left_semi").join(ranges.select("doc", "k1", "k2"), "doc")

    places = stored(
        repeated.select("k1", "k2", "begin", "windows")
        .unionByName(single.select("k1", "k2", F.col("at").alias("begin"), F.lit(1).alias("windows")))
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "windows")).alias("places")),
        "places",
    )
    joined = packed(rows).join(places.hint("shuffle_hash"), ["k1", "k2"], "left").select("id", "packed", "places")
    return _cleaned(joined, window, docs.schema[id_col].dataType.simpleString())


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["begin"]
    )
    return without_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )
