"""Quality classifier from weak labels: heuristic labellers, EM over their votes, a hashed scorer.

1. Labellers look at a whole text and vote good (1), poor (-1) or nothing (0); they overlap.
2. All documents are counted by vote pattern, at most 3 ** labellers of them, and expectation-
   maximisation over these counts estimates the share of good documents and, per labeller, how
   often its votes are right on good and on poor ones (labellers taken as independent given the
   class; an abstention says nothing). It begins with documents as poor where any vote is poor.
3. A linear scorer over hashed features (words, word shapes, whether a word repeats one just
   before it) is fitted to the posteriors by logistic loss. It is fitted on a bounded sample:
   at most `SAMPLE` distinct documents, those with the smallest hash of id and text; rows equal
   in both count as one document with their number as its weight.
4. Every document is scored; those under `CUT` are rejected. A document's score is linear in
   the shares of its features, so long and short texts compare.

Nothing but the pattern counts and the sample's features reaches the driver. Labels from
outside are not used; the tests measure accuracy on them.

Defined results: null texts are empty; a text without words has no votes and no features, is
scored by the bias alone and kept unless that rejects it. Rows equal in id and text get the
same score. Without any document with votes all weights are 0 and everything is kept. Extra
columns are carried in a struct and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import (
    LOWER, bounded_batches, mixed, named_words, strings, table, text_bytes,
    text_or_empty, text_slices, tidy, word_names, word_places,
)

BITS = 16
SAMPLE = 8_000
CUT = 0.5
ROUNDS = 200
SLICE = 1 << 20  # bytes of texts looked at together
LABELLERS = ("shouting", "symbols", "tables", "repetition", "echo", "lines", "common_words", "sentences")

# Frequent words of the four languages.
COMMON_WORDS = frozenset(
    """a an and are as at be by for from has he in is it its not of on or that the this to was with
    aus das dem den der des die ein eine für ist mit nicht sich und von zu auf im
    avec dans de des du en est et il la le les ne par pas pour que qui se sur un une
    con del el en es la las lo los no para por que se su un una y""".split()
)
UPPER, SYMBOLS, BARE, COMMON, STOP = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)  # 0 other ASCII, 1 A-Z, 2 a-z, 3 digits, 4 bytes of other characters
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 4
_ENDS = np.zeros(256, bool)
_ENDS[[0x21, 0x2E, 0x3F]] = True
_COMMON_NAMES = np.unique(named_words([w + end for w in sorted(COMMON_WORDS) for end in ("", ".", ",", ";", ":")])[0])


class Slice:
    """Words, shapes and repetitions of some texts, and shares of them per text."""

    def __init__(self, texts: pa.Array):
        data, edges = text_bytes(texts)
        starts, ends = word_places(data, edges[:-1])
        self.names = word_names(LOWER[data], starts, ends)  # A-Z folded
        self.doc = np.searchsorted(edges, starts, "right") - 1
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self._look(data, starts, ends)
        # The distance, up to 4, to the nearest equal word before; 0 where there is none.
        self.back = np.zeros(len(starts), np.int64)
        for d in range(4, 0, -1):
            same = (self.names[d:] == self.names[:-d]) & (self.doc[d:] == self.doc[:-d])
            self.back[d:][same] = d
        lines = [[x for x in t.split("\n") if x.strip()] for t in strings(texts)]
        self.lines = np.array([len(x) for x in lines], np.int64)
        self.again = np.array([len(x) - len(set(x)) for x in lines], np.int64)

    def _look(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Flags and shape (flags, length, classes of the first and the last byte) of each word."""
        kind = _CLASS[data]

        def count(which: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(which, dtype=np.int64)])
            return total[ends] - total[starts]

        upper, lower = count(kind == 1), count(kind == 2)
        solid = upper + lower + count(kind >= 3)
        twice = np.zeros(len(data), bool)
        twice[:-1] = (data[:-1] == data[1:]) & (kind[:-1] == 0) & (data[:-1] > 0x20)
        runs = count(twice)
        common = np.minimum(np.searchsorted(_COMMON_NAMES, self.names), len(_COMMON_NAMES) - 1)
        self.flags = (
            UPPER * ((upper >= 2) & (lower == 0)) + SYMBOLS * ((runs > 0) & (solid > 0)) + BARE * (solid == 0)
            + COMMON * (_COMMON_NAMES[common] == self.names) + STOP * _ENDS[data[ends - 1]]
        )

        def edge(at: np.ndarray) -> np.ndarray:
            return np.where(kind[at] == 0, data[at], kind[at]).astype(np.uint64)

        size = np.minimum(ends - starts, 12).astype(np.uint64)
        self.shapes = (self.flags.astype(np.uint64) << np.uint64(4) | size) << np.uint64(16) | edge(starts) << np.uint64(8) | edge(ends - 1)

    def share(self, which: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc[which], minlength=len(self.sizes)) / np.maximum(self.sizes, 1)

    def votes(self) -> np.ndarray:
        """One row per text, one column per labeller."""
        flagged = {f: self.share(self.flags & f > 0) for f in (UPPER, SYMBOLS, BARE, COMMON, STOP)}
        repeated = self.again / np.maximum(self.lines, 1)
        long = self.sizes >= 20

        def vote(poor: np.ndarray, good: np.ndarray) -> np.ndarray:
            return np.where(poor, -1, np.where(good, 1, 0))

        columns = [
            vote(flagged[UPPER] > 0.4, flagged[UPPER] < 0.1),
            vote(flagged[SYMBOLS] > 0.25, flagged[SYMBOLS] < 0.05),
            vote(flagged[BARE] > 0.2, flagged[BARE] < 0.1),
            vote(self.share(self.back > 0) > 0.4, self.share(self.back > 0) < 0.2),
            vote(self.share(self.back == 1) > 0.25, self.share(self.back == 1) < 0.1),
            vote((self.lines >= 3) & (repeated > 0.4), (self.lines >= 3) & (repeated < 0.1)),
            vote(long & (flagged[COMMON] < 0.03), long & (flagged[COMMON] > 0.1)),
            vote(long & ((flagged[STOP] < 0.002) | (flagged[STOP] > 0.5)), long & (flagged[STOP] > 0.01) & (flagged[STOP] < 0.35)),
        ]
        return np.where(self.sizes > 0, np.stack(columns), 0).T.astype(np.int8)

    def features(self) -> list[np.ndarray]:
        """Hashed feature numbers of every word, by family."""
        mask = np.uint64((1 << BITS) - 1)
        back = self.back.astype(np.uint64)
        families = (self.names, self.shapes, back)
        return [
            (mixed(f, np.full(1, 1000 + k, np.uint64)) & mask).astype(np.int64) for k, f in enumerate(families)
        ]

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        total = sum(weights[f] for f in self.features())
        mean = np.bincount(self.doc, total, len(self.sizes)) / np.maximum(self.sizes, 1)
        return 1 / (1 + np.exp(-np.clip(mean + bias, -30, 30)))


# --- Expectation-maximisation -----------------------------------------------------------


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, P(good vote | class) as [labeller, class], posterior of each pattern).

    `patterns` holds a row of votes (-1, 0, 1) per pattern; class 1 is the good one.
    """
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    praise, prior = np.full((patterns.shape[1], 2), 0.5), 0.5
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])  # [class, pattern]
        prior = float(np.clip(weight[1].sum() / max(counts.sum(), 1), 1e-3, 1 - 1e-3))
        for k in range(patterns.shape[1]):
            up, down = (weight[:, patterns[:, k] == v].sum(axis=1) + 0.5 for v in (1, -1))
            praise[k] = up / (up + down)
        odds = np.log(prior / (1 - prior)) + sum(
            np.where(patterns[:, k] > 0, np.log(praise[k, 1] / praise[k, 0]), 0)
            + np.where(patterns[:, k] < 0, np.log((1 - praise[k, 1]) / (1 - praise[k, 0])), 0)
            for k in range(patterns.shape[1])
        )
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return prior, praise, good


def code(votes: np.ndarray) -> np.ndarray:
    """One number per row of votes."""
    return (votes.astype(np.int64) + 1) @ (3 ** np.arange(votes.shape[1]))


def decode(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)


# --- The hashed scorer ------------------------------------------------------------------


def fit(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, goal: np.ndarray, steps: int = 300,
    times: np.ndarray | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the logistic loss with soft goals.

    The two classes count equally, so that the rarer one is learned; `times` says how often each
    document counts.
    """
    weights, bias = np.zeros(1 << BITS), 0.0
    times = np.ones(len(goal)) if times is None else times
    good, total = (goal * times).sum(), times.sum()
    if not len(goal) or min(good, total - good) < 1e-6 * total:
        return weights, bias
    sample = times * np.where(goal > 0.5, 0.5 / good, 0.5 / (total - good))
    m, v, bm, bv = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
    for step in range(1, steps + 1):
        margin = np.bincount(rows, weights[columns] * values, len(goal)) + bias
        slope = sample * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - goal)
        gradient = np.bincount(columns, slope[rows] * values, len(weights)) + 1e-6 * weights
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        bm, bv = 0.9 * bm + 0.1 * slope.sum(), 0.999 * bv + 0.001 * slope.sum() ** 2
        fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weights -= 0.1 * fix * m / (np.sqrt(v) + 1e-9)
        bias -= 0.1 * fix * bm / (np.sqrt(bv) + 1e-9)
    return weights, bias


def _mapped(rows: DataFrame, text: int, make, schema: str) -> DataFrame:
    """Rows with the arrays that `make` gives for each slice in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            for begin, end in text_slices(texts, SLICE):
                own = batch.slice(begin, end - begin)
                arrays, columns = make(Slice(texts.slice(begin, end - begin))), list(own.columns)
                yield pa.RecordBatch.from_arrays(
                    [*columns[:text], *arrays.values(), *columns[text + 1 :]],
                    names=[*batch.schema.names[:text], *arrays, *batch.schema.names[text + 1 :]],
                )

    return rows.mapInArrow(tidy(run), schema)


def train(rows: DataFrame) -> dict:
    """The model from rows with `tie` (a hash of the row) and `text`."""
    counted = _mapped(
        rows.select("text"), 0, lambda s: {"code": pa.array(code(s.votes()))}, "code long"
    ).groupBy("code").count().orderBy("code").toArrow()  # at most 3 ** labellers rows
    codes, counts = counted["code"].to_numpy(), counted["count"].to_numpy()
    patterns = decode(codes)
    prior, accuracy, good = estimate(patterns, counts)
    voted = (patterns != 0).any(axis=1)
    posterior = dict(zip(codes.tolist(), good.tolist()))

    total = max(int(counts.sum()), 1)
    limit = min(2**63 - 1, 2**63 * SAMPLE // total)

    def gathered(s: Slice) -> dict[str, pa.Array]:
        lists, shares = [], []
        keys = [s.doc << BITS | f for f in s.features()]
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        doc = key >> BITS
        edges = np.searchsorted(doc, np.arange(len(s.sizes) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(edges, (key & ((1 << BITS) - 1)).astype(np.int32))
        shares = pa.ListArray.from_arrays(edges, (n / s.sizes[doc]).astype(np.float32))
        return {"code": pa.array(code(s.votes())), "columns": lists, "shares": shares}

    # One row per distinct document, combined before it is shuffled, however often it is repeated.
    hashed = rows.select(F.col("tie").bitwiseAND(F.lit(2**63 - 1)).alias("tie"), "text")
    sampled = hashed.filter(F.col("tie") <= limit).groupBy("tie").agg(
        F.count("*").alias("times"), F.first("text").alias("text")
    )
    sample = (
        _mapped(sampled, 2, gathered, "tie long, times long, code long, columns array<int>, shares array<float>")
        .toArrow()  # about SAMPLE rows at most
        .sort_by("tie").slice(0, SAMPLE).combine_chunks()
    )
    weights, bias = np.zeros(1 << BITS), 0.0
    if sample.num_rows and voted.any():
        columns, shares = (sample[c].combine_chunks() for c in ("columns", "shares"))
        lengths = np.diff(columns.offsets.to_numpy())
        goal = np.array([posterior[c] for c in sample["code"].to_pylist()])
        weights, bias = fit(
            np.repeat(np.arange(len(goal)), lengths), columns.flatten().to_numpy().astype(np.int64),
            shares.flatten().to_numpy().astype(np.float64), goal,
            times=sample["times"].to_numpy().astype(np.float64),
        )
    return {"prior": prior, "accuracy": accuracy, "posterior": posterior, "weights": weights, "bias": bias, "sampled": sample.num_rows}


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, votes (by labeller), posterior, score, kept."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        *([F.struct("*").alias("row")] if carry else []),
        F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
    )
    model = docs.sparkSession.sparkContext.broadcast(
        train(rows.select(F.xxhash64("id", "text").alias("tie"), "text"))
    )

    def judged(s: Slice) -> dict[str, pa.Array]:
        votes, found = s.votes(), model.value
        edges = np.arange(len(votes) + 1, dtype=np.int32) * len(LABELLERS)
        score = s.scores(found["weights"], found["bias"])
        return {
            "votes": pa.ListArray.from_arrays(edges, votes.astype(np.int32).ravel()),
            "posterior": pa.array([found["posterior"].get(c, found["prior"]) for c in code(votes).tolist()]),
            "score": pa.array(score),
            "kept": pa.array(score >= CUT),
        }

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "text"}
    from pyspark.sql.types import StructType, _parse_datatype_string

    made = _parse_datatype_string("votes array<int>, posterior double, score double, kept boolean")
    schema = StructType([*(f for f in rows.schema.fields if f.name in kinds), *made.fields])
    return _mapped(rows, len(kinds), judged, schema)


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with the columns of the input."""
    return classify(docs, id_col, text_col, carry=True).filter("kept").select("row.*")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")
