"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

The index holds the documents in blocks of about `BLOCK_BYTES` of text, one row each: sorted names
of the terms, and their lists of (document of the block, occurrences). It is written in the task
that reads the texts; nothing is shuffled. Queries are taken in passes of about `PASS_TERMS` terms,
whose names and weights are the only thing sent to the tasks. In a block, for each query:

1. short lists are summed term by term into accumulators (term at a time);
2. the accumulators then act as one more list, with the largest sum of every range of documents as
   its bound, beside the long lists with theirs;
3. ranges are visited in order (document at a time). A range is skipped if its bounds together do
   not reach the score of the query's last place so far. Inside the others, candidates seek
   through the long lists, largest bound first, and leave as soon as what they have plus what is
   left does not reach that score.

A task keeps the best documents of each query over all of its blocks. The first block of every
writing task is searched ahead of the rest, and the scores of the last places found there are
where the others start, so tasks return few documents. Bounds are exact integers: no document that belongs into a
result is skipped, and ties with the last place are kept and settled by id at the end.

Terms go by 64-bit names; a clash with a term of a query is possible in principle.

Defined results: a null text has no terms; an item without any term, or with terms that no document has,
has no rows. Every row is a document or an item of its own, also where ids repeat; of equal
scores the smaller id goes first, null last. An empty table on either side gives no rows. Columns
are resolved by name for id and text only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline.llm.common import (
    LOWER, SLICE_BYTES, bounded_batches, gather, stored, table, text_bytes, text_slices, word_names, word_places,
)
from fareline.session import scratch_path

BLOCK_BYTES = 8 << 20
PASS_TERMS = 20_000
RANGE = 256  # documents, at least; a block has at most MOST_RANGES of them
MOST_RANGES = 64
STRIDE = 16  # ranges between two looks at the last place's score
LONG_SHARE = 16  # a list is long if more than one in so many documents is in it
LAST = np.iinfo(np.int64).max

# Bytes between terms. ASCII letters and digits and all of UTF-8 beyond are terms.
GAPS = np.zeros(256, bool)
GAPS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


# --- Terms --------------------------------------------------------------------------------


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of all terms, A-Z lower-cased, and the text that each is in; very long texts in parts."""
    data, edges = text_bytes(texts)
    names, owners, begin = [], [], 0
    while begin < len(data):
        end = min(begin + 2 * SLICE_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(GAPS[data[begin:end]])
            # A part ends between terms; a term longer than that is taken whole with what follows.
            end = begin + int(gaps[-1]) + 1 if len(gaps) else len(data)
        part = LOWER[data[begin:end]]
        first, last = np.searchsorted(edges, [begin, end], "left")
        starts, ends = word_places(part, edges[first:last] - begin, GAPS)
        names.append(word_names(part, starts, ends))
        owners.append(np.searchsorted(edges, starts + begin, "right") - 1)
        begin = end
    if not names:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(owners)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """nth, item_id, terms (names of the distinct terms) of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owners = terms_of(batch.column(2))
            edges = np.searchsorted(owners, np.arange(batch.num_rows + 1))
            found = [np.unique(names[a:b]).view(np.int64) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], names=["nth", "item_id", "terms"]
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("nth"), F.col(id_col).cast("long").alias("item_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    return stored(rows.mapInArrow(run, "nth long, item_id long, terms array<long>"), "items")


# --- Index --------------------------------------------------------------------------------

INDEX = (
    "lead boolean, n_docs long, n_with_terms long, n_terms long, ids array<long>, sizes binary, "
    "terms binary, counts binary, docs binary, occurrences binary"
)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0)).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // count}").astype(np.int64) if count else np.empty(0, np.int64)


def _block(ids: pa.Array, texts: pa.Array, lead: bool) -> pa.RecordBatch:
    names, owners = terms_of(texts)
    sizes = np.bincount(owners, minlength=len(texts))
    order = np.argsort(names, kind="stable")  # texts stay in order inside a term
    names, owners = names[order], owners[order]
    term_starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.empty(0, np.int64)
    changes = np.concatenate([[True], (names[1:] != names[:-1]) | (owners[1:] != owners[:-1])]) if len(names) else np.empty(0, bool)
    places = np.flatnonzero(changes)
    occurrences = np.diff(np.append(places, len(names)))
    counts = np.diff(np.append(np.searchsorted(places, term_starts), len(places)))
    row = [
        lead, len(texts), int((sizes > 0).sum()), int(sizes.sum()), ids.to_pylist(), _packed(sizes),
        names[term_starts].tobytes(), _packed(counts), _packed(owners[places]), _packed(occurrences),
    ]
    types = [pa.bool_(), *[pa.int64()] * 3, pa.list_(pa.int64()), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(row, types)], names=[c.split()[0] for c in INDEX.split(", ")]
    )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index, a row per block, written in two parts: the first blocks of tasks (`lead`), and the rest."""
    spark = docs.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = True
        for batch in batches:
            for begin, end in text_slices(batch.column(1), BLOCK_BYTES):
                yield _block(batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), lead)
                lead = False

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    path = scratch_path(spark, "lexical-index")
    blocks = rows.mapInArrow(run, INDEX)
    blocks.write.partitionBy("lead").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def frequencies(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """In how many documents each of the wanted terms (sorted names) is."""
    sent = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sent.value
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                here, at, found = _present(np.frombuffer(terms.as_buffer(), np.uint64), names)
                total[found] += _unpacked(counts.as_py(), len(here))[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["nth", "n"])

    found = (
        index.select("terms", "counts").mapInArrow(run, "nth long, n long").groupBy("nth").agg(F.sum("n").alias("n"))
    ).toArrow()  # at most a row per wanted term
    out = np.zeros(len(wanted), np.int64)
    out[found["nth"].to_numpy()] = found["n"].to_numpy()
    return out


def _present(here: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a block, the places in them of wanted terms that are there, and which these are."""
    at = np.searchsorted(here, wanted)
    hit = np.flatnonzero(at < len(here))
    hit = hit[here[at[hit]] == wanted[hit]]
    return here, at[hit], hit


# --- Scores -------------------------------------------------------------------------------


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factors(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length makes of it; in Python's integers where 64 bits could overflow."""
    if len(sizes) and 50 * n_docs * int(sizes.max()) > LAST:
        sizes = sizes.astype(object)
    return (50 + (50 * n_docs * sizes) // n_terms).astype(np.int64)


class Lists:
    """The lists of a block for the wanted terms: documents, impacts, and the largest impact of every range."""

    def __init__(self, row: dict, wanted: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        here, at, self.found = _present(np.frombuffer(row["terms"], np.uint64), wanted)
        counts = _unpacked(row["counts"], len(here))
        total = int(counts.sum())
        starts = (np.cumsum(counts) - counts)[at]
        self.sizes = counts[at]
        docs, times = (np.frombuffer(row[c], f"u{len(row[c]) // total}") if total else np.empty(0, np.uint8) for c in ("docs", "occurrences"))
        self.docs = gather(docs, starts, self.sizes).astype(np.int64)
        tf = gather(times, starts, self.sizes).astype(np.int64)
        factors = length_factors(_unpacked(row["sizes"], row["n_docs"]), n_docs, n_terms)
        self.impacts = np.repeat(weights[self.found], self.sizes) * (10**9 * tf // (1000 * tf + 20 * factors[self.docs]))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.n_docs = row["n_docs"]
        self.range = max(RANGE, -(-self.n_docs // MOST_RANGES))
        self.n_ranges = -(-self.n_docs // self.range)
        self.bounds = np.zeros((len(at), self.n_ranges), np.int64)
        if len(self.docs):
            cell = np.repeat(np.arange(len(at)), self.sizes) * self.n_ranges + self.docs // self.range
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            self.bounds.reshape(-1)[cell[first]] = np.maximum.reduceat(self.impacts, first)

    def of(self, term: int) -> slice:
        return slice(self.starts[term], self.ends[term])

    def search(self, terms: np.ndarray, best: "Best") -> None:
        """Offer `best` every document that can be among the best for the terms (places in `found`)."""
        is_long = self.sizes[terms] * LONG_SHARE > self.n_docs
        short, long = terms[~is_long], terms[is_long]
        sums = np.zeros(self.n_docs, np.int64)
        np.add.at(sums, gather(self.docs, self.starts[short], self.sizes[short]), gather(self.impacts, self.starts[short], self.sizes[short]))
        edges = np.arange(0, self.n_docs, self.range)
        long = long[np.argsort(-self.bounds[long].max(axis=1, initial=0), kind="stable")]
        ahead = self.bounds[long].sum(axis=0)  # what the long lists may still add, by range
        whole = np.maximum.reduceat(sums, edges) + ahead
        for begin in range(0, self.n_ranges, STRIDE):
            least = best.least()
            alive = begin + np.flatnonzero(whole[begin : begin + STRIDE] >= least)
            if not len(alive):
                continue
            docs = (alive[:, None] * self.range + np.arange(self.range)).reshape(-1)
            docs = docs[docs < self.n_docs]
            scores, left = sums[docs], ahead.copy()
            for term in long:
                keep = scores + left[docs // self.range] >= least
                docs, scores = docs[keep], scores[keep]
                if not len(docs):
                    break
                listed = self.docs[self.of(term)]
                at = np.searchsorted(listed, docs)
                at[at == len(listed)] = 0
                scores += np.where(listed[at] == docs, self.impacts[self.of(term)][at], 0)
                left -= self.bounds[term]
            keep = scores >= least
            best.offer(docs[keep], scores[keep])


class Best:
    """The best documents of one query so far: score, then id, null last."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(floor, 1)  # a score has to be above 0
        self.scores, self.ids, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.block: tuple[np.ndarray, np.ndarray] | None = None

    def least(self) -> int:
        """A score under it cannot be among the best any more."""
        return max(self.floor, int(self.scores[-1])) if len(self.scores) == self.k else self.floor

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        if not len(docs):
            return
        ids, null = self.block
        scores = np.concatenate([self.scores, scores])
        ids, null = np.concatenate([self.ids, ids[docs]]), np.concatenate([self.null, null[docs]])
        top = np.lexsort([ids, null, -scores])[: self.k]
        self.scores, self.ids, self.null = scores[top], ids[top], null[top]


def _searched(blocks: DataFrame, sent, k: int) -> DataFrame:
    """nth, id, score: the best of every task for every query of the pass."""
    columns = [c.split()[0] for c in INDEX.split(", ")[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights, queries, floors, n_docs, n_terms = sent.value
        best = [Best(k, floor) for floor in floors]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(j)[at].as_py() for j, c in enumerate(columns) if c != "ids"}
                held = batch.column(columns.index("ids"))[at].values
                ids = held.fill_null(LAST).to_numpy(), held.is_null().to_numpy(zero_copy_only=False)
                lists = Lists(row, wanted, weights, n_docs, n_terms)
                place = np.full(len(wanted), -1, np.int64)
                place[lists.found] = np.arange(len(lists.found))
                for (_, terms), one in zip(queries, best):
                    here = place[terms]
                    here = here[here >= 0]
                    if len(here):
                        one.block = ids
                        lists.search(here, one)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([nth for nth, _ in queries], [len(one.ids) for one in best])),
                pa.array(np.concatenate([one.ids for one in best]), mask=np.concatenate([one.null for one in best])),
                pa.array(np.concatenate([one.scores for one in best])),
            ],
            names=["nth", "id", "score"],
        )

    return blocks.select(*columns).mapInArrow(run, "nth long, id long, score long")


def search(index: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, id, score: the `k` best documents of each item of `item_terms`."""
    spark = index.sparkSession
    totals = index.agg(F.sum("n_with_terms").alias("n"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = totals["n"] or 0, totals["terms"] or 0
    needed = items.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    passes = -(-needed // PASS_TERMS) if n_terms else 0
    parts = []
    for nth in range(passes):
        some = items.filter(F.pmod(F.xxhash64("nth"), F.lit(passes)) == nth).select("nth", "terms").toArrow()
        queries = [
            (q, t.values.to_numpy().view(np.uint64)) for q, t in zip(some["nth"].to_pylist(), some["terms"]) if len(t)
        ]
        if not queries:
            continue
        wanted = np.unique(np.concatenate([t for _, t in queries]))
        df = frequencies(index, wanted)
        weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
        queries = [(q, np.searchsorted(wanted, t)) for q, t in queries]

        def best(blocks: DataFrame, floors: list[int]) -> DataFrame:
            sent = spark.sparkContext.broadcast((wanted, weights, queries, floors, n_docs, n_terms))
            return _searched(blocks, sent, k)

        ahead = stored(_ranked(best(index.filter("lead"), [0] * len(queries)), k), "search-ahead")
        last = {r["nth"]: r["score"] for r in ahead.filter(F.col("rank") == k).collect()}  # a row per query
        rest = best(index.filter("not lead"), [last.get(q, 0) for q, _ in queries])
        parts.append(stored(_ranked(ahead.drop("rank").unionByName(rest), k), "search"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.join(items.select("nth", "item_id"), "nth").select("item_id", "rank", "id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Win.partitionBy("nth").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    found = search(index, item_terms(table(spark, sf_dir, "benchmark")))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = r"""
WITH terms AS (
  SELECT row_number() OVER () AS d, doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), postings AS (
  SELECT d, doc_id, term, count(*) AS tf FROM terms GROUP BY d, doc_id, term
), sizes AS (
  SELECT d, sum(tf)::BIGINT AS n FROM postings GROUP BY d
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), factors AS (
  SELECT d, 50 + (50 * n * n_docs) // n_terms AS m FROM sizes, totals
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
), scores AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN factors USING (d)
  GROUP BY i, item_id, d, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
