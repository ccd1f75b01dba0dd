"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its `NEAREST` nearest of `PIVOTS` reference points, in order. The
inverted lists hold vectors by pairs of these pivots, so two vectors meet in a list exactly if
they share at least two pivots, and meet once per pair they share. What meets is verified by
its cosine in double precision. A pair counts in the list of its two smallest shared pivots
only, so links are counted, not listed: a list gives, per vector, how many links it has there,
and edges that span the components, never all pairs.

Reference points are drawn from a bounded sample, the `SAMPLE` distinct vectors with the least
hash, and lie at least the threshold's angle apart, up to `PIVOTS` of them; every vector is indexed. Vectors of another dimension than the sample has are compared
through random points of their own dimension. Equal vectors are one node of the index.
Lists longer than `BLOCK` rows are dealt into blocks, and each pair of blocks is a task of its
own, so no list has to fit into one task.

On random directions in 64 dimensions, pairs at a cosine of exactly 0.95 share two of their
eight nearest of 512 pivots in more than 99.9 % of cases; of vectors that fill one, two or three
dimensions of 64 all links are found in the tests.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing and are components of their own. Vectors of different dimensions do not link. A
null id is never the smallest id of a component that has others. Rows with the same vector
link; rows that also share the id are both kept if their component's id is theirs. An empty
table gives no rows. Columns are resolved by name for id and vector only; others may have any
name and are not returned. Vectors may have any length; one block of a list holds `BLOCK` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import bounded_batches, components, stored, table

PIVOTS = 512
NEAREST = 8
SAMPLE = 4096
BLOCK = 2048
THRESHOLD = 0.95
SEED = 17


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first so that squares stay in range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def reference_points(
    sample: np.ndarray, count: int = PIVOTS, seed: int = SEED, threshold: float = THRESHOLD
) -> np.ndarray:
    """Spread-out members of the sample: each is the one farthest from those before.

    Points end where every member is within the threshold's angle of one of them, so points never lie
    closer together than two vectors that link: however few directions the vectors really
    fill, the nearest points of a vector span more than that angle. There are `NEAREST` at least.
    """
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(sample)))]
    closest = sample @ sample[chosen[0]]
    while len(chosen) < min(count, len(sample)):
        far = int(np.argmin(closest))
        if len(chosen) >= NEAREST and closest[far] >= threshold:
            break
        chosen.append(far)
        closest = np.maximum(closest, sample @ sample[far])
    points = sample[chosen]
    if len(points) < NEAREST:
        points = np.concatenate([points, random_points(sample.shape[1], NEAREST - len(points), seed)])
    return points


def random_points(dimension: int, count: int = PIVOTS, seed: int = SEED) -> np.ndarray:
    return unit(np.random.default_rng([seed, dimension]).normal(size=(count, dimension)))


def nearest(vectors: np.ndarray, points: np.ndarray, count: int = NEAREST) -> np.ndarray:
    """Numbers of the nearest points of each vector, nearest first; ties by number."""
    return np.argsort(-(vectors @ points.T), axis=1, kind="stable")[:, :count]


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values in double precision, and where each vector begins and ends."""
    return column.values.to_numpy().astype(np.float64), column.offsets.to_numpy()


def _lists(nodes: DataFrame, points, kind: str, threshold: float) -> DataFrame:
    """list, node, weight, pivots, vector: a row per pair of the nearest pivots of each node."""
    a, b = np.triu_indices(NEAREST, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = dict(points.value)
        for batch in batches:
            flat, edges = _matrix(batch.column(2))
            sizes = np.diff(edges)
            found = np.empty((batch.num_rows, NEAREST), np.int64)
            for size in np.unique(sizes).tolist():
                if size not in known:
                    known[size] = reference_points(random_points(size), threshold=threshold)
                own = np.flatnonzero(sizes == size)
                found[own] = nearest(unit(flat[edges[own][:, None] + np.arange(size)]), known[size])
            found.sort(axis=1)
            lists = (sizes[:, None] * PIVOTS + found[:, a]) * PIVOTS + found[:, b]
            each = pa.array(np.repeat(np.arange(batch.num_rows), len(a)))
            pivots = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel().astype(np.int32)), NEAREST)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lists.ravel()), batch.column(0).take(each), batch.column(1).take(each),
                    pivots.cast(pa.list_(pa.int32())).take(each), batch.column(2).take(each),
                ],
                names=["list", "node", "weight", "pivots", "vector"],
            )

    return nodes.mapInArrow(run, f"list long, node long, weight long, pivots array<int>, vector {kind}")


def home_list(a: np.ndarray, b: np.ndarray, dimension: int) -> np.ndarray:
    """The list of the two smallest pivots shared by each pair of (ascending) pivot rows."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
    order = np.argsort(~shared, axis=1, kind="stable")[:, :2]
    first, second = np.take_along_axis(a, order, axis=1).T.astype(np.int64)
    return (dimension * PIVOTS + first) * PIVOTS + second


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of every pair (i, j); `root` keeps the smallest member of each tree."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _compared(
    list_: int, node: np.ndarray, weight: np.ndarray, side: np.ndarray, pivots: np.ndarray,
    vectors: np.ndarray, threshold: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, other) rows of one group: link counts by node, then spanning edges."""
    split = side.max() > 0  # rows of two blocks: pairs across them only
    rows = np.flatnonzero(side == 0) if split else np.arange(len(node))
    columns = np.flatnonzero(side == 1) if split else rows
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for begin in range(0, len(rows), 512):
        part = rows[begin : begin + 512]
        i, j = np.nonzero(vectors[part] @ vectors[columns].T >= threshold)
        i, j = part[i], columns[j]
        if not split:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        home = home_list(pivots[i], pivots[j], vectors.shape[1]) == list_
        i, j = i[home], j[home]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        _merge(root, i, j)
    some = np.flatnonzero(links)
    a = np.flatnonzero(root != np.arange(len(root)))
    b = root[a]
    return (
        np.concatenate([node[some], node[a]]),
        np.concatenate([links[some], np.zeros(len(a), np.int64)]),
        np.concatenate([node[some], node[b]]),
    )


def _verified(groups: DataFrame, threshold: float) -> DataFrame:
    """node, links, other: counts (other = node) and spanning edges, from rows ordered by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[:3]])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if held and batch.num_rows:
                last = [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(3)]
                if last != keys[:, 0].tolist():
                    yield from whole(held)
                    held = []
            if len(edges):
                # Every group but the last one of the batch is complete.
                yield from whole([*held, batch.slice(0, edges[-1])])
                held = [batch.slice(edges[-1])]
            elif batch.num_rows:
                held.append(batch)
        if held:
            yield from whole(held)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        list_, one, two, side, node, weight = (rows.column(k).to_numpy() for k in range(6))
        new = np.concatenate([[True], (np.diff(list_) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)])
        starts = np.append(np.flatnonzero(new), len(list_))
        pivots = rows["pivots"].chunk(0).flatten().to_numpy().reshape(-1, NEAREST)
        flat, edges = _matrix(rows["vector"].chunk(0))
        found = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a > 1:
                vectors = unit(flat[edges[a] : edges[b]].reshape(b - a, -1))
                own = slice(a, b)
                found.append(_compared(list_[a], node[own], weight[own], side[own], pivots[own], vectors, threshold))
        found = [f for f in found if len(f[0])]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*found)], names=["node", "links", "other"]
            )

    return groups.mapInArrow(run, "node long, links long, other long")


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = rows.sparkSession
    bounded_batches(spark)
    kind = rows.schema[vector_col].dataType.simpleString()
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    usable = F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    given = given.select("id", F.when(usable, F.col("vector")).alias("vector"), F.xxhash64("vector").alias("hash"))
    nodes = stored(
        given.filter("vector IS NOT NULL").groupBy("hash", "vector").agg(
            F.min("id").alias("low"), F.count("*").alias("weight")
        ).withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )

    sample = nodes.orderBy("hash", "vector").limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    points: dict[int, np.ndarray] = {}
    if len(sample):
        flat, edges = _matrix(sample if isinstance(sample, pa.Array) else sample.chunk(0))
        sizes = np.diff(edges)
        for size in np.unique(sizes).tolist():
            own = edges[:-1][sizes == size]
            points[size] = reference_points(unit(flat[own[:, None] + np.arange(size)]), threshold=threshold)
    lists = _lists(nodes.select("node", "weight", "vector"), spark.sparkContext.broadcast(points), kind, threshold)

    # Only lists longer than a block need their length known; they are few.
    lengths = _lists(nodes.select("node", "weight", "vector"), spark.sparkContext.broadcast(points), kind, threshold)
    long_lists = stored(
        lengths.groupBy("list").count().filter(F.col("count") > BLOCK)
        .select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")),
        "long-lists",
    )
    dealt = lists.join(long_lists, "list", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Block x meets every block y: pairs (min, max), its rows on side 1 where it is the larger.
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = dealt.select(
        "list", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"),
        (F.col("block") > F.col("with")).cast("int").alias("side"), "node", "weight", "pivots", "vector",
    )
    ordered = groups.repartition("list", "one", "two").sortWithinPartitions("list", "one", "two")
    found = stored(_verified(ordered, threshold), "links")

    counts = found.filter("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(
        found.filter("node != other").select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors"
    )
    of_node = (
        nodes.select("node", "hash", "vector", "low", "weight")
        .join(counts, "node", "left").join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = of_node.groupBy("component").agg(F.min("low").alias("component_id"))
    of_node = stored(
        of_node.join(lowest, "component").select(
            "hash", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
        ),
        "vector-components",
    )
    linked = given.filter("vector IS NOT NULL").join(of_node, ["hash", "vector"]).select(
        "id", "n_links", "component_id"
    )
    alone = given.filter("vector IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
