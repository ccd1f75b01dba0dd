"""Prefix trie of conversations, with subtree figures from its Euler tour.

1. Turns get their place in their conversation from one global sort: rows are dealt into ranges,
   counted per range, and numbered through; a place is a number less the conversation's first.
2. The name of a prefix is the exclusive-or of the 128-bit names of its turns, each taken together
   with its place. That is a running sum, so prefixes of any length are named without bringing a
   conversation into one task; rows of equal names are counted into nodes, combined on the map side.
3. Nodes are numbered in the order of their parents, so siblings have neighbouring numbers.
   Every node has an arc that enters and one that leaves it. The arc after entering a node enters its first child,
   or leaves it again; the arc after leaving it enters its next sibling, or leaves the parent.
4. This list is ranked by contraction: in each round a quarter of the arcs is spliced out by coins
   drawn from their numbers, until `WALKED` are left, which one task follows; the spliced arcs get
   their ranks back in reverse order. Every round is one join on distinct keys.
5. Figures of a subtree are the difference of two running sums over the tour, at the arc that
   leaves its top and before the one that enters it.

Running sums are taken inside blocks of `BLOCK` places, then over the sums of blocks, and so on.
The ids that end at a node are hashed in their order: ranges of sorted ids become chunks of
`CHUNK` bytes, and only these chunks of a node are brought together, one after another.

Defined results: a null role or text is empty. Turns are ordered by number, null first; ties by
the MD5 of role and text; rows that are equal in all this are turns of their own. A null
conversation is one, after all others in the order of ids; its id is not listed
among the ends. An empty table has no nodes, not even a root. Texts of any length count whole;
past the first scan only their digests and numbers of words are moved. Columns are resolved by
name for the four columns only, so extra columns may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline.llm.common import WORD, stored, table, text_or_empty

GROUP = 20  # conversations that share the heads of one
HEADS = 4  # their number is a checksum modulo this
BLOCK = 4096
WALKED = 16_384
CHUNK = 1 << 16
INDEX_BITS = 33  # of monotonically_increasing_id, below the partition


# --- Places and running sums --------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with `index`, 0, 1, 2 ... in the order of the columns, which have to be distinct."""
    parted = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_at", INDEX_BITS)
    sizes = parted.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))  # a row per partition
    before = Win.partitionBy().orderBy("_part").rowsBetween(Win.unboundedPreceding, -1)
    firsts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    inside = F.col("_at").bitwiseAND((1 << INDEX_BITS) - 1)
    return parted.join(F.broadcast(firsts), part == F.col("_part")).select(
        *rows.columns, (F.col("_first") + inside).alias("index")
    )


def _sum(column: Column) -> Column:
    return F.sum(column)


def running(rows: DataFrame, keys: list[str], place: str, columns: list[str], combine, merge, name: str) -> DataFrame:
    """Columns replaced by their running value over the places 0, 1, 2 ... of every key.

    `combine` is the aggregate (sum, exclusive-or), `merge` the same of two columns.
    """
    block = f"{place}_block"
    inside = Win.partitionBy(*keys, block).orderBy(place).rowsBetween(Win.unboundedPreceding, 0)
    blocks = stored(
        rows.withColumn(block, F.expr(f"{place} div {BLOCK}"))
        .withColumns({c: combine(F.col(c)).over(inside) for c in columns}),
        name,
    )
    ends = blocks.filter(F.col(place) % BLOCK == BLOCK - 1)
    if ends.isEmpty():
        return blocks.drop(block)
    whole = running(ends.select(*keys, block, *columns), keys, block, columns, combine, merge, name)
    # What lies before a block: the running value of the block before it.
    before = whole.select(
        *[F.col(k).alias(f"_{k}") for k in keys], (F.col(block) + 1).alias("_after"),
        *[F.col(c).alias(f"_{c}") for c in columns],
    )
    same = F.col(block) == F.col("_after")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return blocks.join(before, same, "left").select(
        *[c for c in rows.columns if c not in columns],
        *[F.when(F.col(f"_{c}").isNull(), F.col(c)).otherwise(merge(F.col(c), F.col(f"_{c}"))).alias(c) for c in columns],
    )


# --- List ranking -------------------------------------------------------------------------


def ranked(links: DataFrame, name: str = "rank") -> DataFrame:
    """id, rank of a list given as id, next (null at its end); the first has rank 0."""
    now = stored(links.select("id", "next", F.lit(1).cast("long").alias("hop")), f"{name}-list")
    rounds: list[DataFrame] = []
    while now.count() > WALKED:
        coin = F.xxhash64("id", F.lit(len(rounds))).bitwiseAND(1) == 1
        kept, heads = now.filter(~coin), now.filter(coin)
        after = heads.toDF("gone", "gone_next", "gone_hop")
        # An arc whose coin shows heads goes if the arc before it shows tails.
        merged = kept.join(after, kept["next"] == after["gone"], "full")
        hit = F.col("gone").isNotNull() & F.col("id").isNotNull()
        step = stored(
            merged.select(
                F.coalesce("id", "gone").alias("id"),
                F.when(F.col("gone").isNotNull(), F.col("gone_next")).otherwise(F.col("next")).alias("next"),
                F.when(hit, F.col("hop") + F.col("gone_hop")).otherwise(F.coalesce("hop", "gone_hop")).alias("hop"),
                F.when(hit, F.col("gone")).alias("gone"),
                F.when(hit, F.col("hop")).alias("away"),
            ),
            f"{name}-round",
        )
        rounds.append(step)
        now = step.select("id", "next", "hop")
    # At most WALKED rows.
    found = stored(now.repartition(1).mapInArrow(_walk, "id long, rank long"), f"{name}-walk")
    while rounds:
        gone = rounds.pop().filter("gone is not null").select(F.col("id").alias("before"), "gone", "away")
        back = gone.join(found, gone["before"] == found["id"]).select(
            F.col("gone").alias("id"), (F.col("rank") + F.col("away")).alias("rank")
        )
        found = stored(found.unionByName(back), f"{name}-found")
    return found


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the one list of the partition from its first arc."""
    after: dict[int, tuple[int | None, int]] = {}
    for batch in batches:
        after.update(zip(batch.column(0).to_pylist(), zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())))
    at = next(iter(after.keys() - {following for following, _ in after.values()}), None)
    ids, ranks, rank = [], [], 0
    while at is not None:
        ids.append(at)
        ranks.append(rank)
        at, hop = after[at]
        rank += hop
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ranks, pa.int64())], names=["id", "rank"])


# --- Rebuilt conversations ----------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, place, said (MD5 of role and text), words of every turn."""
    role, text = text_or_empty("role"), text_or_empty("text")
    narrow = stored(
        conversations.select(
            F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("said"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("nth"),  # equal rows are dealt out, too
        ),
        "turns",
    )
    return stored(numbered(narrow, ["conv", "turn", "said", "nth"], "turns-sorted").drop("turn", "nth"), "turns-numbered")


def heads_of(conv: Column) -> Column:
    return F.crc32(F.coalesce(conv.cast("string"), F.lit("")).cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, size, said, words) of rebuilt conversations, and (conv, size) of all.

    The first turns come from the first conversation of the group, the rest are its own.
    """
    own = turns.groupBy("conv").agg(F.min("index").alias("first"), F.count("*").alias("n"))
    own = stored(own.withColumns({"heads": heads_of(F.col("conv")), "base": F.col("conv") - F.col("conv") % GROUP}), "convs")
    base = own.select(F.col("conv").alias("base"), F.col("first").alias("base_first"), F.col("n").alias("base_n"))
    taken = F.least("heads", F.coalesce("base_n", F.lit(0)))
    convs = stored(
        own.join(base, "base", "left").select(
            "conv", "first", "heads", "base_first", taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("heads"), F.lit(0))).alias("size"),
        ),
        "convs-rebuilt",
    )
    heads = convs.filter("taken > 0").select(
        "conv", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("place"),
        (F.col("base_first") + F.col("place")).alias("index"),
    ).join(turns.select("index", "said", "words"), "index").select("conv", "place", "size", "said", "words")
    place = F.col("index") - F.col("first")
    shape = convs.select(F.col("conv").alias("c"), "first", "heads", "taken", "size")
    rest = turns.join(shape, turns["conv"].eqNullSafe(shape["c"])).filter(place >= F.col("heads")).select(
        "conv", (place - F.col("heads") + F.col("taken")).alias("place"), "size", "said", "words"
    )
    return heads.unionByName(rest), convs.select("conv", "size")


# --- The trie -----------------------------------------------------------------------------


def _half(text: Column, first: int) -> Column:
    """64 bits of a hexadecimal digest, as a signed number."""
    high = F.conv(F.substring(text, first, 8), 16, 10).cast("long")
    low = F.conv(F.substring(text, first + 8, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def named_prefixes(turns: DataFrame) -> DataFrame:
    """conv, depth, size, words, name (a, b) of every prefix, and of the one before it (up_a, up_b)."""
    placed = F.md5(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("said")))
    marked = turns.withColumn("mark", placed).select(
        "conv", "place", "size", "words", _half(F.col("mark"), 1).alias("own_a"), _half(F.col("mark"), 17).alias("own_b")
    ).withColumns({"a": F.col("own_a"), "b": F.col("own_b")})
    summed = running(
        marked, ["conv"], "place", ["a", "b"], F.bit_xor, lambda x, y: x.bitwiseXOR(y), "prefixes"
    )
    return summed.select(
        "conv", (F.col("place") + 1).alias("depth"), "size", "words", "a", "b",
        F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b"),
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 over the ids of (depth, a, b, conv), ascending, joined by commas."""
    order = ["depth", "a", "b", "conv"]
    chunks = stored(
        ends.filter("conv is not null").repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*order).mapInArrow(_chunks, "depth long, a long, b long, low long, ids binary"),
        "ends-chunks",
    )
    order[-1] = "low"
    return chunks.repartition("depth", "a", "b").sortWithinPartitions(*order).mapInArrow(
        _digests, "depth long, a long, b long, ends_sha256 string"
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """(node, value pairs) of rows that follow each other and belong to one node."""
    for batch in batches:
        rows = zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)])
        node, held = None, []
        for depth, a, b, *values in rows:
            if (depth, a, b) != node:
                if held:
                    yield node, held
                node, held = (depth, a, b), []
            held.append(values)
        if held:
            yield node, held


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    held = 0
    for node, values in _runs(batches):
        for begin in range(0, len(values), CHUNK // 20):
            ids = [str(v[0]) for v in values[begin : begin + CHUNK // 20]]
            out.append((*node, values[begin][0], ",".join(ids).encode()))
            held += len(out[-1][-1]) + 64
        if held > 64 * CHUNK:
            yield _chunk_batch(out)
            out, held = [], 0
    yield _chunk_batch(out)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["depth", "a", "b", "low", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest, done = None, None, []
    for at, values in _runs(batches):
        if at != node:
            if node is not None:
                done.append((*node, digest.hexdigest()))
            node, digest = at, hashlib.sha256()
        else:
            digest.update(b",")
        digest.update(b",".join(ids for _, ids in values))
        if len(done) >= 10_000:
            yield _digest_batch(done)
            done = []
    if node is not None:
        done.append((*node, digest.hexdigest()))
    yield _digest_batch(done)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["depth", "a", "b", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(turns_of(conversations))
    prefixes = stored(named_prefixes(turns), "prefixes-named")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = convs.select(
        "conv", zero.alias("depth"), "size", zero.alias("words"), zero.alias("a"), zero.alias("b"),
        none.alias("up_a"), none.alias("up_b"),
    )
    members = prefixes.unionByName(roots)
    counted = members.groupBy("depth", "a", "b").agg(
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"),
    )
    nodes = stored(numbered(counted, ["depth", "up_a", "up_b", "a", "b"], "nodes-sorted"), "nodes")
    linked = stored(_linked(nodes), "nodes-linked")
    sums = _subtrees(linked)
    ends = ends_digest(members.filter("depth = size").select("depth", "a", "b", "conv"))
    shown = linked.join(sums, linked["index"] == sums["node"]).join(ends, ["depth", "a", "b"], "left")
    return shown.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes with their first child, last child, parent and next sibling."""
    families = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.min("index").alias("first_child"), F.max("index").alias("last_child"), F.count("*").alias("n_children")
    )
    tops = stored(nodes.join(families, ["depth", "a", "b"], "left"), "nodes-families")
    parents = tops.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("index").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        F.col("last_child").alias("last_sibling"),
    )
    same = (tops["depth"] == parents["d"]) & (tops["up_a"] == parents["pa"]) & (tops["up_b"] == parents["pb"])
    return tops.join(parents, same, "left").select(
        "index", "depth", "a", "b", "conv_id", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child", "parent",
        F.when(F.col("index") < F.col("last_sibling"), F.col("index") + 1).alias("sibling"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )


def _subtrees(nodes: DataFrame) -> DataFrame:
    """node, n_leaves, saved_tokens summed over the subtree of every node."""
    enter, leave = F.col("index") * 2, F.col("index") * 2 + 1
    arcs = nodes.select(
        F.inline(
            F.array(
                F.struct(enter.alias("id"), F.coalesce(F.col("first_child") * 2, leave).alias("next")),
                F.struct(
                    leave.alias("id"),
                    F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"),
                ),
            )
        )
    )
    ranks = ranked(arcs, "tour")
    worth = nodes.select(
        enter.alias("arc"), (F.col("n_children") == 0).cast("long").alias("leaves"), "saved"
    )
    tour = ranks.join(worth, ranks["id"] == worth["arc"], "left").select(
        "id", "rank", F.coalesce("leaves", F.lit(0)).cast("long").alias("leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved"),
    )
    own = tour.withColumns({"own_leaves": F.col("leaves"), "own_saved": F.col("saved")})
    sums = running(own, [], "rank", ["leaves", "saved"], _sum, lambda x, y: x + y, "tour-sums")
    leaves = F.col("id") % 2 == 1

    def inside(total: str, first: str) -> Column:
        return F.sum(F.when(leaves, F.col(total)).otherwise(F.col(first) - F.col(total)))

    return sums.groupBy(F.shiftright("id", 1).alias("node")).agg(
        inside("leaves", "own_leaves").alias("n_leaves"), inside("saved", "own_saved").alias("saved_tokens")
    )


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations
), bytes AS (
  -- CRC-32 bit by bit: eight steps for each digit of the decimal id.
  SELECT DISTINCT conv, list_reduce(
           list_transform(string_split(conv::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda crc, c: list_reduce(range(0, 8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, c)),
           4294967295::BIGINT) AS crc
  FROM turns
), convs AS (
  SELECT conv, coalesce(xor(crc, 4294967295::BIGINT) % 4, 0) AS heads, conv - conv % 20 AS base FROM bytes
), parts AS (
  SELECT c.conv, 0 AS part, t.place, t.role, t.text
  FROM convs c JOIN turns t ON t.conv = c.base AND t.place < c.heads
  UNION ALL
  SELECT c.conv, 1, t.place, t.role, t.text
  FROM convs c JOIN turns t ON t.conv IS NOT DISTINCT FROM c.conv AND t.place >= c.heads
), rebuilt AS (
  SELECT conv, md5(strlen(role) || ':' || role || text) AS said,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv ORDER BY part, place) AS depth
  FROM parts
), prefixes AS (
  SELECT conv, depth, words, string_agg(said, '/') OVER (PARTITION BY conv ORDER BY depth) || '/' AS name FROM rebuilt
  UNION ALL
  SELECT conv, 0, 0, '' FROM convs
), lasts AS (
  SELECT conv, max_by(name, depth) AS name FROM prefixes GROUP BY conv
), ends AS (
  SELECT name, string_agg(conv::VARCHAR, ',' ORDER BY conv) AS ids FROM lasts GROUP BY name
), nodes AS (
  SELECT name, depth, min(conv) AS conv_id, count(*) AS n_convs, max(words) AS words,
         CASE WHEN depth > 0 THEN left(name, length(name) - 33) END AS parent
  FROM prefixes GROUP BY name, depth
), families AS (
  SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), judged AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON f.parent = n.name
), subtrees AS (
  SELECT t.name, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM judged b, unnest(range(0, b.depth + 1)) AS up(k) JOIN nodes t ON t.name = left(b.name, 33 * up.k::BIGINT)
  GROUP BY t.name
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM judged n
JOIN subtrees s ON s.name = n.name
LEFT JOIN nodes p ON p.name = n.parent
LEFT JOIN ends e ON e.name = n.name
"""
