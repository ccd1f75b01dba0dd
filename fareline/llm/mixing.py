"""Mix sources to target weights by hash thresholds, without sorting documents.

Every document gets a 60-bit hash. Sizes are summed by source and the first ten bits of the
hash; in the running sum of these buckets one bucket holds the source's budget. Only that
bucket is refined by the next ten bits, and so on, until the boundary is one hash value. A
document is taken if its hash is below its source's threshold: a filter on the scan. Nothing
is sorted or shuffled but the histograms, which are combined on the map side.

A source whose target exceeds its size is taken whole as often as it fits; the threshold
decides about one more copy. The document on the boundary is taken if that brings the source
nearer to its target.

Defined results: null texts have size 0; null is a source of its own, last in order. Rows with
the same id and text share a hash and are taken or left together. A source without words has
the target 0, and its rows, which fit into that, are taken once. The same rows always give the same mix. Extra columns are carried in a struct, so their
names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline.llm.common import WORD, stored, table, text_or_empty

HASH_BITS = 60
LEVEL_BITS = 10
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def mix_hash(id_col: str, text_col: str) -> Column:
    """The first 60 bits of an MD5 over id and text."""
    key = F.concat_ws(
        "|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(text_or_empty(text_col))
    )
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: all sizes shared by weight, each at most `most` times its size.

    Filling every source to the same level per weight, with those that are full left out, has
    a closed form: with sources ordered by cap per weight, the level is the largest of
    (what earlier full sources leave) / (weights of the rest). The windows see a row per source.
    """
    every = Win.partitionBy()
    by_fill = Win.partitionBy().orderBy("fill", "nth").rowsBetween(Win.unboundedPreceding, -1)
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("nth"), F.lit(len(weights))) + 1).cast("int")
    )
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = per_source.withColumn(
        "nth", F.row_number().over(Win.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    left = ordered.withColumn("fill", F.col("cap") / F.col("weight")).withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(by_fill), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_fill), F.lit(0))),
    )
    filled = F.least(F.col("cap").cast("double"), F.max("level").over(every) * F.col("weight"))
    return left.select("source", "source_size", filled.alias("target"))


def thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """source, source_size, target, copies, below: one more copy where hash < below.

    `sizes` holds source, size and hash per document.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = stored(
        goal.withColumn("copies", whole.cast("int")).select(
            "*",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
            F.lit(0).cast("long").alias("below"),  # everything under it is taken
            F.lit(0).cast("long").alias("taken"),  # the size of that
            F.lit(HASH_BITS).alias("shift"),  # log2 of the range still open from `below`
            F.lit(False).alias("done"),
        ),
        "mix-goal",
    )
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        pending = state.filter("not done")
        if pending.isEmpty():
            break
        state = stored(_refined(sizes, state, shift), "mix-level")
    return state.select("source", "source_size", "target", "copies", "below")


def _refined(sizes: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """Split the open bucket of each source into 2**LEVEL_BITS, and find the next open one."""
    wide = shift + LEVEL_BITS
    range_ = state.filter("not done").select(F.col("source").alias("s"), "below", "budget", "taken")
    inside = F.shiftright("hash", wide) == F.shiftright("below", wide)
    buckets = (
        sizes.join(range_, sizes["source"].eqNullSafe(range_["s"]) & inside)
        .groupBy("s", F.shiftright("hash", shift).alias("bucket"))
        .agg(
            F.sum("size").alias("size"), F.first("budget").alias("budget"),
            F.first("taken").alias("taken"), F.min("hash").alias("low"), F.max("hash").alias("high"),
        )
    )
    running = Win.partitionBy("s").orderBy("bucket").rowsBetween(Win.unboundedPreceding, 0)
    edges = buckets.withColumn("end", F.col("taken") + F.sum("size").over(running)).withColumn(
        "begin", F.col("end") - F.col("size")
    )
    # The open bucket begins under the budget and ends above it; a source without one is done.
    open_ = edges.filter((F.col("begin") < F.col("budget")) & (F.col("end") > F.col("budget")))
    nearer = F.col("begin") + F.col("end") <= 2 * F.col("budget")
    one = F.col("low") == F.col("high")
    found = open_.select(
        "s",
        F.when(one, F.col("low") + nearer.cast("long"))
        .otherwise(F.shiftleft("bucket", shift)).alias("next_below"),
        F.col("begin").alias("next_taken"),
        one.alias("next_done"),
    )
    full = edges.groupBy("s").agg(
        F.max(F.when(F.col("end") <= F.col("budget"), F.shiftleft(F.col("bucket") + 1, shift))).alias("full")
    )
    joined = state.join(found, state["source"].eqNullSafe(found["s"]), "left").drop("s")
    joined = joined.join(full, joined["source"].eqNullSafe(full["s"]), "left").drop("s")
    hit = F.col("next_done").isNotNull()
    moved = F.when(F.col("done"), F.col("below")).otherwise(
        F.coalesce("next_below", F.greatest("below", "full"), "below")
    )
    return joined.select(
        "source", "source_size", "target", "copies", "budget",
        moved.alias("below"),
        F.coalesce("next_taken", "taken").alias("taken"),
        F.lit(shift).alias("shift"),
        (F.col("done") | ~hit | F.col("next_done")).alias("done"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies (0 to `most`)."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
        mix_hash(id_col, text_col).alias("hash"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    if carry:
        sizes = stored(rows.select("source", "size", "hash"), "mix-sizes")
    else:  # nothing but narrow columns: the stored rows serve the last step too
        rows = sizes = stored(rows, "mix-sizes")
    limits = thresholds(sizes, targets(sizes, weights, most)).withColumnRenamed("source", "s")
    return rows.join(limits, rows["source"].eqNullSafe(limits["s"])).select(
        *(["row"] if carry else []), "id", "source", "size", "source_size", "target",
        (F.col("copies") + (F.col("hash") < F.col("below")).cast("int")).alias("copies"),
    )


def mixed(docs: DataFrame, **columns) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of the input."""
    taken = mix(docs, carry=True, **columns).filter("copies > 0")
    repeated = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM docs GROUP BY source
), weighted AS (
  SELECT *, nth % 3 + 1 AS weight, 3 * source_size AS cap FROM per_source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap::DOUBLE / weight::DOUBLE, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size,
         least(cap::DOUBLE, max(level) OVER () * weight) AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM goals
), running AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.copies,
         b.target - b.copies * b.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.hash) AS tied
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= budget
                     OR (upto - tied < budget AND 2 * upto - tied <= 2 * budget) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""
