"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

1. One narrow aggregation counts documents by byte length and hash of the first bytes. A
   document that is alone in its group has no equal and is settled here.
2. Only documents of groups with two or more members have their whole text hashed (SHA-256).
3. The full hashes are counted with map-side combining, and the row to keep is a `max`, so a
   group of any size never meets in one task; it is joined back on the hash.

Texts are not exchanged while the groups of a step are few (`common.small_side`): they go to the rows.
Beyond that both joins exchange rows, and adaptive execution may split them.

Whole rows are never written: `without_copies` looks up those that go while it reads the input again.
Only DataFrame functions are used.

Defined results: a null text counts as an empty one. Of equal texts the row with the largest
id stays; null ids lose to any id; of rows equal in text and id exactly one stays. Columns of
the input are never resolved by name except id and text, so any extra column may clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import small_side, staying, stored, table, text_or_empty

PREFIX_CHARS = 256


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, full_hash.

    `full_hash` is null for documents settled by
    length and prefix, unless `digest_all` asks for the digest of every text.
    """
    rows, text = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), F.col("text")
    keyed = rows.withColumns(
        {"length": F.octet_length(text), "prefix": F.xxhash64(F.substring(text, 1, prefix_chars))}
    )
    # Written, so that its size is known, and a join that exchanges rows has plain exchanges and can be split.
    shared = stored(
        keyed.groupBy("length", "prefix").count().filter("count > 1").select(
            "length", "prefix", F.lit(True).alias("shared")
        ),
        "same-prefix",
    )
    hashed = F.sha2(text.cast("binary"), 256)
    settled = keyed.join(small_side(shared), ["length", "prefix"], "left").select(
        "id",
        F.coalesce("shared", F.lit(False)).alias("shared"),
        (hashed if digest_all else F.when(F.col("shared"), hashed)).alias("full_hash"),
        F.monotonically_increasing_id().alias("nth"),
    )
    settled = stored(settled, "hashed")
    groups = stored(
        settled.filter("shared").groupBy("full_hash").agg(
            F.max(F.struct("id", "nth")).alias("top"), F.count("*").alias("group_size")
        ),
        "same-text",
    )
    alone = settled.filter("not shared").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "full_hash",
    )
    compared = settled.filter("shared").join(small_side(groups), "full_hash").select(
        "id", F.col("top.id").alias("keep_id"), "group_size",
        (F.col("nth") == F.col("top.nth")).alias("kept"), "full_hash",
    )
    return alone.unionByName(compared)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input, which is read once more for them.

    A row goes by its id and the digest of its text, so that no whole row is written.
    """
    named = docs.select(
        F.struct("*").alias("row"),
        F.struct(F.col(id_col).alias("id"), F.sha2(text_or_empty(text_col).cast("binary"), 256).alias("hash")).alias("name"),
    )
    found = exact_duplicates(docs, id_col, text_col).filter("full_hash IS NOT NULL")
    names = found.groupBy(F.struct("id", F.col("full_hash").alias("hash")).alias("id")).agg(
        (~F.max("kept")).alias("leave"), F.count("*").alias("rows")
    )
    return staying(named, names)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    result = exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)
    return result.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("full_hash").alias("text_sha256"),
    )


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
