"""Finding the few keys that hold far more rows than one task should sort.

A key is hot when it has more than `HOT_ROWS` rows, a fixed amount of work for one task. At
most one key per `HOT_ROWS` rows can be hot: 100 TB of trips, about 10^12 rows, have at most
200,000, some 10 MB.

The search is two narrow counting passes, both combined on the map side:

1. rows are counted in hash buckets; only a bucket with more rows than the limit can hold a
   hot key, so at most one bucket per `HOT_ROWS` rows is left. The number of buckets follows the number
   of rows: the mean bucket has a sixteenth of the limit at most, at any size of the table.
2. inside those buckets rows are counted per key, exactly.

Where step 1 finds nothing, adaptive execution drops step 2 and every plan branch that joins to
the empty list. Hot keys are ranked by another plan, in the same total order, so the limit
decides where rows are sorted and never which rank a row has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BUCKETS = 1 << 16
BUCKETS_PER_LIMIT = 16
HOT_ROWS = 5_000_000  # a task still sorts this many rows in reasonable time


def buckets_for(rows: int, hot_rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows * BUCKETS_PER_LIMIT // hot_rows))


def hot_keys(rows: DataFrame, key: str, bucket_on: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hot values of `key`.

    `bucket_on` are cheap columns that determine the key; rows where one of them is NULL
    share one bucket, because a NULL part makes the whole key NULL.
    """
    missing = F.lit(False)
    for part in bucket_on:
        missing = missing | part.isNull()
    buckets = buckets_for(rows.count(), hot_rows)  # the count is in the footers of stored rows
    bucket = F.when(missing, -1).otherwise(F.pmod(F.xxhash64(*bucket_on), F.lit(buckets)))
    bucketed = rows.withColumn("_bucket", bucket)

    # One per `hot_rows` rows at most.
    hot_buckets = bucketed.groupBy("_bucket").count().filter(F.col("count") > hot_rows).select("_bucket")
    per_key = bucketed.join(F.broadcast(hot_buckets), "_bucket").groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.filter(F.col("_n") > hot_rows).drop("_n")
