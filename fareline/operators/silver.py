"""Silver: typing, trip key, validity rules, deduplication, quarantine, field repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline import words as W
from fareline.functions import columns as C
from fareline.operators.skew import HOT_ROWS, hot_keys
from fareline.schemas import MONEY
from fareline.session import scratch_path

# Source column -> silver name, for the columns that are only renamed and cast.
CODES = {
    "vendorid": "vendor_id",
    "passenger_count": "passenger_count",
    "ratecodeid": "rate_code_id",
    "pulocationid": "pickup_location_id",
    "dolocationid": "dropoff_location_id",
    "payment_type": "payment_type_id",
}
AMOUNTS = {
    "trip_distance": "trip_distance_miles",
    "fare_amount": "fare_amount",
    "extra": "extra_amount",
    "mta_tax": "mta_tax_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge_amount",
    "congestion_surcharge": "congestion_surcharge_amount",
    "airport_fee": "airport_fee_amount",
    "cbd_congestion_fee": "cbd_congestion_fee_amount",
    "total_amount": "total_amount",
}
TIMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}
LINEAGE = ["_source_file", "_source_period", "_loaded_at"]

TYPED_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "duration_seconds",
    "passenger_count", "trip_distance_miles", "rate_code_id", "is_store_and_forward",
    "pickup_location_id", "dropoff_location_id", "payment_type_id",
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount", "total_amount",
]
EVALUATED_COLUMNS = ["trip_id", *TYPED_COLUMNS, "has_reversal", "rejection_reason", *LINEAGE]
SILVER_COLUMNS = [
    "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes",
    *TYPED_COLUMNS[4:], "has_reversal", *LINEAGE,
]

# Limits of the validity rules and repairs.
MAX_SECONDS = 24 * 60 * 60
MAX_MILES = 200
MAX_TOTAL = 1000
PASSENGERS = (1, 6)
UNKNOWN_RATE = 99

COPIES_PER_TASK = 1_000_000

# The columns that make up the trip key, and what rows are gathered by: times count to the second.
KEY_PARTS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]
TRIP_PARTS = ["_start", "_end", "pickup_location_id", "dropoff_location_id", "vendor_id"]
# Wide rows that a task sorts in memory; small tables are dealt out in tasks of the lesser number.
ROWS_PER_TASK = 500_000
LEAST_ROWS_PER_TASK = 50_000


def typed(bronze: DataFrame) -> DataFrame:
    """Snake-case names and proper types; values are not corrected yet."""
    columns = {new: F.col(old).cast("int") for old, new in CODES.items()}
    columns |= {new: F.col(old).cast(MONEY) for old, new in AMOUNTS.items()}
    columns |= {new: F.col(old) for old, new in TIMES.items()}
    columns["duration_seconds"] = C.seconds_between(
        F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    )
    columns["is_store_and_forward"] = C.yes_no(F.col("store_and_fwd_flag"))
    return bronze.select(*[columns[name].alias(name) for name in TYPED_COLUMNS], *LINEAGE)


def with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "trip_id",
        C.trip_key(
            F.col("vendor_id"), F.col("pickup_datetime"), F.col("dropoff_datetime"),
            F.col("pickup_location_id"), F.col("dropoff_location_id"),
        ),
    )


def rules(words: W.Words) -> list[tuple[str, Column]]:
    """Ordered rules; a row is rejected for the first one it breaks."""
    total, fare, miles = F.col("total_amount"), F.col("fare_amount"), F.col("trip_distance_miles")
    pickup, dropoff, seconds = (
        F.col("pickup_datetime"), F.col("dropoff_datetime"), F.col("duration_seconds")
    )
    return [
        (words.negative_total, total < 0),
        (words.negative_fare, fare < 0),
        (words.dropoff_before_pickup, dropoff < pickup),
        (words.over_24h, seconds > MAX_SECONDS),
        (words.outside_period, C.month_start(pickup) != F.col("_source_period")),
        (words.no_movement, (seconds == 0) & (miles == 0)),
        (words.distance_over_200, miles > MAX_MILES),
        (words.total_over_1000, total > MAX_TOTAL),
    ]


def with_broken_rule(rows: DataFrame, words: W.Words = W.SOURCE) -> DataFrame:
    (label, condition), *rest = rules(words)
    first_broken = F.when(condition, label)
    for label, condition in rest:
        first_broken = first_broken.when(condition, label)
    return rows.withColumn("broken_rule", first_broken)


def prepared(bronze: DataFrame, words: W.Words = W.SOURCE) -> DataFrame:
    """Typed rows with their key and first broken rule: what deduplication works on."""
    return with_broken_rule(with_key(typed(bronze)), words)


def with_fingerprint(rows: DataFrame) -> DataFrame:
    """64-bit hash of the whole row, to compare rows or to spread them."""
    return rows.withColumn("row_fingerprint", F.xxhash64(*rows.columns))


# The columns that order the rows of a trip, the leading ones first. All columns of a row are
# here or follow from those that are (the key, the broken rule), so rows that tie are equal.
KEEP_FIRST = ["total_amount", "_loaded_at", "_source_file"]
KEEP_THEN = [
    "passenger_count", "trip_distance_miles", "rate_code_id", "is_store_and_forward",
    "payment_type_id", "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount", "pickup_datetime", "dropoff_datetime", "vendor_id",
    "pickup_location_id", "dropoff_location_id", "_source_period", "duration_seconds",
]


def keep_order() -> list[Column]:
    """Which row of a trip is kept: highest total, latest load, then all other columns.

    The order is total: whatever the order of the input and however a trip's rows are dealt
    out, the same row stays. Only rows that are equal in every column tie.
    """
    total, loaded, file = KEEP_FIRST
    return [
        F.desc_nulls_first(total), F.desc_nulls_first(loaded), F.asc_nulls_last(file),
        *[F.asc_nulls_last(name) for name in KEEP_THEN],
    ]


def _is_negative() -> Column:
    return F.coalesce(F.col("total_amount") < 0, F.lit(False))


def hot_trips(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Trips with too many rows for one task to rank."""
    parts = [
        F.col("vendor_id"), F.unix_timestamp("pickup_datetime"), F.unix_timestamp("dropoff_datetime"),
        F.col("pickup_location_id"), F.col("dropoff_location_id"),
    ]
    return hot_keys(rows, "trip_id", parts, hot_rows)


def gathered(rows: DataFrame) -> DataFrame:
    """Rows with a key, those of a trip in one task, tasks in the order of their pickups.

    Exchanged by the parts of the key, as `_start`, `_end` and typed columns; the key itself
    follows from them and is left out.
    """
    parts = rows.drop("trip_id").withColumns(
        {"_start": F.unix_timestamp("pickup_datetime"), "_end": F.unix_timestamp("dropoff_datetime")}
    )
    return parts.repartitionByRange(_tasks(rows), *TRIP_PARTS)


def _tasks(rows: DataFrame) -> int:
    n = rows.count()  # in the footers of stored rows
    configured = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(configured, -(-n // LEAST_ROWS_PER_TASK)), -(-n // ROWS_PER_TASK))


def _apart(rows: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary trips; and those without a key, or of trips too large for one task, if there are any."""
    keyless = C.any_of([F.col(name).isNull() for name in KEY_PARTS])
    hot = [r["trip_id"] for r in hot_trips(rows.filter(~keyless), hot_rows).collect()]  # one per `hot_rows` rows
    if not hot and rows.filter(keyless).isEmpty():
        return rows, None
    if not hot:
        return rows.filter(~keyless), rows.filter(keyless)
    large = F.broadcast(rows.sparkSession.createDataFrame([(key,) for key in hot], "hot_id string"))
    is_large = rows["trip_id"] == large["hot_id"]
    return rows.filter(~keyless).join(large, is_large, "left_anti"), rows.filter(keyless).unionByName(
        rows.filter(~keyless).join(large, is_large, "left_semi")
    )


def dedup_rank(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Position of each row among the rows of its trip that are as valid as itself."""
    ordinary, large = _apart(rows.withColumn("_valid", F.col("broken_rule").isNull()), hot_rows)
    group = Win.partitionBy(*TRIP_PARTS, "_valid").orderBy(*keep_order())
    ranked = gathered(ordinary).withColumn("dedup_rank", F.row_number().over(group).cast("bigint"))
    ranked = with_key(ranked).select(*rows.columns, "dedup_rank")
    if large is None:
        return ranked
    return ranked.unionByName(_rank_by_counting(large).drop("_valid"))


def _rank_by_counting(rows: DataFrame) -> DataFrame:
    """The same position without sorting a whole trip in one task.

    Equal rows are counted instead of carried along. The leading order columns cut a trip
    into slices; the rows before a slice are a running sum over slice sizes, the rows before
    it inside the slice a running sum over the slice. Copies are written out again at the
    end, in chunks, each with its own position.
    """
    head, tail = keep_order()[: len(KEEP_FIRST)], keep_order()[len(KEEP_FIRST) :]
    slice_of = ["trip_id", "_valid", *KEEP_FIRST]
    copies = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    earlier_slices = (
        Win.partitionBy("trip_id", "_valid").orderBy(*head).rowsBetween(Win.unboundedPreceding, -1)
    )
    slices = copies.groupBy(*slice_of).agg(F.sum("_n").alias("_rows")).select(
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(slice_of)],
        F.coalesce(F.sum("_rows").over(earlier_slices), F.lit(0)).alias("_before"),
    )
    same = reduce(
        lambda a, b: a & b,
        [copies[c].eqNullSafe(slices[f"_s{i}"]) for i, c in enumerate(slice_of)],
    )
    earlier_rows = Win.partitionBy(*slice_of).orderBy(*tail).rowsBetween(Win.unboundedPreceding, -1)
    chunks = (
        copies.join(slices, same)
        .withColumn(
            "_first", F.col("_before") + F.coalesce(F.sum("_n").over(earlier_rows), F.lit(0)) + 1
        )
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {COPIES_PER_TASK}"))))
        .withColumn("_from", F.col("_first") + F.col("_chunk") * COPIES_PER_TASK)
        .withColumn("_to", F.least(F.col("_from") + (COPIES_PER_TASK - 1), F.col("_first") + F.col("_n") - 1))
        .repartition("trip_id", "_valid", "_from")
    )
    return chunks.withColumn("dedup_rank", F.explode(F.sequence("_from", "_to"))).select(
        *rows.columns, "dedup_rank"
    )


def keep_key(*last: str) -> Column:
    """The same order as `keep_order`, as a struct: the row to keep has the least one."""
    total, loaded, file = KEEP_FIRST
    parts = [
        F.col(total).isNotNull(), -F.col(total),
        F.col(loaded).isNotNull(), -F.unix_micros(loaded),
        F.col(file).isNull(), F.col(file),
    ]
    for name in KEEP_THEN:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.struct(*[part.alias(f"k{i}") for i, part in enumerate(parts)], *last)


def notable_trips(rows: DataFrame) -> DataFrame:
    """trip_id, valid_rows, reversed: trips with several valid rows or a reversal.

    Counts and a flag per key, combined on the map side: a trip of any size comes in as one row
    per task, and nothing is sorted.
    """
    valid = F.col("broken_rule").isNull()
    counts = rows.groupBy("trip_id").agg(
        F.count_if(valid).alias("valid_rows"), F.max(_is_negative()).alias("reversed")
    )
    return counts.filter((F.col("valid_rows") > 1) | F.col("reversed"))


def with_duplicates(rows: DataFrame, scratch: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds `has_reversal` and `is_repeat` (a valid row that loses against another valid one).

    Whole rows are exchanged once: a trip's rows come together by the parts of the key and are ranked
    where they are. Rows without a key, all one group, and trips too large for one task are
    judged by aggregates instead, in the same total order.
    """
    ordinary, large = _apart(rows, hot_rows)
    trip = Win.partitionBy(*TRIP_PARTS)
    valid = F.col("broken_rule").isNull()
    first = F.row_number().over(trip.orderBy(~valid, *keep_order())) == 1
    judged = with_key(
        gathered(ordinary).withColumn("is_repeat", valid & ~first)
        .withColumn("has_reversal", F.max(_is_negative()).over(trip))
    ).select(*rows.columns, "has_reversal", "is_repeat")
    if large is None:
        return judged
    # Joins deal these rows out; those of a month are brought together again.
    return judged.unionByName(_judged_by_counting(large, scratch).hint("rebalance", "_source_period"))


def _judged_by_counting(rows: DataFrame, scratch: str | None = None) -> DataFrame:
    """The same without gathering a trip in one task.

    Trips with something to tell are found by counting, and joined to their rows: an exchange
    of whole rows, which adaptive execution splits where a trip is large. Of the valid rows of
    trips that have several, the one to keep is the least key in the total order, an aggregate
    that is combined on the map side as well. All other rows are done by then. `scratch` is a folder for the two
    written steps.
    """
    spark = rows.sparkSession
    scratch = scratch or scratch_path(spark, "duplicates")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    # Written, so that both sides of the join are plain exchanges, which can be split.
    notable = stored(notable_trips(rows).withColumnRenamed("trip_id", "notable_id"), "notable")
    known = rows.join(notable, rows["trip_id"].eqNullSafe(notable["notable_id"]), "left").select(
        *rows.columns,
        F.coalesce("reversed", F.lit(False)).alias("has_reversal"),
        (F.col("broken_rule").isNull() & (F.coalesce("valid_rows", F.lit(0)) > 1)).alias("_contested"),
        F.monotonically_increasing_id().alias("_row"),
    )
    known = stored(known, "known")
    contested = known.filter("_contested")
    kept = contested.groupBy("trip_id").agg(F.min(keep_key("_row")).getField("_row").alias("_kept"))
    judged = contested.join(kept.select("_kept"), F.col("_row") == F.col("_kept"), "left").withColumn(
        "is_repeat", F.col("_kept").isNull()
    )
    out = [*rows.columns, "has_reversal", "is_repeat"]
    return known.filter("not _contested").withColumn("is_repeat", F.lit(False)).select(out).unionByName(
        judged.select(out)
    )


def with_reason(rows: DataFrame, words: W.Words = W.SOURCE) -> DataFrame:
    reason = F.when(F.col("broken_rule").isNotNull(), F.col("broken_rule")).when(
        F.col("is_repeat"), words.duplicate
    )
    return rows.withColumn("rejection_reason", reason)


def evaluate(bronze: DataFrame, words: W.Words = W.SOURCE, scratch: str | None = None) -> DataFrame:
    """Every bronze row, typed, with its key, reversal flag and rejection reason."""
    judged = with_reason(with_duplicates(prepared(bronze, words), scratch), words)
    return judged.select(EVALUATED_COLUMNS)


def accepted(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col("rejection_reason").isNull())


def rejected(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col("rejection_reason").isNotNull())


def repaired(rows: DataFrame) -> DataFrame:
    """Impossible single values become NULL, a missing rate code becomes 99."""
    seconds = F.col("duration_seconds")
    return rows.withColumns(
        {
            "trip_duration_minutes": F.when(seconds > 0, seconds / 60).cast(MONEY),
            "passenger_count": F.when(
                F.col("passenger_count").between(*PASSENGERS), F.col("passenger_count")
            ),
            "trip_distance_miles": F.nullif(F.col("trip_distance_miles"), F.lit(0).cast(MONEY)),
            "rate_code_id": F.coalesce("rate_code_id", F.lit(UNKNOWN_RATE)),
        }
    )


def silver_trips(evaluated: DataFrame) -> DataFrame:
    return repaired(accepted(evaluated)).select(SILVER_COLUMNS)


def rejections_by_reason(rejected_rows: DataFrame) -> DataFrame:
    counts = rejected_rows.groupBy("rejection_reason").agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "rejection_reason")


def silver_zones(bronze_zones: DataFrame) -> DataFrame:
    """Zone list with explicit labels where the source is blank."""
    place = F.when(F.col("location_id") == W.OUTSIDE_ZONE, W.OUTSIDE_PLACE).otherwise(W.UNKNOWN_PLACE)
    named = bronze_zones.withColumn("location_id", F.col("locationid").cast("int"))
    return named.select(
        "location_id",
        F.coalesce(C.text_or_null(F.col("borough")), place).alias("borough"),
        F.coalesce(C.text_or_null(F.col("zone")), place).alias("zone_name"),
        F.coalesce(C.text_or_null(F.col("service_zone")), F.lit(W.NO_SERVICE_ZONE)).alias("service_zone"),
        (~F.col("location_id").isin(W.UNKNOWN_ZONE, W.OUTSIDE_ZONE)).alias("is_identified_zone"),
        "_source_file",
        "_loaded_at",
    )
