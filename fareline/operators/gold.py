"""Gold: one fact table, six dimensions, and the reports on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import words as W
from fareline.functions import columns as C

MEASURES = [
    "passenger_count", "trip_distance_miles", "trip_duration_minutes",
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount", "total_amount",
]
# Service zones, rate codes and payment codes with a meaning of their own.
AIRPORT_SERVICE = ("Airports", "EWR")
AIRPORT_RATES = (2, 3)
SHARE = "decimal(18,4)"


def fact_trips(silver: DataFrame) -> DataFrame:
    """One row per valid trip: key, nine foreign keys, attributes, measures, lineage."""
    return silver.select(
        "trip_id",
        C.date_key(F.col("pickup_datetime")).alias("pickup_date_key"),
        F.hour("pickup_datetime").alias("pickup_time_key"),
        C.date_key(F.col("dropoff_datetime")).alias("dropoff_date_key"),
        F.hour("dropoff_datetime").alias("dropoff_time_key"),
        F.col("pickup_location_id").alias("pickup_zone_key"),
        F.col("dropoff_location_id").alias("dropoff_zone_key"),
        F.col("vendor_id").alias("vendor_key"),
        F.col("rate_code_id").alias("rate_code_key"),
        F.col("payment_type_id").alias("payment_type_key"),
        "pickup_datetime", "dropoff_datetime", "is_store_and_forward", "has_reversal",
        *MEASURES,
        "_source_file", "_source_period",
    )


def calendar_bounds(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.min("pickup_datetime").cast("date").alias("first_day"),
        F.max("dropoff_datetime").cast("date").alias("last_day"),
    )


def dim_date(silver: DataFrame, words: W.Words = W.SOURCE) -> DataFrame:
    """One row per day from the first pickup to the last dropoff."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return calendar_bounds(silver).select(F.explode(days).alias("full_date")).select(
        C.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        C.pick(F.month(day), words.months).alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        C.pick(weekday, words.weekdays).alias("day_name"),
        F.weekofyear(day).alias("iso_week"),
        (weekday >= 6).alias("is_weekend"),
    )


def dim_time(spark: SparkSession, words: W.Words = W.SOURCE) -> DataFrame:
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("time_key"),
        hour.alias("hour_of_day"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
        C.pick((hour / 6).cast("int") + 1, words.day_periods).alias("day_period"),
    )


def dim_zone(silver_zones: DataFrame) -> DataFrame:
    return silver_zones.select(
        F.col("location_id").alias("zone_key"),
        "borough", "zone_name", "service_zone",
        F.col("service_zone").isin(*AIRPORT_SERVICE).alias("is_airport"),
        "is_identified_zone",
    )


def dim_vendor(vendors: DataFrame) -> DataFrame:
    return vendors.select(F.col("vendor_id").alias("vendor_key"), "vendor_name")


def dim_rate_code(rate_codes: DataFrame) -> DataFrame:
    return rate_codes.select(
        F.col("rate_code_id").alias("rate_code_key"),
        "rate_code_name",
        F.col("rate_code_id").isin(*AIRPORT_RATES).alias("is_airport_rate"),
    )


def dim_payment_type(payment_types: DataFrame, words: W.Words = W.SOURCE) -> DataFrame:
    code = F.col("payment_type_id")
    place = F.when(code.between(0, 2), code + 1).otherwise(4)
    return payment_types.select(
        code.alias("payment_type_key"),
        "payment_type_name",
        C.pick(place, words.payment_groups).alias("payment_group"),
    )


# --- Reports -------------------------------------------------------------------------
#
# Dimensions are joined without a broadcast hint: the optimizer broadcasts a side only
# while its size is under the session's threshold, and shuffles (with skew splitting)
# beyond it. Facts are summed per foreign key before the join where the report allows it.


def without_reversals(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("has_reversal"))


def of_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Fact rows (or sums per day and period) joined to the calendar days of their pickup.

    The fact is stored by the month of its files, and a valid trip begins in that month, so the month of a day
    is a key as well: a calendar that is narrowed down to some days prunes the fact's partitions
    while the query runs.
    """
    day = (fact["pickup_date_key"] == days["date_key"]) & (
        fact["_source_period"] == C.month_start(days["full_date"])
    )
    return fact.join(days, day)


def star_report(fact: DataFrame, zones: DataFrame, times: DataFrame, dates: DataFrame) -> DataFrame:
    """Trips and revenue per pickup borough and day period, working days, no reversed trips.

    `dates` may be narrowed down, to a month for instance; only the fact's partitions of its days are opened.
    """
    per_key = without_reversals(fact).groupBy(
        "_source_period", "pickup_zone_key", "pickup_time_key", "pickup_date_key"
    ).agg(
        F.count("*").alias("n"),
        F.sum("total_amount").alias("revenue"),
        F.sum("trip_distance_miles").alias("miles"),
        F.count("trip_distance_miles").alias("n_miles"),
    )
    return (
        of_days(per_key, dates.filter(~F.col("is_weekend")))
        .join(zones, F.col("pickup_zone_key") == zones.zone_key)
        .join(times, F.col("pickup_time_key") == times.time_key)
        .groupBy("borough", "day_period")
        .agg(
            F.sum("n").alias("trips"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
            F.round(F.sum("miles") / F.sum("n_miles"), 2).cast("decimal(18,2)").alias("mean_miles"),
        )
        .orderBy(F.desc("revenue"), "borough", "day_period")
    )


def flows_between_boroughs(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """The zone dimension in two roles: where a trip starts and where it ends."""
    per_pair = additive(fact, ["pickup_zone_key", "dropoff_zone_key"])
    start = zones.select(F.col("zone_key").alias("start_key"), F.col("borough").alias("pickup_borough"))
    end = zones.select(F.col("zone_key").alias("end_key"), F.col("borough").alias("dropoff_borough"))
    return (
        per_pair.join(start, per_pair.pickup_zone_key == start.start_key)
        .join(end, per_pair.dropoff_zone_key == end.end_key)
        .groupBy("pickup_borough", "dropoff_borough")
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
        )
    )


def additive(fact: DataFrame, by: list[str]) -> DataFrame:
    """Trip count and the sum of every additive measure, per group."""
    sums = [
        F.sum(name).cast("bigint" if name == "passenger_count" else "decimal(38,2)").alias(name)
        for name in MEASURES
    ]
    return fact.groupBy(*by).agg(F.count("*").alias("trips"), *sums)


def derived(fact: DataFrame, by: list[str]) -> DataFrame:
    """Ratios that do not add up: speed, tip share of the fare, mean amount per trip.

    Each is a ratio of sums over the rows where both parts are known.
    """

    def ratio(top: str, bottom: str, factor: int):
        both = F.col(top).isNotNull() & F.col(bottom).isNotNull()
        upper = F.sum(F.when(both, F.col(top)))
        lower = F.sum(F.when(both, F.col(bottom)))
        return F.round(upper * factor / F.nullif(lower, F.lit(0)), 4).cast(SHARE)

    return fact.groupBy(*by).agg(
        ratio("trip_distance_miles", "trip_duration_minutes", 60).alias("miles_per_hour"),
        ratio("tip_amount", "fare_amount", 100).alias("tip_percent"),
        F.round(F.sum("total_amount") / F.count("total_amount"), 4).cast(SHARE).alias("mean_amount"),
    )


def net_revenue(fact: DataFrame, by: list[str], days: DataFrame | None = None) -> DataFrame:
    """Trips and revenue without reversed trips; of `days` alone where a part of the calendar is given."""
    rows = without_reversals(fact)
    if days is not None:
        rows = of_days(rows, days.select("date_key", "full_date"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").cast("decimal(38,2)").alias("revenue"),
    )


def with_trips(dimension: DataFrame, key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    """A dimension with the number of trips that point at each of its rows."""
    counts = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count("*").alias("_trips"))
    return dimension.join(counts, dimension[key] == counts["_key"], "left").select(
        *[dimension[c] for c in dimension.columns],
        F.coalesce("_trips", F.lit(0)).cast("bigint").alias("trips"),
    )
