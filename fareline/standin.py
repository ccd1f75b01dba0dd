"""Trip, zone and ledger tables derived by Spark from the benchmark tables.

Every value is a fixed arithmetic function of lineitem, orders and region, so the same
rows can be derived in SQL; see FIXTURES.md for what each column is meant to exercise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import words as W

FILE_PREFIX = "trips_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(units: Column) -> Column:
    return units.cast("double") / F.lit(100.0)


def raw_trips(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Trips as they would sit in the landing table.

    `by_month` brings the rows of a file's month together, before most columns are derived: what is
    exchanged are the few columns that all others follow from. A month that is too large for one
    task is split.
    """
    # One scan: copies and reversals are extra array elements, not extra scans.
    signs = F.expr(
        "case l_partkey % 499 when 7 then array(1, 1) when 8 then array(1, -1) else array(1) end"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", F.explode(signs).alias("sgn"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    src = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("h"),
        F.round("l_extendedprice").cast("bigint").alias("cents"),
        "l_partkey", "l_quantity", "sgn", "o_orderdate",
        (
            (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") < 10)
        ).alias("neg"),
    )
    src = src.withColumn(
        "file_month",
        F.trunc(
            F.when(F.col("l_partkey") % 211 == 0, F.add_months("o_orderdate", 1)).otherwise(F.to_date("o_orderdate")),
            "MM",
        ),
    )
    if by_month:
        src = src.hint("rebalance", "file_month")
    h, cents, part, sgn = F.col("h"), F.col("cents"), F.col("l_partkey"), F.col("sgn")
    flex = h % 5 == 0  # rows that leave several columns out
    src = src.withColumn(
        "dur",
        F.when(h % 97 == 0, 0).when(h % 101 == 0, -60).when(h % 499 == 0, 90000)
        .otherwise(60 + (h * 13) % 5400),
    ).withColumn("pickup", F.expr("timestampadd(SECOND, cast((h * 97) % 86400 as int), o_orderdate)"))

    def unless_flex(value: Column) -> Column:
        return F.when(~flex, value)

    return src.select(
        F.element_at(F.array(*[F.lit(v) for v in (1, 2, 6, 7)]), (h % 4 + 1).cast("int")).cast("bigint").alias("vendorid"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, cast(dur as int), pickup)").alias("tpep_dropoff_datetime"),
        unless_flex(h % 9).alias("passenger_count"),
        _hundredths(
            F.when((h % 61 == 0) | (h % 194 == 0), 0).when(h % 997 == 0, 25000).otherwise(part % 2000 + 1)
        ).alias("trip_distance"),
        unless_flex(F.when(h % 7 == 0, 99).otherwise(h % 6 + 1)).cast("bigint").alias("ratecodeid"),
        unless_flex(F.when(h % 3 == 0, "Y").otherwise(" n ")).alias("store_and_fwd_flag"),
        (h % 265 + 1).alias("pulocationid"),
        ((h * 3) % 265 + 1).alias("dolocationid"),
        F.when(flex, 0).otherwise(h % 4 + 1).cast("bigint").alias("payment_type"),
        _hundredths(
            sgn * F.when(F.col("neg") | (F.col("l_quantity") == 50), -1).otherwise(1) * F.expr("cents div 2")
        ).alias("fare_amount"),
        _hundredths((h % 4) * 50).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        _hundredths(F.when(~flex & (h % 4 == 0), F.expr("cents div 10")).otherwise(0)).alias("tip_amount"),
        F.when(h % 20 == 1, 6.94).otherwise(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        _hundredths(sgn * F.when(F.col("neg"), -1).otherwise(1) * cents).alias("total_amount"),
        unless_flex(F.lit(2.5)).alias("congestion_surcharge"),
        unless_flex(F.when(h % 11 == 0, 1.75).otherwise(0.0)).alias("airport_fee"),
        F.lit(0.75).alias("cbd_congestion_fee"),
        F.concat(F.lit(FILE_PREFIX), F.date_format("file_month", "yyyy-MM"), F.lit(".parquet")).alias("_source_file"),
        F.date_add("file_month", 35).cast("timestamp").alias("_file_last_modified"),
        F.date_add("file_month", 40).cast("timestamp").alias("_loaded_at"),
    )


def with_odd_ties(trips: DataFrame) -> DataFrame:
    """The trips and copies of some that tie in all but the columns a key drops or lacks.

    Every 7th pickup zone again a fifth of a second later (the same key); every 11th without
    vendor (no key), once as it was and once three hours later.
    """
    zone, start, end = F.col("pulocationid"), "tpep_pickup_datetime", "tpep_dropoff_datetime"

    def later(rows: DataFrame, unit: str, n: int) -> DataFrame:
        return rows.withColumns({c: F.expr(f"timestampadd({unit}, {n}, {c})") for c in (start, end)})

    soon = later(trips.filter(zone % 7 == 0), "MILLISECOND", 200)
    keyless = trips.filter(zone % 11 == 0).withColumn("vendorid", F.lit(None).cast("bigint"))
    return trips.unionByName(soon).unionByName(keyless).unionByName(later(keyless, "HOUR", 3))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone list with the blanks the two special ids come with."""
    region = table(spark, sf_dir, "region")
    ids = spark.range(1, 266)
    i = F.col("id")
    return ids.join(region, i % 5 == region.r_regionkey).select(
        i.alias("locationid"),
        F.when(i == 265, "").when(i == 264, " ").otherwise(F.col("r_name")).alias("borough"),
        F.when(i == 265, "").when(i < 264, F.concat(F.lit(" Zone "), i.cast("string"))).alias("zone"),
        F.when(i >= 264, "").when(i % 40 == 0, "Airports").when(i == 1, "EWR")
        .when(i % 2 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"),
        F.lit("taxi_zone_lookup.csv").alias("_source_file"),
        F.lit("2001-12-15").cast("timestamp").alias("_loaded_at"),
    )


def partial_zones(zones: DataFrame, column: str = "locationid") -> DataFrame:
    """The same list with some ids left out, for orphan checks."""
    return zones.filter(F.col(column) % 53 != 0)


def rows_per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("_source_file").agg(F.count("*").alias("rows"))


def ledger(raw: DataFrame, prefix: str = FILE_PREFIX) -> DataFrame:
    """Load history over the files of `raw`: one current load each, some older, some failed."""
    files = rows_per_file(raw).withColumn(
        "period", F.to_date(F.concat(F.substring("_source_file", len(prefix) + 1, 7), F.lit("-01")))
    )
    month = F.month("period")

    def attempt(status: str, fewer: int, day: int) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(fewer).alias("fewer"), F.lit(day).alias("day"))

    attempts = F.array(
        attempt(W.LOADED, 0, 41),
        F.when(month % 2 == 0, attempt(W.LOADED, 1, 31)),
        F.when(month % 5 == 0, attempt(W.FAILED, 0, 51)),
    )
    tries = files.select("*", F.explode(F.filter(attempts, lambda a: a.isNotNull())).alias("a"))
    done = F.date_add("period", F.col("a.day")).cast("timestamp")
    loaded = F.col("a.status") == W.LOADED
    return tries.select(
        F.col("_source_file").alias("source_file"),
        F.col("period").alias("source_period"),
        F.concat(F.lit("landing/"), "_source_file").alias("source_url"),
        F.col("a.status").alias("status"),
        F.when(loaded, F.col("rows") - F.col("a.fewer")).alias("rows_loaded"),
        (F.col("rows") * 100).alias("file_size_bytes"),
        done.alias("started_at"),
        done.alias("finished_at"),
        F.when(loaded, "ok").otherwise(F.repeat(F.lit("x"), 1200)).alias("message"),
    )


def inventory(raw: DataFrame) -> DataFrame:
    """Files found in the landing directory; March files changed their size."""
    files = rows_per_file(raw)
    march = F.col("_source_file").contains("-03.")
    return files.select(
        F.col("_source_file").alias("source_file"),
        (F.col("rows") * 100 + F.when(march, 1).otherwise(0)).alias("size_bytes"),
    )


def present_rows(raw: DataFrame) -> DataFrame:
    """Rows now in the landing table per file; June files lost one."""
    files = rows_per_file(raw)
    june = F.col("_source_file").contains("-06.")
    return files.select(
        F.col("_source_file").alias("source_file"),
        (F.col("rows") - F.when(june, 1).otherwise(0)).alias("rows_present"),
    )
