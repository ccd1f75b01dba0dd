"""Landing directory: which files are wanted, which are there, and how they are read."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline import words as W
from fareline.schemas import (
    RAW_TRIPS, SEEDS, TRIP_FIELDS, TRIP_FILE_PREFIX, TRIP_FILE_SUFFIX, ZONE_FIELDS,
)

# Fixed value: a file this many months young may still be unpublished.
GRACE_MONTHS = 4
FOOTERS_AT_ONCE = 16
LOAD = "LOAD"


def expected_file(period: Column, prefix: str = TRIP_FILE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.date_format(period, "yyyy-MM"), F.lit(TRIP_FILE_SUFFIX))


def months_between(bounds: DataFrame, prefix: str = TRIP_FILE_PREFIX) -> DataFrame:
    """Every month of (first_month, last_month), both included, with its file name.

    A last month before the first one raises.
    """
    months = F.sequence("first_month", "last_month", F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("source_period")).withColumn(
        "source_file", expected_file(F.col("source_period"), prefix)
    )


def requested_periods(
    spark: SparkSession, first: date, last: date, prefix: str = TRIP_FILE_PREFIX
) -> DataFrame:
    if first > last:
        raise ValueError("the first month lies after the last one")
    bounds = spark.createDataFrame([(first, last)], "first_month date, last_month date")
    return months_between(bounds, prefix)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Name, path, size and time of every file in a folder; no content is read."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.regexp_extract("path", "[^/]+$", 0).alias("source_file"),
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def load_verdicts(
    periods: DataFrame,
    found: DataFrame,
    latest: DataFrame,
    present: DataFrame,
    today: date,
    force: bool = False,
) -> DataFrame:
    """What to do with each requested file: LOAD, SKIPPED, NOT_AVAILABLE or FAILED.

    A missing file is only an error when it is older than the grace period. A file is
    skipped when its size and the rows now present equal its latest successful load.
    """
    sizes = found.select("source_file", "size_bytes")
    loads = latest.select("source_file", "logged_size", "logged_rows")
    joined = (
        periods.join(sizes, "source_file", "left")
        .join(loads, "source_file", "left")
        .join(present.select("source_file", "rows_present"), "source_file", "left")
    )
    oldest_late = F.add_months(F.trunc(F.lit(today), "MM"), -GRACE_MONTHS)
    missing = F.col("size_bytes").isNull()
    unchanged = (F.col("logged_size") == F.col("size_bytes")) & (
        F.col("rows_present") == F.col("logged_rows")
    )
    verdict = (
        F.when(missing & (F.col("source_period") >= oldest_late), W.NOT_AVAILABLE)
        .when(missing, W.FAILED)
        .when(F.lit(not force) & F.coalesce(unchanged, F.lit(False)), W.SKIPPED)
        .otherwise(LOAD)
    )
    message = (
        F.when(F.col("verdict") == W.NOT_AVAILABLE, "not published yet")
        .when(F.col("verdict") == W.FAILED, "missing although it is an old month")
        .when(F.col("verdict") == W.SKIPPED, "already loaded, no change")
    )
    return joined.withColumn("verdict", verdict).select(
        "source_period", "source_file", "size_bytes", "verdict",
        F.when(F.col("verdict") == W.SKIPPED, F.col("logged_rows")).alias("rows_loaded"),
        message.alias("message"),
    )


def _bound(file_schema: T.StructType, field: T.StructField) -> Column:
    """The file's column of that name in any case, in the declared type; NULL if absent."""
    match = next((f for f in file_schema.fields if f.name.lower() == field.name.lower()), None)
    if match is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{match.name}`")
    if isinstance(field.dataType, T.LongType) and isinstance(match.dataType, (T.DoubleType, T.FloatType)):
        column = F.round(column)
    return column.cast(field.dataType).alias(field.name)


def footers(spark: SparkSession, paths: list[str]) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """Schema of each readable file, and what is wrong with each other one.

    Footers are read by Spark jobs, many at a time; only schemas reach the driver.
    """

    def one(path: str) -> tuple[str, T.StructType | None, str]:
        try:
            return path, spark.read.parquet(path).schema, ""
        except Exception as error:
            return path, None, str(error)

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        found = list(pool.map(one, paths))
    return {p: s for p, s, _ in found if s is not None}, {p: e for p, s, e in found if s is None}


def read_trip_files(
    spark: SparkSession, paths: list[str], schemas: dict[str, T.StructType] | None = None
) -> DataFrame:
    """Trip files with the declared columns and types plus their lineage.

    Files may differ in column case, in missing or extra columns and in number types, which
    one common read cannot reconcile; files with the same footer schema are read together.
    """
    if schemas is None:
        schemas, broken = footers(spark, paths)
        if broken:
            raise ValueError("; ".join(broken.values()))
    alike = defaultdict(list)
    for path in paths:
        alike[schemas[path].json()].append(path)
    parts = []
    for same in alike.values():
        files = spark.read.schema(schemas[same[0]]).parquet(*same)
        parts.append(
            files.select(
                *[_bound(files.schema, field) for field in TRIP_FIELDS.fields],
                F.col("_metadata.file_name").alias("_source_file"),
                F.col("_metadata.file_modification_time").alias("_file_last_modified"),
                F.current_timestamp().alias("_loaded_at"),
            )
        )
    if not parts:
        return spark.createDataFrame([], RAW_TRIPS)
    return reduce(DataFrame.unionByName, parts)


def read_zone_file(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV: header line skipped, optional quotes, columns bound by position."""
    rows = (
        spark.read.schema(ZONE_FIELDS)
        .option("header", True).option("quote", '"').option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().alias("_loaded_at"),
    )


def seed(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = SEEDS[name]
    return spark.createDataFrame(rows, schema)


def read_seed_file(spark: SparkSession, name: str, path: str) -> DataFrame:
    schema, _ = SEEDS[name]
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"')
        .option("mode", "FAILFAST").csv(path)
    )
