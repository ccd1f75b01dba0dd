"""Bronze: source columns unchanged, plus lineage; refreshed by file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions import columns as C
from fareline.schemas import TRIP_COLUMNS

LINEAGE = ["_source_file", "_source_period", "_file_last_modified", "_loaded_at"]

def bronze_trips(raw: DataFrame) -> DataFrame:
    """The 20 source columns as they came, their lineage, and the time of writing."""
    return raw.select(
        *[F.col(name).alias(name) for name in TRIP_COLUMNS],
        "_source_file",
        C.file_period(F.col("_source_file")).alias("_source_period"),
        "_file_last_modified",
        "_loaded_at",
        F.current_timestamp().alias("_bronze_loaded_at"),
    )


def bronze_zones(raw_zones: DataFrame) -> DataFrame:
    names = ["locationid", "borough", "zone", "service_zone"]
    return raw_zones.select(
        *[F.col(name).alias(name) for name in names],
        "_source_file",
        "_loaded_at",
        F.current_timestamp().alias("_bronze_loaded_at"),
    )


def newest_loads(rows: DataFrame) -> DataFrame:
    """source_file, newest: the microsecond of the newest load of each file."""
    return rows.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.unix_micros(F.max("_loaded_at")).alias("newest")
    )


def changed_marks(landed: DataFrame, kept: DataFrame) -> DataFrame:
    """source_file of the files whose newest load is not the target's; one row per file.

    Both sides hold source_file and newest, as `newest_loads` or a table's manifest gives them.
    The mark is kept per file: if a refresh dies after some of its files, the others are
    still behind and are found by the next one. `gone` marks files without rows in `landed`.
    """
    marks = landed.select("source_file", F.col("newest").alias("landed")).join(
        kept.select("source_file", F.col("newest").alias("kept")), "source_file", "full"
    )
    gone = F.col("landed").isNull()
    return marks.filter(gone | F.col("kept").isNull() | (F.col("landed") > F.col("kept"))).select(
        "source_file", gone.alias("gone")
    )


def changed_files(raw: DataFrame, target: DataFrame) -> DataFrame:
    """The same of two tables' rows: _source_file and gone."""
    return changed_marks(newest_loads(raw), newest_loads(target)).withColumnRenamed("source_file", "_source_file")


def newer_rows(raw: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of the files that were loaded again after the target took them, or never taken."""
    return raw.join(changed_files(raw, target), "_source_file", "left_semi")
