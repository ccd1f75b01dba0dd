"""The load ledger: one row per attempt to load one file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareline import words as W
from fareline.schemas import LEDGER, ZONE_FILE


def entries(spark: SparkSession, rows: Iterable[Row | tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), LEDGER)


def latest_loads(ledger: DataFrame) -> DataFrame:
    """Size and rows of the newest successful load of each file.

    An aggregate instead of a window: attempts are combined before the shuffle.
    """
    newest = F.struct(F.col("finished_at").isNull(), "finished_at", "file_size_bytes", "rows_loaded")
    return (
        ledger.filter(F.col("status") == W.LOADED)
        .groupBy("source_file")
        .agg(F.max_by(F.struct("file_size_bytes", "rows_loaded"), newest).alias("load"))
        .select(
            "source_file",
            F.col("load.file_size_bytes").alias("logged_size"),
            F.col("load.rows_loaded").alias("logged_rows"),
        )
    )


def listing(ledger: DataFrame) -> DataFrame:
    """Attempts, newest first."""
    return ledger.orderBy(F.desc_nulls_first("finished_at"), "source_file", "status").select(
        "source_file", "status", "rows_loaded", "message", "finished_at"
    )


def run_lines(results: DataFrame) -> DataFrame:
    """One line per file of a run."""
    return results.select("source_file", "status", "rows_loaded", "message").orderBy("source_file")


def run_total(results: DataFrame, zone_file: str = ZONE_FILE) -> DataFrame:
    """Trip rows now present for the files of a run: loaded or skipped, without the zone list."""
    counted = F.col("status").isin(W.LOADED, W.SKIPPED) & (F.col("source_file") != zone_file)
    return results.filter(counted).agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("trip_rows")
    )
