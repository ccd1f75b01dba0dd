"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Layers are wide rows: a task that reads or gathers this much sorts it in memory when it writes.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    # What a query has shuffled goes when it ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Wide projections generate methods the JVM would never compile; let Spark split them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "fareline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Stored (compressed) bytes one shuffle task should handle, and a limit on their number
# that keeps the shuffle's own bookkeeping small. Beyond MOST_PARTITIONS * BYTES_PER_PARTITION,
# about 25 TB, tasks grow past 256 MB and spill; pass a larger `most` if the cluster bears it.
BYTES_PER_PARTITION = 256 << 20
MOST_PARTITIONS = 100_000


def shuffle_partitions(stored_bytes: int, configured: int, most: int = MOST_PARTITIONS) -> int:
    """Partitions for a shuffle of a whole table; adaptive execution merges small ones."""
    return max(configured, min(most, math.ceil(stored_bytes / BYTES_PER_PARTITION)))


@contextmanager
def sized_for(spark: SparkSession, stored_bytes: int, most: int = MOST_PARTITIONS) -> Iterator[None]:
    """Raise the number of shuffle partitions to fit a table, for the steps inside."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(shuffle_partitions(stored_bytes, int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


# What a task gathers of rows that are widened afterwards: a row of the landing table takes some twenty times
# the bytes of the few columns it is derived from, and a task sorts them when it writes by file.
NARROW_BYTES = 8 << 20


@contextmanager
def gathering(spark: SparkSession, size: int = NARROW_BYTES) -> Iterator[None]:
    """Let tasks gather at most `size` exchanged bytes, for the steps inside."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(size))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in `spark.checkpoint.dir`.

    Only where the session names none (a local test) a temporary folder takes its place.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="fareline-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
