"""The stored layers by table name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.schemas import CHECK_RESULTS, LEDGER, RAW_TRIPS, TABLES, Layout
from fareline.sources import tables

REJECTED = "silver_yellow_trips_rejected"
EVALUATED = "silver_yellow_trips_evaluated"
# Tables that grow by part or by append: read by declared schema, empty until written.
GROWING = {"yellow_trips": RAW_TRIPS, "check_results": CHECK_RESULTS}
LOGS = {"ingestion_log": LEDGER}


class Store:
    """Reads and writes the tables below one root directory.

    `elsewhere` gives the path of tables that lie outside of it, such as a landing table that
    several stores share.
    """

    def __init__(self, spark: SparkSession, root: str, elsewhere: dict[str, str] | None = None):
        self.spark = spark
        self.layout = Layout(root)
        self.elsewhere = elsewhere or {}

    def path(self, table: str) -> str:
        return self.elsewhere.get(table) or self.layout.path(table)

    def has(self, table: str) -> bool:
        if table in LOGS:
            return tables.folder_exists(self.spark, self.path(table))
        return tables.exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        if table == REJECTED:
            return self._evaluated(rejected=True)
        if table == EVALUATED:
            return self._evaluated()
        if table in LOGS and self.has(table):
            return self.spark.read.schema(LOGS[table]).parquet(self.path(table))
        if table in GROWING or table in LOGS:
            return tables.read(self.spark, self.path(table), {**GROWING, **LOGS}[table])
        return tables.read(self.spark, self.path(table))

    def write(
        self, table: str, df: DataFrame, partition_by: str | None = None, observed: dict[str, Column] | None = None
    ) -> None:
        tables.overwrite(df, self.path(table), partition_by, observed=observed)

    def figures(self, table: str) -> dict:
        """What was counted when the table was written."""
        return tables.figures(self.spark, self.path(EVALUATED if table == REJECTED else table))

    def part_rows(self, table: str) -> dict[str, int]:
        """Rows of every file of a table that is kept by file."""
        found = tables.current(self.spark, self.path(table))
        return {part.value: part.figures["rows"] for part in found.parts} if found else {}

    def write_evaluated(self, evaluated: DataFrame, observed: dict[str, Column] | None = None) -> None:
        """Valid and rejected rows, and those of different months, go to different partitions.

        Each reader opens only its own. The evaluation leaves rows in the order of their pickups, so a
        task has few months; they are not exchanged again.
        """
        tables.overwrite(
            evaluated.withColumn("_rejected", F.col("rejection_reason").isNotNull()),
            self.path(EVALUATED),
            partition_by=["_rejected", "_source_period"],
            observed=observed,
        )

    def accepted(self) -> DataFrame:
        return self._evaluated(rejected=False)

    def _evaluated(self, rejected: bool | None = None) -> DataFrame:
        rows = tables.read(self.spark, self.path(EVALUATED))
        if rejected is not None:
            rows = rows.filter(F.col("_rejected") == rejected)
        return rows.drop("_rejected")

    def vacuum(self) -> None:
        """Drop the versions of all tables that no recent manifest names."""
        for table in TABLES:
            if table not in LOGS and table not in self.elsewhere:
                tables.vacuum(self.spark, self.path(table))

    def register_views(self) -> None:
        """Temp views under the table names, for SQL reports over the finished layers."""
        for table in [*TABLES, REJECTED]:
            stored = EVALUATED if table == REJECTED else table
            if self.has(stored):
                self.read(table).createOrReplaceTempView(table)
