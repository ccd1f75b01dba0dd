"""Declared schemas of the landing and ledger tables, seeds, and where tables live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Source columns of a trip file; files bind to them by name, ignoring case.
TRIP_FIELDS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)
TRIP_COLUMNS = [name.lower() for name in TRIP_FIELDS.names]

# A zone file binds by position; the names are ours.
ZONE_FIELDS = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

RAW_TRIPS = T.StructType(
    TRIP_FIELDS.fields
    + [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_file_last_modified", T.TimestampType()),
        T.StructField("_loaded_at", T.TimestampType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("source_period", T.DateType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("message", T.StringType()),
    ]
)

CHECK_RESULTS = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("offenders", T.LongType()),
        T.StructField("layer", T.StringType()),
    ]
)

# The three code lists of the data dictionary.
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
SEEDS = {
    "ref_vendors": ("vendor_id int, vendor_name string", VENDORS),
    "ref_rate_codes": ("rate_code_id int, rate_code_name string", RATE_CODES),
    "ref_payment_types": ("payment_type_id int, payment_type_name string", PAYMENT_TYPES),
}

# Names of the monthly trip files and of the zone file.
TRIP_FILE_PREFIX = "yellow_tripdata_"
TRIP_FILE_SUFFIX = ".parquet"
ZONE_FILE = "taxi_zone_lookup.csv"

# Layer and name of every stored table.
TABLES = {
    "yellow_trips": "raw",
    "taxi_zones": "raw",
    "ingestion_log": "raw",
    "bronze_yellow_trips": "bronze",
    "bronze_taxi_zones": "bronze",
    "ref_vendors": "silver",
    "ref_rate_codes": "silver",
    "ref_payment_types": "silver",
    "silver_yellow_trips_evaluated": "silver",
    "silver_yellow_trips": "silver",
    "silver_taxi_zones": "silver",
    "fct_trips": "gold",
    "dim_date": "gold",
    "dim_time": "gold",
    "dim_zone": "gold",
    "dim_vendor": "gold",
    "dim_rate_code": "gold",
    "dim_payment_type": "gold",
    "check_results": "quality",
}


@dataclass(frozen=True)
class Layout:
    """Directory of each table: <root>/<layer>/<table>."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{TABLES[table]}/{table}"
