"""Builders of small trip tables."""

from datetime import date, datetime

from fareline.functions import columns as C
from fareline.schemas import RAW_TRIPS
from pyspark.sql import functions as F

GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2025, 1, 10, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 1, 10, 8, 10, 0),
    "passenger_count": 1,
    "trip_distance": 2.5,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
    "_source_file": "yellow_tripdata_2025-01.parquet",
    "_file_last_modified": datetime(2025, 3, 1),
    "_loaded_at": datetime(2025, 3, 2),
}


def raw(spark, *changes):
    """One trip per dict of changes against a good trip."""
    rows = [tuple({**GOOD, **c}[name] for name in RAW_TRIPS.names) for c in changes]
    return spark.createDataFrame(rows, RAW_TRIPS)


def bronze(spark, *changes):
    return raw(spark, *changes).withColumn("_source_period", C.file_period(F.col("_source_file")))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


JANUARY = date(2025, 1, 1)
