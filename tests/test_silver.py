"""Typing, key, rules, deduplication and repairs on hand-made rows and on the stand-in."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import SF
from helpers import GOOD, bronze, rows
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from fareline import standin
from fareline.functions import columns as C
from fareline.operators import silver, skew
from fareline.words import ENGLISH, SOURCE

START = GOOD["tpep_pickup_datetime"]


CASES = [
    ({}, None),
    ({"total_amount": -1.0, "fare_amount": -1.0}, "negative_total"),
    ({"total_amount": -1.0, "trip_distance": 900.0}, "negative_total"),  # the first rule wins
    ({"fare_amount": -1.0}, "negative_fare"),
    ({"tpep_dropoff_datetime": START - timedelta(seconds=1)}, "dropoff_before_pickup"),
    ({"tpep_dropoff_datetime": START + timedelta(hours=24)}, None),
    ({"tpep_dropoff_datetime": START + timedelta(hours=24, seconds=30)}, "over_24h"),
    ({"_source_file": "yellow_tripdata_2025-02.parquet"}, "outside_period"),
    ({"tpep_dropoff_datetime": START, "trip_distance": 0.004}, "no_movement"),
    ({"tpep_dropoff_datetime": START, "trip_distance": 0.01}, None),
    ({"trip_distance": 200.0}, None),
    ({"trip_distance": 200.01}, "distance_over_200"),
    ({"total_amount": 1000.01}, "total_over_1000"),
    ({"trip_distance": -1.0}, None),
    ({"total_amount": None}, None),
    ({"VendorID": 42}, None),
]


def test_first_broken_rule(spark):
    # One destination per case keeps the trips apart.
    data = bronze(spark, *[{"DOLocationID": i, **change} for i, (change, _) in enumerate(CASES)])
    judged = rows(silver.evaluate(data, ENGLISH), "dropoff_location_id", "rejection_reason")
    assert dict(judged) == {i: expected for i, (_, expected) in enumerate(CASES)}


def test_stored_words_by_default(spark):
    got = silver.evaluate(bronze(spark, {"fare_amount": -1.0})).first()["rejection_reason"]
    assert got == SOURCE.negative_fare == "tarifa_negativa"


def test_seconds_and_minutes_count_marks(spark):
    df = spark.sql(
        "select timestamp_ntz'2025-01-01 00:00:00.9' a, timestamp_ntz'2025-01-01 00:00:02.1' b,"
        " timestamp_ntz'2025-01-01 00:00:59' c, timestamp_ntz'2025-01-01 00:02:01' d"
    ).select(
        C.seconds_between(F.col("a"), F.col("b")), C.minutes_between(F.col("c"), F.col("d"))
    )
    assert tuple(df.first()) == (2, 2)


def test_flag_decoding(spark):
    flags = ["Y", " y ", "n", "N ", "X", "", None]
    df = spark.createDataFrame([(f,) for f in flags], "f string").select(C.yes_no(F.col("f")).alias("v"))
    assert [r.v for r in df.collect()] == [True, True, False, False, None, None, None]


def test_key_is_null_when_a_part_is_null(spark):
    keyed = silver.with_key(silver.typed(bronze(spark, {}, {"VendorID": None})))
    assert sorted((r.vendor_id is None, r.trip_id is None) for r in keyed.collect()) == [
        (False, False), (True, True),
    ]


def test_key_drops_fractions_of_seconds(spark):
    keyed = silver.with_key(
        silver.typed(bronze(spark, {}, {"tpep_pickup_datetime": START + timedelta(milliseconds=5)}))
    )
    assert keyed.select("trip_id").distinct().count() == 1


def test_file_period(spark):
    names = ["yellow_tripdata_2025-03.parquet", "no_month.parquet", "a_2024-12_2025-01.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(C.file_period(F.col("n")).alias("p"))
    assert [str(r.p) for r in df.collect()] == ["2025-03-01", "None", "2024-12-01"]


def test_impossible_month_raises(spark):
    df = spark.createDataFrame([("x_2025-13.parquet",)], "n string").select(C.file_period(F.col("n")))
    with pytest.raises(Exception):
        df.collect()


def test_money_is_rounded_half_up(spark):
    typed = silver.typed(bronze(spark, {"fare_amount": 1.005, "tip_amount": 0.145}))
    assert rows(typed, "fare_amount", "tip_amount") == [(Decimal("1.01"), Decimal("0.15"))]


# Groups of rows of one trip, and what becomes of them: (total, reason, reversal flag, tip).
GROUPS = {
    "highest total stays": (
        [{"total_amount": 10.0}, {"total_amount": 12.0}, {"total_amount": 11.0}],
        [(10.0, "duplicate", False, 2.0), (11.0, "duplicate", False, 2.0), (12.0, None, False, 2.0)],
    ),
    "latest load breaks the tie": (
        [{}, {"_loaded_at": datetime(2025, 4, 1), "tip_amount": 9.0}],
        [(14.0, "duplicate", False, 2.0), (14.0, None, False, 9.0)],
    ),
    "invalid rows do not displace valid ones": (
        [{"total_amount": 5000.0}, {"total_amount": 10.0}],
        [(10.0, None, False, 2.0), (5000.0, "total_over_1000", False, 2.0)],
    ),
    "a reversal marks the whole trip": (
        [{}, {"total_amount": -14.0, "fare_amount": -10.0}],
        [(-14.0, "negative_total", True, 2.0), (14.0, None, True, 2.0)],
    ),
    "exact copies leave one": (
        [{}] * 5,
        [(14.0, "duplicate", False, 2.0)] * 4 + [(14.0, None, False, 2.0)],
    ),
    "a missing total ranks first": (
        [{"total_amount": None}, {"total_amount": 3.0}],
        [(3.0, "duplicate", False, 2.0), (None, None, False, 2.0)],
    ),
    "rows without a key form one group": (
        [
            {"VendorID": None, "total_amount": 1.0},
            {"tpep_pickup_datetime": None, "total_amount": 2.0},
            {"VendorID": None, "total_amount": -3.0},
        ],
        [(-3.0, "negative_total", True, 2.0), (1.0, "duplicate", True, 2.0), (2.0, None, True, 2.0)],
    ),
}


def test_duplicates(spark):
    changes = [
        {"DOLocationID": i, **change} for i, (group, _) in enumerate(GROUPS.values()) for change in group
    ]
    judged = silver.evaluate(bronze(spark, *changes), ENGLISH).collect()
    for i, (name, (_, expected)) in enumerate(GROUPS.items()):
        got = [
            (r.total_amount if r.total_amount is None else float(r.total_amount), r.rejection_reason,
             r.has_reversal, float(r.tip_amount))
            for r in judged if r.dropoff_location_id == i
        ]
        assert sorted(got, key=repr) == sorted(expected, key=repr), name


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Stand-in trips plus copies, so that one trip and the trips without key are large."""
    trips = standin.raw_trips(spark, SF).withColumn(
        "_source_period", C.file_period(F.col("_source_file"))
    )
    one = trips.filter("total_amount > 100").orderBy("_source_file", "total_amount", "pulocationid").limit(1)
    many = one.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(900))))
    varied = many.withColumn("total_amount", F.floor(F.col("i") / 9).cast("double")).drop("i")
    keyless = trips.filter("pulocationid % 3 = 0").withColumn("vendorid", F.lit(None).cast("bigint"))
    path = str(tmp_path_factory.mktemp("skewed") / "trips")
    trips.unionByName(many.drop("i")).unionByName(varied).unionByName(keyless).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def test_aggregates_equal_a_window_over_whole_trips(skewed):
    """The plain way: sort all rows of a trip, valid ones first, and keep the first."""
    trip = Win.partitionBy("trip_id").orderBy(F.col("broken_rule").isNotNull(), *silver.keep_order())
    whole = trip.rowsBetween(Win.unboundedPreceding, Win.unboundedFollowing)
    plain = silver.with_reason(
        silver.prepared(skewed, ENGLISH).withColumns(
            {
                "has_reversal": F.max(F.coalesce(F.col("total_amount") < 0, F.lit(False))).over(whole),
                "is_repeat": F.col("broken_rule").isNull() & (F.row_number().over(trip) > 1),
            }
        ),
        ENGLISH,
    ).select(silver.EVALUATED_COLUMNS)
    found = silver.evaluate(skewed, ENGLISH)
    assert plain.exceptAll(found).isEmpty() and found.exceptAll(plain).isEmpty()
    assert silver.hot_trips(silver.prepared(skewed), 20).count() > 1


def test_ten_million_rows_of_one_trip(spark):
    """Copies and near copies of one trip, dealt out over all tasks; no task gathers them."""
    one = silver.prepared(bronze(spark, {}), ENGLISH)
    many = one.crossJoin(spark.range(0, 10_000_000, 1, 8)).withColumn(
        "total_amount", F.when(F.col("id") % 1000 == 0, None).otherwise((F.col("id") % 997).cast("decimal(18,2)"))
    ).withColumn("tip_amount", (F.col("id") % 7).cast("decimal(18,2)")).drop("id")
    reversed_ = one.withColumns({"total_amount": F.lit(-1).cast("decimal(18,2)"), "broken_rule": F.lit("negative_total")})
    judged = silver.with_duplicates(many.unionByName(reversed_))
    kept = judged.groupBy("has_reversal", "is_repeat").agg(
        F.count("*").alias("n"), F.count("total_amount").alias("known"), F.min("tip_amount").alias("tip")
    )
    assert rows(kept, "has_reversal", "is_repeat", "n") == [(True, False, 2), (True, True, 9_999_999)]
    # A missing total ranks first; of those the smallest tip.
    valid = judged.filter("not is_repeat and broken_rule is null")
    assert [(r.total_amount, r.tip_amount) for r in valid.collect()] == [(None, Decimal("0.00"))]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_whole_rows_are_exchanged_once(spark, tmp_path):
    """Trips with a key are ranked where the one exchange brings them, without steps on disk."""
    data = silver.prepared(bronze(spark, {}, {"total_amount": 3.0}, {"VendorID": 2}), ENGLISH)
    judged = silver.with_duplicates(data, str(tmp_path / "steps"))
    assert exchanges(judged) == 1 and not (tmp_path / "steps").exists()
    assert exchanges(silver.dedup_rank(data)) == 1
    assert rows(judged, "vendor_id", "total_amount", "is_repeat") == [
        (1, Decimal("14.00"), False), (1, Decimal("3.00"), True), (2, Decimal("14.00"), False),
    ]


def test_the_exchange_leaves_out_what_follows_from_the_rest(spark):
    data = silver.prepared(bronze(spark, {}, {"total_amount": -3.0}), ENGLISH)
    assert "trip_id" not in silver.gathered(data).columns
    flags = silver.with_duplicates(data).select("trip_id", "total_amount", "has_reversal")
    plan = flags._jdf.queryExecution().optimizedPlan().toString()
    assert "tip_amount" not in plan.split("RepartitionByExpression")[1].split("Project")[1].splitlines()[0]
    assert {r.trip_id for r in flags.collect()} == {data.first().trip_id}
    assert rows(flags, "has_reversal") == [(True,), (True,)]


def test_trips_brought_together_by_month_are_the_same(spark):
    plain, together = standin.raw_trips(spark, SF), standin.raw_trips(spark, SF, by_month=True)
    assert plain.exceptAll(together).isEmpty() and together.exceptAll(plain).isEmpty()
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert "tip_amount" not in plan.split("RebalancePartitions")[1]


def test_buckets_follow_the_rows(spark):
    assert skew.buckets_for(10**12, skew.HOT_ROWS) * skew.HOT_ROWS >= 16 * 10**12
    rows_ = spark.createDataFrame([(k % 40, k % 40) for k in range(400)] + [(99, 99)] * 50 + [(None, None)] * 30, "a int, b int")
    keyed = rows_.withColumn("key", F.col("a").cast("string"))
    hot = skew.hot_keys(keyed, "key", [F.col("b")], 20)
    assert sorted((r.key for r in hot.collect()), key=str) == ["99", None]


def test_rank_by_counting_equals_window_rank(skewed):
    prepared = silver.prepared(skewed, ENGLISH)
    plain = silver.dedup_rank(prepared)
    hot = silver.dedup_rank(prepared, hot_rows=20)
    assert plain.exceptAll(hot).isEmpty() and hot.exceptAll(plain).isEmpty()


TIES = [
    {"VendorID": None, "tpep_pickup_datetime": datetime(2025, 1, 10, hour), "tpep_dropoff_datetime": datetime(2025, 1, 10, hour, 9)}
    for hour in (13, 10, 17)
] + [
    {"tpep_pickup_datetime": START + timedelta(milliseconds=m)} for m in (200, 100, 900)
] + [{"VendorID": None, "PULocationID": p} for p in (7, 5, 6)]


def test_ties_do_not_depend_on_input_order_or_path(spark):
    """Rows without a key, and rows of one key that differ in fractions of a second."""
    seen = set()
    for order in (TIES, TIES[::-1], TIES[4:] + TIES[:4]):
        for hot_rows in (silver.HOT_ROWS, 1):
            data = bronze(spark, *order).repartition(3)
            ranked = silver.dedup_rank(silver.prepared(data), hot_rows)
            judged = silver.evaluate(data, ENGLISH).drop("_loaded_at")
            seen.add((
                tuple(rows(ranked, "vendor_id", "pickup_datetime", "pickup_location_id", "dedup_rank")),
                tuple(rows(judged, *judged.columns)),
            ))
    assert len(seen) == 1


def test_the_order_has_every_column(spark):
    """What the order leaves out follows from what it has."""
    derived = {"trip_id", "broken_rule"}
    columns = set(silver.prepared(bronze(spark, {})).columns)
    assert columns - derived == {*silver.KEEP_FIRST, *silver.KEEP_THEN}


def test_copies_are_written_out_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(silver, "COPIES_PER_TASK", 4)
    prepared = silver.prepared(bronze(spark, *[{}] * 11), ENGLISH)
    got = silver.dedup_rank(prepared, hot_rows=1).select("dedup_rank").collect()
    assert sorted(r.dedup_rank for r in got) == list(range(1, 12))


def test_repairs(spark):
    evaluated = silver.evaluate(
        bronze(
            spark,
            {"VendorID": 1, "passenger_count": 0, "trip_distance": 0.0, "RatecodeID": None},
            {"VendorID": 2, "passenger_count": 7, "tpep_dropoff_datetime": START},
            {"VendorID": 6, "passenger_count": 6, "tpep_dropoff_datetime": START + timedelta(seconds=100)},
        )
    )
    got = rows(
        silver.silver_trips(evaluated),
        "vendor_id", "passenger_count", "trip_distance_miles", "rate_code_id", "trip_duration_minutes",
    )
    assert got == [
        (1, None, None, 99, Decimal("10.00")),
        (2, None, Decimal("2.50"), 1, None),
        (6, 6, Decimal("2.50"), 1, Decimal("1.67")),
    ]


def test_zone_labels(spark):
    zones = spark.createDataFrame(
        [
            (1, " EWR ", "Newark", "EWR"), (264, " ", None, ""), (265, "", "", " "), (7, "N/A", None, "N/A"),
        ],
        "locationid bigint, borough string, zone string, service_zone string",
    ).withColumns({"_source_file": F.lit("z"), "_loaded_at": F.current_timestamp()})
    got = rows(
        silver.silver_zones(zones), "location_id", "borough", "zone_name", "service_zone", "is_identified_zone"
    )
    assert got == [
        (1, "EWR", "Newark", "EWR", True),
        (264, "Unknown", "Unknown", "N/A", False),
        (265, "Outside of NYC", "Outside of NYC", "N/A", False),
        (7, "N/A", "Unknown", "N/A", True),
    ]


def test_rejections_most_frequent_first(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "rejection_reason string")
    assert [tuple(r) for r in silver.rejections_by_reason(df).collect()] == [("b", 2), ("a", 1)]


def test_standin_outcomes(spark):
    trips = standin.raw_trips(spark, SF).withColumn("_source_period", C.file_period(F.col("_source_file")))
    counts = silver.evaluate(trips, ENGLISH).groupBy("rejection_reason").count()
    assert {r["rejection_reason"]: r["count"] for r in counts.collect()} == {
        None: 4150, "duplicate": 1165, "total_over_1000": 271, "negative_total": 205,
        "negative_fare": 125, "dropoff_before_pickup": 63, "outside_period": 36,
        "no_movement": 30, "over_24h": 17, "distance_over_200": 6,
    }
