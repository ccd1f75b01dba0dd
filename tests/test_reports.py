"""Gold, checks, profiles and the grouped median."""

import math
import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import SF
from helpers import GOOD, bronze, rows
from pyspark.sql import functions as F

from fareline import session, standin
from fareline.functions.medians import digits, grouped_median
from fareline.operators import bronze as bronze_layer
from fareline.operators import gold, profile, quality, silver
from fareline.sources import tables
from fareline.words import ENGLISH, SOURCE

START = GOOD["tpep_pickup_datetime"]


def trips(spark, *changes):
    return silver.silver_trips(silver.evaluate(bronze(spark, *changes)))


def apart(i):
    """A change that makes a trip of its own."""
    return {"tpep_pickup_datetime": START + timedelta(days=i), "tpep_dropoff_datetime": START + timedelta(days=i, minutes=10)}


def test_calendar_covers_first_pickup_to_last_dropoff(spark):
    late = {
        "tpep_pickup_datetime": datetime(2025, 1, 31, 23, 50), "tpep_dropoff_datetime": datetime(2025, 2, 1, 0, 10),
    }
    days = gold.dim_date(trips(spark, {}, late)).orderBy("date_key").collect()
    assert (days[0].date_key, days[-1].date_key, len(days)) == (20250110, 20250201, 23)
    assert (days[0].month_name, days[0].day_name, days[0].day_of_week, days[0].is_weekend) == ("Enero", "Viernes", 5, False)
    assert days[1].is_weekend and days[1].iso_week == 2


def test_calendar_without_trips_is_empty(spark):
    assert gold.dim_date(trips(spark, {}).filter("false")).isEmpty()


def test_iso_week_at_the_turn_of_the_year(spark):
    day = spark.createDataFrame(
        [(datetime(2024, 12, 30), datetime(2024, 12, 30))], "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz"
    )
    row = gold.dim_date(day, ENGLISH).first()
    assert (row.year, row.iso_week, row.day_name) == (2024, 1, "Monday")


def test_day_periods(spark):
    times = {r.time_key: (r.hour_label, r.day_period) for r in gold.dim_time(spark).collect()}
    assert len(times) == 24
    assert times[5] == ("05:00", "Madrugada") and times[6] == ("06:00", "Mañana")
    assert times[17] == ("17:00", "Tarde") and times[18] == ("18:00", "Noche")


def test_star_report_leaves_out_weekends_and_reversals(spark):
    silver_rows = trips(
        spark, {}, {**apart(1), "total_amount": 99.0},  # a Saturday
        {**apart(3), "total_amount": 20.0, "trip_distance": 1.01},
        {**apart(4), "total_amount": 7.0}, {**apart(4), "total_amount": -7.0},
    )
    zones = spark.createDataFrame([(100, "Bronx")], "zone_key int, borough string")
    report = gold.star_report(gold.fact_trips(silver_rows), zones, gold.dim_time(spark), gold.dim_date(silver_rows))
    assert [tuple(r) for r in report.collect()] == [("Bronx", "Mañana", 2, Decimal("34.00"), Decimal("1.76"))]


def test_reports_of_one_month_open_one_partition(spark, tmp_path):
    months = [
        {"tpep_pickup_datetime": datetime(2025, m, 7, 8), "tpep_dropoff_datetime": datetime(2025, m, 7, 9),
         "_source_file": f"yellow_tripdata_2025-{m:02}.parquet", "DOLocationID": m}
        for m in range(1, 7)
    ]
    rows_ = trips(spark, *months)
    path = str(tmp_path / "fact")
    tables.overwrite(gold.fact_trips(rows_), path, "_source_period")
    tables.overwrite(gold.dim_date(rows_), str(tmp_path / "dates"))
    may = tables.read(spark, str(tmp_path / "dates")).filter("year_month = '2025-05'")
    zones = spark.createDataFrame([(100, "Bronx")], "zone_key int, borough string")
    for report, expected in (
        (gold.star_report(tables.read(spark, path), zones, gold.dim_time(spark), may), 1),
        (gold.net_revenue(tables.read(spark, path), ["_source_period"], may), 1),
    ):
        assert report.count() == expected
        plan = report._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        # The scan's own figure of partitions it has opened.
        report.collect()
        scans = [m for m in _partitions_read(plan) if m >= 0]
        assert 1 in scans


def _partitions_read(plan):
    """`number of partitions read` of all file scans of an executed plan."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        metric = node.metrics().get("numPartitions")
        if node.nodeName().startswith("Scan") and metric.isDefined():
            found.append(metric.get().value())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_ratios_use_rows_where_both_parts_are_known(spark):
    fact = gold.fact_trips(trips(spark, {}, {**apart(1), "trip_distance": 0.0}))
    row = gold.derived(fact, ["vendor_key"]).first()
    assert (row.miles_per_hour, row.tip_percent, row.mean_amount) == (Decimal("15.0000"), Decimal("20.0000"), Decimal("14.0000"))


def test_digits_order_values_as_the_values_do(spark):
    rng = random.Random(9)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    values += [float("inf"), -float("inf")] + [s * 2.0**k for s in (1, -1) for k in range(-1074, 1024, 3)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", F.array(*digits(F.col("v"))).alias("d"))
    ordered = [tuple(r.d) for r in sorted(df.collect(), key=lambda r: r.v)]
    assert ordered == sorted(ordered)


def test_median_of_a_million_values_of_any_size(spark):
    n = 1_000_000
    place = F.pmod(F.col("id") * 7919, F.lit(n))  # each once
    size = F.pow(F.lit(10.0), place.cast("double") / n * 600 - 300)
    data = spark.range(0, n, 1, 8).select(
        F.when(place % 4 == 0, -size).otherwise(size).alias("v"), F.lit(1).alias("n"), F.lit("a").alias("k")
    )
    data = data.unionByName(spark.createDataFrame([(-1e300, 1, "b"), (1e300, 1, "b"), (7.5, 2, "c"), (None, 5, "c")], "v double, n int, k string"))
    counted = data.groupBy("k", "v").agg(F.sum("n").alias("n"))
    got = {r.k: r["median"] for r in grouped_median(counted, ["k"], "v", "n", exact=None).collect()}
    expected = sorted((-1 if i % 4 == 0 else 1) * 10.0 ** (i / n * 600 - 300) for i in range(n))
    assert len(set(expected)) == n
    assert got["a"] == pytest.approx((expected[n // 2 - 1] + expected[n // 2]) / 2, rel=1e-9)
    assert got["b"] == 0.0 and got["c"] == 7.5


def test_duplicates_take_one_scan(spark):
    rows_ = bronze(spark, *[{}] * 3, {"_source_file": "yellow_tripdata_2025-02.parquet"}, {"tip_amount": 9.0}, {"VendorID": None}, {"VendorID": None, "extra": 1.0})
    assert [tuple(r)[1:] for r in profile.duplicates(rows_).collect()] == [(1, 3), (2, 5), (1, 4)]
    plan = profile.duplicates(rows_)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    assert [tuple(r)[1:] for r in profile.duplicates(rows_.limit(1)).collect()] == [(0, None), (0, None), (0, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_grouped_median_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), rng.choice([round(rng.uniform(-5, 5), 2), 1.5, None])) for _ in range(400)]
    data += [("c", 7.25)] * 300 + [("c", -1.0)]
    groups = defaultdict(list)
    for k, v in data:
        if v is not None:
            groups[k].append(v)
    counted = spark.createDataFrame(data, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {r.k: float(r["median"]) for r in grouped_median(counted, ["k"], "v", "n").collect()}
    assert got == pytest.approx({k: statistics.median(v) for k, v in groups.items()})


def test_profile_orders(spark):
    data = bronze(spark, {"VendorID": 2}, {"VendorID": 2}, {"VendorID": 1}, {"passenger_count": None, "VendorID": 2})
    got = [tuple(r) for r in profile.categories(data).collect()]
    assert [r[:3] for r in got if r[0] == "vendorid"] == [("vendorid", "2", 3), ("vendorid", "1", 1)]
    assert [r[:3] for r in got if r[0] == "passenger_count"] == [("passenger_count", "1", 3), ("passenger_count", None, 1)]
    assert [r[0] for r in got] == sorted(r[0] for r in got)


def test_profile_duplicates_and_patterns(spark):
    other_file = {"_source_file": "yellow_tripdata_2025-02.parquet"}
    data = bronze(
        spark, {}, {}, {**apart(1), "total_amount": 5.0}, {**apart(1), "total_amount": -5.0},
        {**apart(2), "total_amount": 1.0}, {**apart(2), **other_file, "total_amount": 2.0}, apart(3),
    )
    assert rows(profile.duplicates(data), "kind", "groups", "surplus_rows") == [
        ("exactos", 1, 1), ("por_clave", 3, 3), ("por_clave_entre_archivos", 1, 1),
    ]
    assert rows(profile.duplicate_patterns(data, ENGLISH), "pattern", "groups", "rows") == [
        ("no_negative_different_amount", 1, 2), ("no_negative_same_amount", 1, 2), ("original_and_reversal", 1, 2),
    ]


def test_profile_orphans_keep_null_ids(spark):
    zones = spark.createDataFrame([(100,)], "locationid bigint")
    got = profile.orphan_zones(bronze(spark, {}, {"PULocationID": None}), zones)
    assert [tuple(r) for r in got.collect()] == [("dropoff", 200, 2), ("pickup", None, 1)]


def test_files_that_changed_after_the_target_took_them(spark):
    a, b = {}, {"_source_file": "yellow_tripdata_2025-02.parquet", "_loaded_at": datetime(2025, 5, 1)}
    target = bronze(spark, a, a, b)
    batch = bronze_layer.newer_rows(bronze(spark, a, {**b, "_loaded_at": datetime(2025, 6, 1)}), target)
    assert rows(batch.groupBy("_source_file").count(), "_source_file", "count") == [
        ("yellow_tripdata_2025-02.parquet", 1)
    ]
    gone = rows(bronze_layer.changed_files(bronze(spark, a), target), "_source_file", "gone")
    assert gone == [("yellow_tripdata_2025-02.parquet", True)]


class TestChecks:
    def offenders(self, df):
        return {r["check"]: r["offenders"] for r in df.collect()}

    def test_nulls_and_words(self, spark):
        df = spark.createDataFrame([(None, "x"), (1, None), (1, "y")], "a int, b string")
        assert quality.null_rows(df, "a").count() == 1
        assert quality.unexpected_values(df, "b", ["x"]).count() == 1  # NULL passes
        got = quality.count_row_tests(df, {"a": F.col("a").isNull(), "b": ~F.col("b").isin("x")})
        assert self.offenders(got) == {"a": 1, "b": 1}

    def test_repeats_ignore_null(self, spark):
        df = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "a int")
        assert [tuple(r) for r in quality.repeated_values(df, "a").collect()] == [(1, 3)]
        both = quality.count_repeats({"x": (df, "a"), "y": (df.filter("a = 2"), "a"), "z": (df.filter("false"), "a")})
        assert self.offenders(both) == {"x": 1, "y": 0, "z": 0}

    def test_repeats_are_looked_for_by_hash(self, spark, tmp_path, monkeypatch):
        """Only hashes that occur again are kept, and values that share one are told apart."""
        monkeypatch.setattr(quality, "scratch_path", lambda spark, name: str(tmp_path / name))
        df = spark.createDataFrame([("p",), ("q",), ("q",), ("r",), (None,), (None,)], "a string")
        assert rows(quality.count_repeats({"x": (df, "a")}), "offenders") == [(1,)]
        assert spark.read.parquet(str(tmp_path / "repeats")).count() == 1
        monkeypatch.setattr(quality, "scratch_path", lambda spark, name: str(tmp_path / "again"))
        monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: F.lit(0))
        assert rows(quality.count_repeats({"x": (df, "a")}), "offenders") == [(1,)]

    def test_references_ignore_null(self, spark):
        child = spark.createDataFrame([(1, 1), (2, 1), (None, 9), (2, 9)], "a int, b int")
        parent = spark.createDataFrame([(1,)], "id int")
        assert quality.orphan_rows(child, "a", parent, "id").count() == 2
        got = quality.count_orphans(child, {"a": (parent, "id"), "b": (parent, "id")}, "t")
        assert self.offenders(got) == {"t.references.a": 2, "t.references.b": 2}

    def test_empty_parent_makes_every_reference_an_orphan(self, spark):
        child = spark.createDataFrame([(1, 1), (2, None)], "a int, b int")
        parent = spark.createDataFrame([(1,)], "id int")
        got = quality.count_orphans(child, {"a": (parent.filter("false"), "id"), "b": (parent, "id")}, "t")
        assert self.offenders(got) == {"t.references.a": 2, "t.references.b": 0}

    def test_file_counts(self, spark):
        raw = spark.createDataFrame([("a",), ("a",), ("b",)], "_source_file string")
        assert quality.file_count_gaps(raw, raw).isEmpty()
        gaps = quality.file_count_gaps(raw, raw.filter("_source_file = 'a'"))
        assert [tuple(r) for r in gaps.collect()] == [("b", 1, None)]

    def test_split(self, spark):
        three, two, one = (spark.range(n) for n in (3, 2, 1))
        assert quality.split_gap(three, two, one).isEmpty()
        assert [tuple(r) for r in quality.split_gap(three, one, one).collect()] == [(3, 1, 1)]

    def test_totals(self, spark):
        df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.00"),)], "total_amount decimal(18,2)")
        assert quality.total_gap(df, df).isEmpty()
        assert quality.total_gap(df, df.filter("total_amount > 1")).count() == 1

    def test_negative_distance_passes_the_rules_but_not_the_check(self, spark):
        clean, bad = trips(spark, {}), trips(spark, {"trip_distance": -1.0})
        assert quality.silver_rule_rows(clean).isEmpty() and quality.silver_rule_rows(bad).count() == 1

    def test_declared_checks_add_up(self):
        per_kind = defaultdict(int)
        for layer in quality.declared(SOURCE).values():
            for checks in layer.values():
                for kind in ("not_null", "unique", "references", "accepted"):
                    per_kind[kind] += len(getattr(checks, kind))
        assert per_kind == {"not_null": 53, "unique": 15, "references": 14, "accepted": 1}


def test_shuffle_partitions_follow_the_stored_size():
    gib = 1 << 30
    assert session.shuffle_partitions(0, 200) == 200
    assert session.shuffle_partitions(gib, 200) == 200
    assert session.shuffle_partitions(1000 * gib, 200) == 4000
    assert session.shuffle_partitions(100_000 * gib, 200) == session.MOST_PARTITIONS


@pytest.mark.parametrize("report", [profile.negative_amounts, profile.zero_matrix])
def test_medians_scan_the_table_once(spark, tmp_path, report):
    """Counts and medians share one scan and its shuffle."""
    path = str(tmp_path / "trips")
    standin.raw_trips(spark, SF).write.parquet(path)
    found = report(spark.read.parquet(path))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 2 and plan.count("FileScan parquet") == 1
