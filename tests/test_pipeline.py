"""Landing, idempotency and the checked build, over month files in a temporary folder."""

import os
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import GOOD, rows
from pyspark.sql import functions as F

from fareline import words as W
from fareline.__main__ import report
from fareline.operators import bronze, quality
from fareline.plans import pipeline
from fareline.sources import landing, ledger, tables
from fareline.sources.store import REJECTED, Store
from fareline.streaming.bronze_stream import refresh_bronze

INTEGERS = ("VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID", "payment_type")
ZONES = '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark","EWR"\n100,Bronx,"A, B",Boro Zone\n' \
        '200,Queens,C,Airports\n264,"","",""\n265,,,\n'


def month_file(folder, month, count, drop=(), rename=None, floats=()):
    """Write `count` different good trips as a publisher would."""
    start = datetime.strptime(month, "%Y-%m")
    names = [n for n in GOOD if not n.startswith("_")]
    table = {n: [GOOD[n]] * count for n in names}
    table["tpep_pickup_datetime"] = [start + timedelta(hours=i) for i in range(count)]
    table["tpep_dropoff_datetime"] = [t + timedelta(minutes=10) for t in table["tpep_pickup_datetime"]]

    def kind(n):
        if n.endswith("datetime"):
            return pa.timestamp("us")
        if n == "store_and_fwd_flag":
            return pa.string()
        return pa.int64() if n in INTEGERS and n not in floats else pa.float64()

    arrays = {
        (rename or {}).get(n, n): pa.array(
            [float(v) for v in table[n]] if kind(n) == pa.float64() else table[n], kind(n)
        )
        for n in names if n not in drop
    }
    pq.write_table(pa.table(arrays), f"{folder}/yellow_tripdata_{month}.parquet")


@pytest.fixture
def place(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "taxi_zone_lookup.csv").write_text(ZONES)
    month_file(folder, "2025-01", 30, drop=["cbd_congestion_fee"])
    month_file(folder, "2025-02", 20, rename={"Airport_fee": "airport_fee"}, floats=["passenger_count"])
    return str(folder), str(tmp_path / "root")


def request(folder, **changes):
    base = {"first": date(2025, 1, 1), "last": date(2025, 2, 1), "today": date(2025, 4, 10)}
    return pipeline.Request(landing=folder, **{**base, **changes})


def statuses(results):
    return {r.source_file[-15:-8] if "trip" in r.source_file else "zones": (r.status, r.rows_loaded) for r in results.collect()}


def test_first_run_second_run_forced_run_and_one_new_file(spark, place):
    folder, root = place
    store = Store(spark, root)
    first = pipeline.run(spark, root, request(folder))
    assert statuses(first) == {"zones": ("LOADED", 5), "2025-01": ("LOADED", 30), "2025-02": ("LOADED", 20)}
    fact = rows(store.read("fct_trips"), "trip_id", "total_amount", "pickup_date_key")
    assert len(fact) == 50
    stamps = rows(store.read("bronze_yellow_trips").groupBy("_source_file").agg(F.max("_loaded_at").alias("t")), "_source_file", "t")

    # Nothing changed: files are skipped and bronze keeps its rows.
    again = pipeline.run(spark, root, request(folder))
    assert statuses(again)["2025-01"] == ("SKIPPED", 30)
    assert ledger.run_total(again).first()["trip_rows"] == 50
    now = rows(store.read("bronze_yellow_trips").groupBy("_source_file").agg(F.max("_loaded_at").alias("t")), "_source_file", "t")
    assert now == stamps
    assert rows(store.read("fct_trips"), "trip_id", "total_amount", "pickup_date_key") == fact

    # One file changed and one month is asked for that is not out yet.
    month_file(folder, "2025-02", 25)
    changed = pipeline.run(spark, root, request(folder, last=date(2025, 3, 1)))
    assert statuses(changed) == {
        "zones": ("LOADED", 5), "2025-01": ("SKIPPED", 30), "2025-02": ("LOADED", 25), "2025-03": ("NOT_AVAILABLE", None),
    }
    later = dict(rows(store.read("bronze_yellow_trips").groupBy("_source_file").agg(F.max("_loaded_at").alias("t")), "_source_file", "t"))
    before = dict(stamps)
    assert later["yellow_tripdata_2025-01.parquet"] == before["yellow_tripdata_2025-01.parquet"]
    assert later["yellow_tripdata_2025-02.parquet"] > before["yellow_tripdata_2025-02.parquet"]
    assert store.read("fct_trips").count() == 55

    # A forced run loads the same rows again.
    forced = pipeline.run(spark, root, request(folder, force=True, full_refresh=True))
    assert statuses(forced)["2025-01"] == ("LOADED", 30)
    assert store.read("fct_trips").count() == 55
    assert store.read("ingestion_log").count() == 3 + 3 + 4 + 3

    # SQL over the finished layers.
    store.register_views()
    assert spark.sql("select count(*) from fct_trips f join dim_zone z on f.pickup_zone_key = z.zone_key").first()[0] == 55


def test_damaged_file_does_not_keep_the_others_out(spark, place):
    folder, root = place
    with open(f"{folder}/yellow_tripdata_2025-02.parquet", "wb") as broken:
        broken.write(b"this is no parquet file")
    with pytest.raises(pipeline.LoadFailed) as failure:
        pipeline.run(spark, root, request(folder))
    assert statuses(failure.value.results)["2025-02"] == ("FAILED", None)
    store = Store(spark, root)
    log = {r.source_file[-15:-8]: (r.status, r.rows_loaded) for r in store.read("ingestion_log").collect() if "trip" in r.source_file}
    assert log == {"2025-01": ("LOADED", 30), "2025-02": ("FAILED", None)}
    assert not store.has("fct_trips")


def test_old_missing_month_fails_the_run(spark, place):
    folder, root = place
    with pytest.raises(pipeline.LoadFailed):
        pipeline.run(spark, root, request(folder, first=date(2024, 11, 1)))


def test_reload_without_rows_empties_only_that_file(spark, place):
    folder, root = place
    store = Store(spark, root)
    pipeline.land(store, request(folder))
    month_file(folder, "2025-02", 0)
    results = pipeline.land(store, request(folder))
    assert statuses(results)["2025-02"] == ("LOADED", 0)
    counts = {r.source_file[-15:-8]: r.rows_present for r in tables.rows_per_file(store.read("yellow_trips")).collect()}
    assert counts == {"2025-01": 30}
    kept = tables.rows_present(spark, store.path("yellow_trips"))
    assert {r.source_file[-15:-8]: r.rows_present for r in kept.collect()} == counts


def test_failed_check_stops_the_build(spark, place):
    folder, root = place
    month_file(folder, "2025-02", 20, drop=["PULocationID"])
    with pytest.raises(quality.ChecksFailed, match="not_null.trip_id"):
        pipeline.run(spark, root, request(folder))
    store = Store(spark, root)
    assert store.has("silver_yellow_trips") and not store.has("fct_trips")


def test_files_bind_by_name(spark, place):
    folder, _ = place
    df = landing.read_trip_files(spark, [f"{folder}/yellow_tripdata_2025-0{m}.parquet" for m in (1, 2)])
    got = df.groupBy("_source_file").agg(
        F.count("Airport_fee").alias("a"), F.count("cbd_congestion_fee").alias("c"), F.sum("passenger_count").alias("p")
    )
    assert rows(got, "a", "c", "p") == [(20, 20, 20), (30, 0, 30)]
    assert dict(df.dtypes)["passenger_count"] == "bigint"


def test_quoted_csv(spark, place):
    folder, _ = place
    df = landing.read_zone_file(spark, f"{folder}/taxi_zone_lookup.csv")
    assert df.count() == 5
    assert df.filter("LocationID = 100").first()["Zone"] == "A, B"


def test_inventory_lists_sizes(spark, place):
    folder, _ = place
    sizes = {r.source_file: r.size_bytes for r in landing.inventory(spark, folder).collect()}
    assert sizes == {name: os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder)}


def test_months_both_included_and_reversed_range_raises(spark):
    months = landing.requested_periods(spark, date(2024, 11, 1), date(2025, 2, 1))
    assert [r.source_file[-15:-8] for r in months.orderBy("source_period").collect()] == [
        "2024-11", "2024-12", "2025-01", "2025-02",
    ]
    with pytest.raises(ValueError):
        landing.requested_periods(spark, date(2025, 2, 1), date(2025, 1, 1))


def test_seed_file_with_quotes(spark, tmp_path):
    path = tmp_path / "ref_vendors.csv"
    path.write_text('vendor_id,vendor_name\n1,"Creative Mobile Technologies, LLC"\n7,Helix\n')
    got = landing.read_seed_file(spark, "ref_vendors", str(path))
    assert rows(got, "vendor_id", "vendor_name") == [(1, "Creative Mobile Technologies, LLC"), (7, "Helix")]


def test_latest_load_and_listing_order(spark):
    t = datetime(2025, 1, 1)

    def row(file, status, count, finished):
        return (file, None, "u", status, count, 10, t, finished, "m" * 2000)

    log = ledger.entries(
        spark,
        [
            row("a", W.LOADED, 5, t), row("a", W.LOADED, 6, t + timedelta(days=1)),
            row("a", W.FAILED, None, t + timedelta(days=2)), row("b", W.LOADED, 7, t), row("b", W.LOADED, 8, None),
        ],
    )
    assert rows(ledger.latest_loads(log), "source_file", "logged_rows") == [("a", 6), ("b", 8)]
    listed = ledger.listing(log).collect()
    assert listed[0].finished_at is None and listed[1].status == W.FAILED
    assert len(listed[0].message) == 2000


def test_a_directory_that_cannot_be_listed_fails_every_month(spark, place, monkeypatch, capsys):
    folder, root = place

    def lost(*_):
        raise OSError("the folder cannot be listed")

    monkeypatch.setattr(landing, "inventory", lost)
    with pytest.raises(pipeline.LoadFailed) as failure:
        pipeline.run(spark, root, request(folder))
    kept = rows(Store(spark, root).read("ingestion_log"), "source_file", "status", "rows_loaded", "message")
    assert kept == [
        ("taxi_zone_lookup.csv", W.LOADED, 5, "ok"),
        ("yellow_tripdata_2025-01.parquet", W.FAILED, None, "the folder cannot be listed"),
        ("yellow_tripdata_2025-02.parquet", W.FAILED, None, "the folder cannot be listed"),
    ]
    report(failure.value.results)
    printed = capsys.readouterr().out.splitlines()
    assert [line.split("\t")[1] for line in printed] == [W.LOADED, W.FAILED, W.FAILED, "0"]


def test_missing_directory(spark, place):
    _, root = place
    with pytest.raises(pipeline.LoadFailed) as failure:
        pipeline.run(spark, root, request("/nowhere/at/all"))
    assert {s for s, _ in statuses(failure.value.results).values()} == {W.FAILED}
    assert Store(spark, root).read("ingestion_log").count() == 3


def test_a_bad_batch_is_halved(spark, place, monkeypatch):
    """One bad file among 24 costs two jobs for each halving, and keeps none of the others out."""
    folder, root = place
    for nth in range(24):
        month_file(folder, f"{2020 + nth // 12}-{nth % 12 + 1:02}", 3 + nth)
    bad, real, calls = "yellow_tripdata_2020-09.parquet", landing.read_trip_files, []

    def read(spark, paths, schemas=None):
        calls.append(len(paths))
        df = real(spark, paths, schemas)
        broken = F.raise_error(F.lit("a page is damaged")).cast("string")
        return df.withColumn("_source_file", F.when(F.col("_source_file") == bad, broken).otherwise(F.col("_source_file")))

    monkeypatch.setattr(landing, "read_trip_files", read)
    results = pipeline.land(Store(spark, root), request(folder, first=date(2020, 1, 1), last=date(2021, 12, 1)))
    found = {r.source_file: (r.status, r.rows_loaded) for r in results.collect()}
    assert found.pop(bad)[0] == W.FAILED and found.pop("taxi_zone_lookup.csv") == (W.LOADED, 5)
    assert sorted(found.values()) == [(W.LOADED, 3 + nth) for nth in range(24) if nth != 8]
    assert len(calls) <= 1 + 2 * 5 and sorted(calls)[-1] == 24
    assert Store(spark, root).read("yellow_trips").count() == sum(3 + nth for nth in range(24) if nth != 8)


def test_report_prints_every_file(spark, capsys):
    many = [(f"f{k:04}", None, "u", W.SKIPPED, k, 1, datetime(2025, 1, 1), None, "m" * 3000) for k in range(1200)]
    report(ledger.entries(spark, many))
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 1201 and lines[1199].startswith("f1199") and lines[-1] == f"trip rows\t{sum(range(1200))}"


def test_bronze_heals_after_a_crash_between_two_files(spark, place):
    folder, root = place
    store = Store(spark, root)
    pipeline.land(store, request(folder))
    pipeline.build_bronze(store)
    month_file(folder, "2025-01", 31)
    month_file(folder, "2025-02", 22)
    pipeline.land(store, request(folder))
    raw = store.read("yellow_trips")
    first = raw.filter(F.col("_source_file").contains("2025-01"))  # the crash came after this one
    tables.replace_by_file(bronze.bronze_trips(first), store.path("bronze_yellow_trips"), figures=tables.marks())
    pipeline.build_bronze(store)
    counts = rows(store.read("bronze_yellow_trips").groupBy("_source_file").count(), "_source_file", "count")
    assert [n for _, n in counts] == [31, 22]

    # A file that lost all its rows leaves bronze too.
    month_file(folder, "2025-02", 0)
    pipeline.land(store, request(folder))
    pipeline.build_bronze(store)
    counts = rows(store.read("bronze_yellow_trips").groupBy("_source_file").count(), "_source_file", "count")
    assert [n for _, n in counts] == [31]


def test_lineage_and_stamps(spark, place):
    folder, root = place
    store = Store(spark, root)
    begun = datetime.now()
    pipeline.land(store, request(folder))
    pipeline.build_bronze(store)
    raw, kept = store.read("yellow_trips"), store.read("bronze_yellow_trips")
    assert raw.filter("_source_file IS NULL OR _file_last_modified IS NULL OR _loaded_at IS NULL").isEmpty()
    for name, modified in rows(raw.select("_source_file", "_file_last_modified").distinct(), "_source_file", "_file_last_modified"):
        assert abs(modified.timestamp() - os.path.getmtime(f"{folder}/{name}")) < 1
    assert raw.filter(F.col("_loaded_at") < F.lit(begun)).isEmpty()
    assert kept.filter("_bronze_loaded_at IS NULL OR _bronze_loaded_at < _loaded_at").isEmpty()
    zones = store.read("bronze_taxi_zones")
    assert zones.count() == 5 and zones.filter("_bronze_loaded_at IS NULL OR _loaded_at IS NULL").isEmpty()


def test_streaming_refresh_equals_the_batch(spark, place, tmp_path):
    folder, root = place
    store = Store(spark, root)
    pipeline.land(store, request(folder))
    check = str(tmp_path / "checkpoint")
    refresh_bronze(store, check).awaitTermination()
    assert store.read("bronze_yellow_trips").count() == 50
    month_file(folder, "2025-02", 25)
    pipeline.land(store, request(folder))
    refresh_bronze(store, check).awaitTermination()
    counts = rows(store.read("bronze_yellow_trips").groupBy("_source_file").count(), "_source_file", "count")
    assert [n for _, n in counts] == [30, 25]


def test_quarantine_reads_only_its_partition(spark, place):
    folder, root = place
    pipeline.run(spark, root, request(folder))
    store = Store(spark, root)
    plan = store.read(REJECTED)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_rejected" in plan
    assert store.read(REJECTED).count() == 0


def test_bronze_that_was_never_committed_is_built(spark, place, monkeypatch):
    folder, root = place
    store = Store(spark, root)
    pipeline.land(store, request(folder))

    def lost(*_):
        raise OSError("the driver died")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lost)
        with pytest.raises(OSError):
            pipeline.build_bronze(store)
    assert not store.has("bronze_yellow_trips")
    pipeline.build_bronze(store)
    assert store.read("bronze_yellow_trips").count() == 50
