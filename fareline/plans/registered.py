"""Queries by name: each takes (spark, folder with the benchmark tables) and returns rows.

The layers are stored once per session and folder, as the pipeline stores them, and the
queries read the stored layer they belong to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import standin
from fareline import words as W
from fareline.functions import columns as C
from fareline.operators import bronze, gold, profile, quality, silver
from fareline.plans import pipeline
from fareline.session import gathering, prepare, scratch_path
from fareline.sources import landing, ledger, tables
from fareline.sources.store import EVALUATED, REJECTED, Store
from fareline.streaming.bronze_stream import refresh_bronze

TODAY = date(2001, 12, 15)
FIRST, LAST = date(1994, 11, 1), date(2001, 12, 1)
HIGH_WATER = "2001-01-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Stored layers ---------------------------------------------------------------------

_built: dict[tuple[str, str], "Built"] = {}


class Built:
    """A store whose layers are built on first use, from the benchmark tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = Store(spark, scratch_path(spark, "layers"))
        self.done: set[str] = set()

    def _once(self, step: str, action: Callable[[], None]) -> None:
        if step not in self.done:
            action()
            self.done.add(step)

    def _land(self) -> None:
        # Rows of a month come from all over the join; they are brought together before writing by file.
        raw = standin.raw_trips(self.spark, self.sf_dir, by_month=True)
        with gathering(self.spark):
            tables.overwrite(
                raw, self.store.path("yellow_trips"), partition_by="_source_file", figures=pipeline.landing_figures()
            )
        pipeline.put(self.store, "taxi_zones", standin.raw_zones(self.spark, self.sf_dir))

    def raw(self) -> Store:
        self._once("raw", self._land)
        return self.store

    def bronze(self) -> Store:
        self.raw()
        self._once("bronze", lambda: pipeline.build_bronze(self.store))
        return self.store

    def silver(self) -> Store:
        self.bronze()
        self._once("seeds", lambda: pipeline.build_seeds(self.store))
        self._once("silver", lambda: pipeline.build_silver(self.store))
        return self.store

    def gold(self) -> Store:
        self.silver()
        self._once("gold", lambda: pipeline.build_gold(self.store))
        return self.store


def layers(spark: SparkSession, sf_dir: str) -> Built:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = Built(prepare(spark), sf_dir)
    return _built[key]


def _raw(spark, d) -> DataFrame:
    return layers(spark, d).raw().read("yellow_trips")


def _bronze(spark, d) -> DataFrame:
    return layers(spark, d).bronze().read("bronze_yellow_trips")


def _zones(spark, d) -> DataFrame:
    return layers(spark, d).bronze().read("bronze_taxi_zones")


def _evaluated(spark, d) -> DataFrame:
    return layers(spark, d).silver().read("silver_yellow_trips_evaluated")


def _trips(spark, d) -> DataFrame:
    return layers(spark, d).silver().read("silver_yellow_trips")


def _gold(spark, d) -> Store:
    return layers(spark, d).gold()


def _plain(df: DataFrame) -> DataFrame:
    """Without write stamps, and with zone-free load times, so that results can be compared."""
    stamps = [c for c in ("_bronze_loaded_at", "_silver_loaded_at") if c in df.columns]
    times = {
        name: F.col(name).cast("timestamp_ntz")
        for name in ("_loaded_at", "_file_last_modified", "finished_at")
        if name in df.columns
    }
    return df.drop(*stamps).withColumns(times) if times else df.drop(*stamps)


# --- Landing ---------------------------------------------------------------------------


@query
def requested_periods(spark, d):
    orders = standin.table(prepare(spark), d, "orders")
    bounds = orders.agg(
        C.month_start(F.min("o_orderdate")).alias("first_month"),
        C.month_start(F.max("o_orderdate")).alias("last_month"),
    )
    return landing.months_between(bounds, standin.FILE_PREFIX)


def _verdicts(spark, d, force: bool) -> DataFrame:
    raw = _raw(spark, d)
    return landing.load_verdicts(
        landing.requested_periods(spark, FIRST, LAST, standin.FILE_PREFIX),
        standin.inventory(raw),
        ledger.latest_loads(standin.ledger(raw)),
        standin.present_rows(raw),
        TODAY,
        force,
    )


@query
def file_inventory_verdict(spark, d):
    return _verdicts(spark, d, False).select("source_period", "source_file", "size_bytes", "verdict")


def _text_files(spark, d) -> str:
    """A directory with a file per month, named as the months are; a trip has 100 bytes, in March 101."""
    folder = scratch_path(spark, "published")
    codes = F.concat_ws("|", F.col("vendorid").cast("string"), F.col("pulocationid").cast("string"))
    line = F.rpad(codes, F.when(F.col("_source_file").contains("-03."), 100).otherwise(99), F.lit("."))
    lines = _raw(spark, d).select("_source_file", line.alias("line"))
    lines.repartition("_source_file").write.partitionBy("_source_file").text(f"{folder}/parts")
    tables.name_files(spark, f"{folder}/parts", f"{folder}/landing")
    return f"{folder}/landing"


@query
def landing_inventory(spark, d):
    """The files of a directory with their sizes, and what to do with each; no content is read."""
    raw = _raw(spark, d)
    found = landing.inventory(spark, _text_files(spark, d))
    verdicts = landing.load_verdicts(
        landing.requested_periods(spark, FIRST, LAST, standin.FILE_PREFIX),
        found, ledger.latest_loads(standin.ledger(raw)), standin.present_rows(raw), TODAY,
    )
    stamped = found.select("source_file", F.col("modified_at").isNotNull().alias("has_time"))
    return verdicts.join(stamped, "source_file", "left").select("source_file", "size_bytes", "verdict", "has_time")


@query
def availability_verdict(spark, d):
    missing = _verdicts(spark, d, False).filter(F.col("size_bytes").isNull())
    return missing.select("source_period", "source_file", "verdict")


@query
def change_detection(spark, d):
    found = _verdicts(spark, d, False).filter(F.col("size_bytes").isNotNull())
    return found.select("source_file", "verdict", "rows_loaded")


@query
def forced_reload(spark, d):
    found = _verdicts(spark, d, True).filter(F.col("size_bytes").isNotNull())
    return found.select("source_file", "verdict", "rows_loaded")


@query
def ledger_append(spark, d):
    """Two appended batches of attempts, read back."""
    attempts = standin.ledger(_raw(spark, d))
    path = scratch_path(spark, "ledger")
    for part in (F.col("status") == W.LOADED, F.col("status") != W.LOADED):
        tables.append(attempts.filter(part), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("status").agg(
        F.count("*").alias("attempts"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.max(F.length("message")).alias("longest_message"),
    )


@query
def ledger_latest_load(spark, d):
    return ledger.latest_loads(standin.ledger(_raw(spark, d)))


@query
def ledger_listing(spark, d):
    return _plain(ledger.listing(standin.ledger(_raw(spark, d))))


@query
def rows_per_file(spark, d):
    """Counted when the files were written, and kept in the table's manifest."""
    landed = layers(spark, d).raw()
    return tables.rows_present(spark, landed.path("yellow_trips"))


def _run_results(spark, d) -> DataFrame:
    verdicts = _verdicts(spark, d, False)
    loaded = F.col("verdict") == landing.LOAD
    return verdicts.select(
        "source_file",
        F.when(loaded, W.LOADED).otherwise(F.col("verdict")).alias("status"),
        F.when(loaded, F.expr("size_bytes div 100")).otherwise(F.col("rows_loaded")).alias("rows_loaded"),
        F.coalesce("message", F.lit("ok")).alias("message"),
    )


@query
def run_lines(spark, d):
    return ledger.run_lines(_run_results(spark, d))


@query
def run_summary(spark, d):
    return ledger.run_total(_run_results(spark, d))


@query
def parquet_by_name_load(spark, d):
    """Two files that differ in column case, number type and an absent column, bound by name."""
    raw = standin.raw_trips(prepare(spark), d)
    early = F.col("_source_file") < "trips_1998"
    folder = scratch_path(spark, "files")
    old = raw.filter(early).drop("cbd_congestion_fee").withColumnRenamed("vendorid", "VendorID")
    new = raw.filter(~early).withColumn("passenger_count", F.col("passenger_count").cast("double"))
    new = new.withColumnRenamed("airport_fee", "Airport_fee").withColumn("extra_column", F.lit(1))
    for name, part in (("old", old), ("new", new)):
        rows = part.drop("_source_file", "_file_last_modified", "_loaded_at").withColumn("file", F.lit(f"{name}.parquet"))
        rows.write.partitionBy("file").parquet(f"{folder}/{name}")
        tables.name_files(spark, f"{folder}/{name}", f"{folder}/landing")
    paths = [r["path"] for r in landing.inventory(spark, f"{folder}/landing").select("path").collect()]  # a row per file
    rows = landing.read_trip_files(spark, paths)
    stamps = F.col("_file_last_modified").isNotNull() & (F.col("_file_last_modified") <= F.col("_loaded_at"))
    return rows.select(
        *[F.col(field.name).alias(field.name.lower()) for field in landing.TRIP_FIELDS.fields],
        F.regexp_replace("_source_file", "-[0-9]+[.]", ".").alias("_source_file"),
        F.coalesce(stamps, F.lit(False)).alias("stamps_in_order"),
    )


@query
def csv_zone_load(spark, d):
    """Zones through a CSV file, with the pickups of each zone."""
    path = scratch_path(spark, "zones")
    zones = standin.raw_zones(prepare(spark), d).select("locationid", "borough", "zone", "service_zone")
    (
        zones.write.option("header", True).option("quoteAll", True).option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    loaded = landing.read_zone_file(spark, path).select(
        F.col("LocationID").alias("locationid"), F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"), "service_zone",
    )
    blank = {c: F.nullif(F.col(c), F.lit("")) for c in ("borough", "zone", "service_zone")}
    return gold.with_trips(loaded.withColumns(blank), "locationid", _bronze(spark, d), "pulocationid")


@query
def seed_load(spark, d):
    """The three code lists through CSV files, with the trips of each code."""
    trips = _trips(spark, d)
    out = None
    for name in landing.SEEDS:
        path = scratch_path(spark, name)
        landing.seed(spark, name).coalesce(1).write.option("header", True).csv(path)
        codes = landing.read_seed_file(spark, name, path)
        key, label = codes.columns
        part = gold.with_trips(codes, key, trips, key).select(
            F.lit(name).alias("seed"), F.col(key).alias("code"), F.col(label).alias("label"), "trips"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def replace_by_file(spark, d):
    """One file delivered again with half of its rows: only that file is written, the others are shared."""
    raw = _raw(spark, d)
    path = scratch_path(spark, "replace")
    tables.clone(spark, layers(spark, d).store.path("yellow_trips"), path)
    again = raw.filter((F.col("_source_file") == "trips_1996-05.parquet") & (F.col("vendorid") < 6))
    tables.replace_by_file(again, path)
    return _per_file(tables.read(spark, path))


@query
def full_replace_small(spark, d):
    """The zone list stored twice; the second, shorter one is what stays."""
    path = scratch_path(spark, "zones")
    zones = layers(spark, d).raw().read("taxi_zones")
    tables.overwrite(zones, path)
    tables.overwrite(standin.partial_zones(zones), path)
    kept = tables.read(spark, path).select("locationid", "service_zone")
    return gold.with_trips(kept, "locationid", _bronze(spark, d), "dolocationid")


# --- Bronze ----------------------------------------------------------------------------


@query
def bronze_projection(spark, d):
    rows = _bronze(spark, d)
    stamps = F.coalesce(F.col("_bronze_loaded_at") >= F.col("_loaded_at"), F.lit(False))
    return _plain(rows.withColumn("stamps_in_order", stamps))


@query
def bronze_period(spark, d):
    periods = _bronze(spark, d).groupBy("_source_file", "_source_period")
    return periods.agg(F.count("*").alias("rows"))


def _incremental(spark, d) -> tuple[DataFrame, DataFrame]:
    """Raw rows, and a bronze table that stopped at the high-water mark."""
    raw = _raw(spark, d)
    old = bronze.bronze_trips(raw.filter(F.col("_loaded_at") <= F.lit(HIGH_WATER).cast("timestamp")))
    return raw, old.filter(F.col("vendorid") != 7)


def _per_file(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_source_file").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"),
    )


def _beside(spark, d, name: str) -> Store:
    """An empty store over the landing tables of the built one; they are not copied."""
    landed = layers(spark, d).raw()
    return Store(spark, scratch_path(spark, name), {t: landed.path(t) for t in ("yellow_trips", "taxi_zones")})


def _stopped(spark, d) -> Store:
    """A store whose bronze table stopped at the high-water mark."""
    store = _beside(spark, d, "refresh")
    tables.overwrite(
        _incremental(spark, d)[1], store.path("bronze_yellow_trips"), partition_by="_source_file",
        figures=pipeline.bronze_figures(),
    )
    return store


@query
def bronze_new_rows(spark, d):
    """The changed files are told by the manifests; only they are opened."""
    store = _stopped(spark, d)
    changed = bronze.changed_marks(
        tables.parts(spark, store.path("yellow_trips")), tables.parts(spark, store.path("bronze_yellow_trips"))
    )
    names = [r["source_file"] for r in changed.collect()]  # one row per file
    return _per_file(store.read("yellow_trips").filter(F.col("_source_file").isin(names)))


@query
def bronze_incremental(spark, d):
    """The target lacks a vendor in its old files; only files past the mark are replaced."""
    store = _stopped(spark, d)
    pipeline.build_bronze(store)
    return _per_file(store.read("bronze_yellow_trips"))


@query
def bronze_full_refresh(spark, d):
    store = _stopped(spark, d)
    pipeline.build_bronze(store, full_refresh=True)
    return _per_file(store.read("bronze_yellow_trips"))


@query
def bronze_stream_refresh(spark, d):
    """Bronze filled by the streaming job instead of the high-water mark."""
    store = _beside(spark, d, "stream")
    refresh_bronze(store, scratch_path(spark, "checkpoint")).awaitTermination()
    return _per_file(store.read("bronze_yellow_trips"))


@query
def bronze_zones(spark, d):
    zones = _plain(_zones(spark, d)).drop("_loaded_at")
    return gold.with_trips(zones, "locationid", _bronze(spark, d), "pulocationid")


# --- Silver ----------------------------------------------------------------------------


@query
def silver_typed(spark, d):
    return _plain(silver.typed(_bronze(spark, d)))


@query
def silver_duration(spark, d):
    start, end = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return _bronze(spark, d).groupBy(
        C.seconds_between(start, end).alias("seconds"), C.minutes_between(start, end).alias("minutes")
    ).agg(F.count("*").alias("rows"))


@query
def silver_flag(spark, d):
    flag = F.col("store_and_fwd_flag")
    return _bronze(spark, d).groupBy(flag, C.yes_no(flag).alias("is_store_and_forward")).agg(
        F.count("*").alias("rows")
    )


@query
def silver_key(spark, d):
    return silver.with_key(silver.typed(_bronze(spark, d))).select(
        "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime",
        "pickup_location_id", "dropoff_location_id",
    )


@query
def silver_rules(spark, d):
    return silver.prepared(_bronze(spark, d)).select("trip_id", "total_amount", "_source_file", "broken_rule")


@query
def silver_fingerprint(spark, d):
    """How many fingerprints occur once, twice, and so on."""
    rows = silver.with_fingerprint(silver.typed(_bronze(spark, d)))
    sizes = rows.groupBy("row_fingerprint").agg(F.count("*").alias("copies"))
    return sizes.groupBy("copies").agg(F.count("*").alias("fingerprints"))


def _ties(spark, d) -> DataFrame:
    """Bronze with rows that tie but for a fraction of a second, and rows without a key."""
    return standin.with_odd_ties(_bronze(spark, d))


@query
def silver_dedup_rank(spark, d):
    ranked = silver.dedup_rank(silver.prepared(_ties(spark, d)))
    return ranked.select(
        "trip_id", F.col("broken_rule").isNull().alias("is_valid"), "total_amount", "_source_file",
        "vendor_id", "pickup_datetime", "pickup_location_id", "dedup_rank",
    )


@query
def silver_reversal(spark, d):
    return silver.with_duplicates(silver.prepared(_ties(spark, d))).select(
        "trip_id", "pickup_datetime", "total_amount", "has_reversal"
    )


@query
def silver_reason(spark, d):
    return _plain(silver.evaluate(_ties(spark, d)))


@query
def silver_reason_english(spark, d):
    judged = silver.evaluate(_bronze(spark, d), W.ENGLISH)
    return judged.groupBy("rejection_reason", "has_reversal").agg(F.count("*").alias("rows"))


@query
def silver_valid(spark, d):
    return _plain(silver.accepted(_evaluated(spark, d)).drop("rejection_reason"))


@query
def silver_quarantine(spark, d):
    return _plain(layers(spark, d).silver().read(REJECTED))


@query
def silver_repairs(spark, d):
    return _plain(_trips(spark, d))


@query
def silver_zones(spark, d):
    zones = layers(spark, d).silver().read("silver_taxi_zones").drop("_source_file", "_loaded_at")
    return gold.with_trips(zones, "location_id", _trips(spark, d), "pickup_location_id")


@query
def rejections_by_reason(spark, d):
    return silver.rejections_by_reason(layers(spark, d).silver().read(REJECTED))


# --- Gold ------------------------------------------------------------------------------


@query
def date_key(spark, d):
    start = F.col("pickup_datetime")
    return _trips(spark, d).groupBy(
        C.date_key(start).alias("date_key"), F.hour(start).alias("time_key")
    ).agg(F.count("*").alias("trips"))


@query
def fact_trips(spark, d):
    return _gold(spark, d).read("fct_trips")


@query
def dim_date(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(store.read("dim_date"), "date_key", store.read("fct_trips"), "pickup_date_key")


@query
def dim_date_english(spark, d):
    return gold.dim_date(_trips(spark, d), W.ENGLISH)


@query
def dim_time(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(store.read("dim_time"), "time_key", store.read("fct_trips"), "pickup_time_key")


@query
def dim_zone(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(store.read("dim_zone"), "zone_key", store.read("fct_trips"), "dropoff_zone_key")


@query
def dim_vendor(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(store.read("dim_vendor"), "vendor_key", store.read("fct_trips"), "vendor_key")


@query
def dim_rate_code(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(
        store.read("dim_rate_code"), "rate_code_key", store.read("fct_trips"), "rate_code_key"
    )


@query
def dim_payment_type(spark, d):
    store = _gold(spark, d)
    return gold.with_trips(
        store.read("dim_payment_type"), "payment_type_key", store.read("fct_trips"), "payment_type_key"
    )


@query
def star_report(spark, d):
    read = _gold(spark, d).read
    return gold.star_report(read("fct_trips"), read("dim_zone"), read("dim_time"), read("dim_date"))


@query
def role_playing_report(spark, d):
    read = _gold(spark, d).read
    return gold.flows_between_boroughs(read("fct_trips"), read("dim_zone"))


@query
def derived_measures(spark, d):
    return gold.derived(_gold(spark, d).read("fct_trips"), ["vendor_key", "payment_type_key"])


@query
def additive_measures(spark, d):
    return gold.additive(_gold(spark, d).read("fct_trips"), ["pickup_time_key", "rate_code_key"])


@query
def net_revenue(spark, d):
    return gold.net_revenue(_gold(spark, d).read("fct_trips"), ["_source_period"])


def _one_month(dates: DataFrame) -> DataFrame:
    return dates.filter(F.col("year_month") == "1996-05")


@query
def star_report_month(spark, d):
    """The report for one month of the calendar; the fact's other partitions stay closed."""
    read = _gold(spark, d).read
    return gold.star_report(read("fct_trips"), read("dim_zone"), read("dim_time"), _one_month(read("dim_date")))


@query
def net_revenue_month(spark, d):
    read = _gold(spark, d).read
    return gold.net_revenue(read("fct_trips"), ["_source_period"], _one_month(read("dim_date")))


# --- Checks ----------------------------------------------------------------------------


def _broken(spark, d) -> DataFrame:
    """Silver trips with faults a check must find, each made by a rule on the row itself."""
    trips = _plain(_trips(spark, d))
    zone = F.col("pickup_location_id")
    faulty = trips.withColumns(
        {
            "trip_id": F.when(zone % 50 != 7, F.col("trip_id")),
            "vendor_id": F.when(zone % 60 == 9, 5).otherwise(F.col("vendor_id")),
            "trip_distance_miles": F.when(zone % 90 == 11, -F.col("trip_distance_miles"))
            .otherwise(F.col("trip_distance_miles")),
            "payment_type_id": F.when(zone % 70 != 13, F.col("payment_type_id")),
        }
    )
    return faulty.unionByName(faulty.filter(zone % 80 == 17))


@query
def check_not_null(spark, d):
    rows = _broken(spark, d)
    tests = {c: F.col(c).isNull() for c in ("trip_id", "vendor_id", "payment_type_id", "total_amount")}
    return quality.count_row_tests(rows, tests)


@query
def check_unique(spark, d):
    return quality.repeated_values(_broken(spark, d), "trip_id").select("trip_id", "n")


@query
def check_relationships(spark, d):
    store = layers(spark, d).silver()
    zones = standin.partial_zones(store.read("silver_taxi_zones"), "location_id")
    references = {
        c: (zones if parent == "silver_taxi_zones" else store.read(parent), key)
        for c, (parent, key) in quality.TRIP_REFERENCES.items()
    }
    return quality.count_orphans(_broken(spark, d), references, "silver_yellow_trips")


@query
def check_relationship_rows(spark, d):
    vendors = layers(spark, d).silver().read("ref_vendors")
    return quality.orphan_rows(_broken(spark, d), "vendor_id", vendors, "vendor_id").select(
        "trip_id", "vendor_id", "total_amount"
    )


@query
def check_accepted_values(spark, d):
    known = [r for r in W.SOURCE.reasons if r != W.SOURCE.no_movement]
    rows = quality.unexpected_values(_evaluated(spark, d), "rejection_reason", known)
    return rows.select("trip_id", "rejection_reason", "duration_seconds")


@query
def reconcile_raw_bronze(spark, d):
    raw, target = _incremental(spark, d)
    return quality.file_count_gaps(raw, target)


@query
def reconcile_contents(spark, d):
    """One file came again with as many rows, some of them others, one with the same rows in another order."""
    landed = layers(spark, d).bronze()
    path = scratch_path(spark, "contents")
    tables.clone(spark, landed.path("yellow_trips"), path)
    raw, file = landed.read("yellow_trips"), F.col("_source_file")
    dearer = F.when(F.col("pulocationid") % 9 == 2, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    other = raw.filter(file == "trips_1996-05.parquet").withColumn("total_amount", dearer)
    same = raw.filter(file == "trips_1997-02.parquet").orderBy("pulocationid", "dolocationid")
    tables.replace_by_file(other.unionByName(same), path, figures=pipeline.landing_figures())
    return quality.content_gaps(tables.parts(spark, path), landed.read("bronze_yellow_trips"))


@query
def reconcile_bronze_silver(spark, d):
    store = layers(spark, d).silver()
    rejected = store.read(REJECTED).filter(F.col("rejection_reason") != W.SOURCE.duplicate)
    return quality.split_gap(store.read("bronze_yellow_trips"), store.read("silver_yellow_trips"), rejected)


@query
def check_silver_rules(spark, d):
    return quality.silver_rule_rows(_broken(spark, d))


@query
def reconcile_silver_gold(spark, d):
    store = _gold(spark, d)
    return quality.total_gap(store.read("silver_yellow_trips"), gold.without_reversals(store.read("fct_trips")))


@query
def quality_gate(spark, d):
    """Every check of every layer with its number of offenders."""
    return _gate(_gold(spark, d))


def _gate(store: Store) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [quality.stored_results(layer, store) for layer in ("raw", "bronze", "silver", "gold")]
    )


def _damaged_layers(spark, d, store: Store, unread: Callable[[str], None]) -> Iterator[str]:
    """Layer by layer, tables in which every kind of check of every layer has offenders, written as the job writes them.

    Gives the name of a layer when its tables are there to be checked. `unread` is told of every large table whose
    rows nothing reads any more: at once where the checks are counted on writing, else when the
    layer has been checked.
    """
    good = layers(spark, d).gold()
    zone = F.col("pulocationid")

    def unless(condition, column):
        return F.when(~condition, F.col(column)).alias(column)

    def repeated(rows: DataFrame, condition) -> DataFrame:
        return rows.unionByName(rows.filter(condition))

    raw = good.read("yellow_trips").withColumns(
        {"_loaded_at": unless(zone % 50 == 7, "_loaded_at"), "_source_file": unless(zone % 61 == 5, "_source_file")}
    )
    tables.overwrite(raw, store.path("yellow_trips"), "_source_file", pipeline.landing_figures())
    unread("yellow_trips")
    for name in ("taxi_zones", "bronze_taxi_zones"):
        zones = repeated(good.read(name), "locationid % 40 = 1")
        pipeline.put(store, name, zones.withColumn("locationid", unless(F.col("locationid") % 53 == 0, "locationid")))
    for name, key, label in (
        ("ref_vendors", "vendor_id", "vendor_name"), ("ref_rate_codes", "rate_code_id", "rate_code_name"),
        ("ref_payment_types", "payment_type_id", "payment_type_name"),
    ):
        codes = repeated(good.read(name), F.col(key) == 1)
        pipeline.put(store, name, codes.withColumn(label, unless(F.col(key) == 2, label)).withColumn(key, unless(F.col(key) == 6, key)))
    yield "raw"

    kept = good.read("bronze_yellow_trips").filter((F.col("vendorid") != 7) | (F.year("_source_period") != 1996))
    kept = kept.withColumns(
        {
            "_source_period": unless(zone % 50 == 7, "_source_period"),
            "_bronze_loaded_at": unless(zone % 61 == 5, "_bronze_loaded_at"),
        }
    )
    tables.overwrite(kept, store.path("bronze_yellow_trips"), "_source_file", pipeline.bronze_figures())
    unread("bronze_yellow_trips")
    yield "bronze"

    reason = F.col("rejection_reason")
    judged = good.read(EVALUATED).withColumns(
        {
            "rejection_reason": F.when(reason == W.SOURCE.no_movement, "unheard of").otherwise(reason),
            "trip_id": unless(F.col("pickup_location_id") % 47 == 3, "trip_id"),
        }
    )
    store.write_evaluated(judged, quality.observed(EVALUATED))
    unread(EVALUATED)
    trips = _broken(spark, d)
    pipeline.put(store, "silver_yellow_trips", trips, partition_by="_source_period")
    places = repeated(standin.partial_zones(good.read("silver_taxi_zones"), "location_id"), "location_id % 40 = 1")
    pipeline.put(store, "silver_taxi_zones", places.withColumn("borough", unless(F.col("location_id") % 45 == 2, "borough")))
    yield "silver"
    unread("silver_yellow_trips")

    at = F.col("pickup_zone_key")
    fact = gold.fact_trips(trips).withColumns(
        {
            "pickup_time_key": F.when(at % 90 == 11, 77).otherwise(F.col("pickup_time_key")),
            "dropoff_date_key": unless(at % 71 == 4, "dropoff_date_key"),
            "total_amount": unless(at % 67 == 6, "total_amount"),
        }
    )
    pipeline.put(store, "fct_trips", fact, partition_by="_source_period")
    for name, key, also in (
        ("dim_date", "date_key", "full_date"), ("dim_time", "time_key", "day_period"), ("dim_zone", "zone_key", "borough"),
        ("dim_vendor", "vendor_key", None), ("dim_rate_code", "rate_code_key", None), ("dim_payment_type", "payment_type_key", None),
    ):
        rows = repeated(good.read(name), F.col(key) % 40 == 1)
        rows = rows.withColumn(also, unless(F.col(key) % 31 == 3, also)) if also else rows
        pipeline.put(store, name, rows.withColumn(key, unless(F.col(key) % 53 == 5, key)))
    yield "gold"
    unread("fct_trips")


def _damaged(spark, d) -> Store:
    """A store with all rows of the damaged tables."""
    store = Store(spark, scratch_path(spark, "damaged"))
    for _ in _damaged_layers(spark, d, store, unread=lambda table: None):
        pass
    return store


@query
def quality_gate_damaged(spark, d):
    """Every check over tables in which every kind of check has offenders; a layer is checked before the next is written."""
    store, found = Store(prepare(spark), scratch_path(spark, "damaged")), scratch_path(spark, "damaged-checks")
    for layer in _damaged_layers(spark, d, store, unread=lambda table: tables.drop_rows(spark, store.path(table))):
        results = quality.stored_results(layer, store)
        results.coalesce(1).write.mode("append").parquet(found)
    return spark.read.schema(results.schema).parquet(found)


# --- Profiles --------------------------------------------------------------------------


@query
def profile_completeness(spark, d):
    return profile.completeness(_bronze(spark, d))


@query
def profile_categories(spark, d):
    return profile.categories(_bronze(spark, d))


@query
def profile_duplicates(spark, d):
    return profile.duplicates(_bronze(spark, d))


@query
def profile_orphans(spark, d):
    return profile.orphan_zones(_bronze(spark, d), standin.partial_zones(_zones(spark, d)))


@query
def profile_catalog(spark, d):
    odd = profile.suspect_zones(_zones(spark, d))
    return gold.with_trips(odd, "locationid", _bronze(spark, d), "pulocationid")


@query
def profile_negative_amounts(spark, d):
    return profile.negative_amounts(_bronze(spark, d))


@query
def profile_duplicate_patterns(spark, d):
    return profile.duplicate_patterns(_bronze(spark, d))


@query
def profile_zero_matrix(spark, d):
    return profile.zero_matrix(_bronze(spark, d))


# --- The whole job ---------------------------------------------------------------------


@query
def pipeline_run(spark, d):
    """A full checked build from the landing table to gold in a store of its own."""
    store = _beside(spark, d, "run")
    pipeline.build(store)
    return gold.additive(store.read("fct_trips"), ["vendor_key", "has_reversal"])
