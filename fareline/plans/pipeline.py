"""The batch job: land, bronze, silver, gold, each layer behind its checks."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import words as W
from fareline.operators import bronze, gold, quality, silver
from fareline.schemas import SEEDS, TRIP_COLUMNS, TRIP_FILE_PREFIX, ZONE_FILE
from fareline.session import scratch_path, sized_for
from fareline.sources import landing, ledger, tables
from fareline.sources.store import Store


class LoadFailed(RuntimeError):
    """At least one requested file could not be loaded; `results` has the run's ledger rows."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


@dataclass(frozen=True)
class Request:
    """What one run should do."""

    landing: str
    first: date
    last: date
    today: date
    force: bool = False  # load files again although nothing changed
    full_refresh: bool = False  # rebuild bronze from all landed rows
    prefix: str = TRIP_FILE_PREFIX
    words: W.Words = W.SOURCE


def _now() -> datetime:
    return datetime.now(timezone.utc)


# --- Landing ---------------------------------------------------------------------------


def _attempt(request: Request, file: str, period, status, rows, size, started, message) -> tuple:
    url = f"{request.landing.rstrip('/')}/{file}"
    return (file, period, url, status, rows, size, started, _now(), message or "")


def load_zones(store: Store, request: Request) -> tuple:
    """Replace the zone list as a whole; a failure becomes a ledger row."""
    started, size = _now(), None
    path = f"{request.landing.rstrip('/')}/{ZONE_FILE}"
    try:
        size = tables.file_bytes(store.spark, path)
        put(store, "taxi_zones", landing.read_zone_file(store.spark, path))
        count = store.figures("taxi_zones")["rows"]
    except Exception as error:
        return _attempt(request, ZONE_FILE, None, W.FAILED, None, size, started, str(error))
    return _attempt(request, ZONE_FILE, None, W.LOADED, count, size, started, "ok")


Log = Callable[[list[tuple]], None]


def load_files(store: Store, request: Request, wanted: list, log: Log) -> None:
    """Replace the rows of the wanted files; `log` takes the attempts as they end.

    Files whose footer cannot be read fail at once. The others are loaded in one job. If that
    fails the batch is halved and both halves run at the same time, so one bad file among n
    costs some 2 log2(n) jobs more and keeps none of the others out.
    """
    started = _now()
    folder = request.landing.rstrip("/")
    files = {w.source_file: f"{folder}/{w.source_file}" for w in wanted}
    schemas, broken = landing.footers(store.spark, list(files.values()))

    def failed(one, message: str) -> tuple:
        return _attempt(request, one.source_file, one.source_period, W.FAILED, None, one.size_bytes, started, message)

    log([failed(w, broken[files[w.source_file]]) for w in wanted if files[w.source_file] in broken])

    def load(batch: list) -> None:
        try:
            ended = _replaced(store, request, batch, [files[w.source_file] for w in batch], schemas, started)
        except Exception as error:
            if len(batch) == 1:
                log([failed(batch[0], str(error))])
                return
            half = len(batch) // 2
            with ThreadPoolExecutor(2) as pool:
                list(pool.map(load, [batch[:half], batch[half:]]))
            return
        log(ended)

    good = [w for w in wanted if files[w.source_file] in schemas]
    if good:
        load(good)


def landing_figures() -> dict:
    """Figures kept of every landed file: rows, offenders of row tests, newest load, a fingerprint of its contents."""
    return {**quality.observed("yellow_trips"), **tables.marks(), **tables.content([*TRIP_COLUMNS])}


def bronze_figures() -> dict:
    return {**quality.observed("bronze_yellow_trips"), **tables.marks()}


def _replaced(store, request: Request, wanted: list, paths: list[str], schemas: dict, started) -> list[tuple]:
    """Replace the rows of files in one commit; the counts are those of the written parts."""
    batch = landing.read_trip_files(store.spark, paths, schemas)
    names = [w.source_file for w in wanted]
    # A file that came without rows is not among the parts; its older rows go in the same commit.
    written = tables.replace_by_file(batch, store.path("yellow_trips"), figures=landing_figures(), names=names)
    return [
        _attempt(
            request, w.source_file, w.source_period, W.LOADED,
            written.get(w.source_file, {}).get("rows", 0), w.size_bytes, started, "ok",
        )
        for w in wanted
    ]


def land(store: Store, request: Request) -> DataFrame:
    """Bring the requested files into the landing tables; returns this run's ledger rows.

    Rows are appended to the ledger when their attempt ends, so a run that dies later leaves
    what it did until then. If the landing directory cannot be listed, every requested month
    is a failed attempt.
    """
    spark = store.spark
    attempts: list[tuple] = []
    one_at_a_time = threading.Lock()

    def log(rows: list[tuple]) -> None:
        if rows:
            with one_at_a_time:
                attempts.extend(rows)
                tables.append(ledger.entries(spark, rows), store.path("ingestion_log"))

    log([load_zones(store, request)])
    periods = landing.requested_periods(spark, request.first, request.last, request.prefix)
    started = _now()
    try:
        verdicts = landing.load_verdicts(
            periods,
            landing.inventory(spark, request.landing),
            ledger.latest_loads(store.read("ingestion_log")),
            tables.rows_present(spark, store.path("yellow_trips")),
            request.today,
            request.force,
        )
        decided = verdicts.orderBy("source_period").collect()  # one row per requested month
    except Exception as error:
        log([
            _attempt(request, month.source_file, month.source_period, W.FAILED, None, None, started, str(error))
            for month in periods.orderBy("source_period").collect()
        ])
        return ledger.entries(spark, attempts)
    log([
        _attempt(
            request, row.source_file, row.source_period, row.verdict,
            row.rows_loaded, row.size_bytes, _now(), row.message,
        )
        for row in decided if row.verdict != landing.LOAD
    ])
    load_files(store, request, [r for r in decided if r.verdict == landing.LOAD], log)
    return ledger.entries(spark, attempts)


# --- Layers ----------------------------------------------------------------------------


def check(store: Store, layer: str, words: W.Words = W.SOURCE) -> None:
    """Run a layer's checks, keep their result, and stop the run on any offender."""
    results = quality.stored_results(layer, store, words).withColumn("layer", F.lit(layer))
    tables.replace_by_file(results.coalesce(1), store.path("check_results"), key="layer", names=[layer])
    quality.gate(layer, store.read("check_results").filter(F.col("layer") == layer))


def put(store: Store, table: str, df: DataFrame, words: W.Words = W.SOURCE, partition_by: str | None = None) -> None:
    """Write a table, and count the offenders of its row tests on the way."""
    store.write(table, df, partition_by, quality.observed(table, words))


def build_seeds(store: Store) -> None:
    for name in SEEDS:
        put(store, name, landing.seed(store.spark, name))


def _sized(store: Store):
    return sized_for(store.spark, tables.stored_bytes(store.spark, store.path("yellow_trips")))


def build_bronze(store: Store, full_refresh: bool = False) -> None:
    with _sized(store):
        if full_refresh or not store.has("bronze_yellow_trips"):
            tables.overwrite(
                bronze.bronze_trips(store.read("yellow_trips")), store.path("bronze_yellow_trips"),
                partition_by="_source_file", figures=bronze_figures(),
            )
        else:
            refresh_bronze_trips(store)
        put(store, "bronze_taxi_zones", bronze.bronze_zones(store.read("taxi_zones")))


def refresh_bronze_trips(store: Store) -> None:
    """Replace the changed files in one commit.

    Which files changed is in the manifests of both tables; only the changed ones are opened.
    """
    landed, target = store.path("yellow_trips"), store.path("bronze_yellow_trips")
    changed = bronze.changed_marks(tables.parts(store.spark, landed), tables.parts(store.spark, target))
    names = [r["source_file"] for r in changed.collect()]  # one row per file
    if names:
        batch = store.read("yellow_trips").filter(F.col("_source_file").isin(names))
        tables.replace_by_file(bronze.bronze_trips(batch), target, figures=bronze_figures(), names=names)


def build_silver(store: Store, words: W.Words = W.SOURCE) -> None:
    """Evaluated rows and silver, both by month; a month's silver is written from its own files."""
    now = F.current_timestamp().alias("_silver_loaded_at")
    scratch = scratch_path(store.spark, "silver")
    with _sized(store):
        judged = silver.evaluate(store.read("bronze_yellow_trips"), words, scratch)
        store.write_evaluated(judged.select("*", now), quality.observed("silver_yellow_trips_evaluated", words))
        tables.drop_folder(store.spark, scratch)
        clean = silver.repaired(store.accepted()).select(*silver.SILVER_COLUMNS, "_silver_loaded_at")
        put(store, "silver_yellow_trips", clean, words, "_source_period")
        put(store, "silver_taxi_zones", silver.silver_zones(store.read("bronze_taxi_zones")), words)


def build_gold(store: Store, words: W.Words = W.SOURCE) -> None:
    trips, read = store.read("silver_yellow_trips"), store.read
    models: dict[str, Callable[[], DataFrame]] = {
        "fct_trips": lambda: gold.fact_trips(trips),
        "dim_date": lambda: gold.dim_date(trips, words),
        "dim_time": lambda: gold.dim_time(store.spark, words),
        "dim_zone": lambda: gold.dim_zone(read("silver_taxi_zones")),
        "dim_vendor": lambda: gold.dim_vendor(read("ref_vendors")),
        "dim_rate_code": lambda: gold.dim_rate_code(read("ref_rate_codes")),
        "dim_payment_type": lambda: gold.dim_payment_type(read("ref_payment_types"), words),
    }
    with _sized(store):
        for name, model in models.items():
            put(store, name, model(), words, "_source_period" if name == "fct_trips" else None)


def build(store: Store, words: W.Words = W.SOURCE, full_refresh: bool = False) -> None:
    """Everything after landing, in order, each layer behind its checks."""
    with _sized(store):
        build_seeds(store)
        check(store, "raw", words)
        build_bronze(store, full_refresh)
        check(store, "bronze", words)
        build_silver(store, words)
        check(store, "silver", words)
        build_gold(store, words)
        check(store, "gold", words)
    store.vacuum()


def run(spark: SparkSession, root: str, request: Request) -> DataFrame:
    """One full run; returns its ledger rows. Raises on a failed load or a failed check."""
    store = Store(spark, root)
    results = land(store, request)
    if not results.filter(F.col("status") == W.FAILED).isEmpty():
        raise LoadFailed("some files failed, see the ledger", results)
    build(store, request.words, request.full_refresh)
    return results

