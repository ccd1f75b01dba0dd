"""The contract: names, and one query per area against its SQL twin in DuckDB."""

import glob
import os
import time

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fareline.operators import quality
from fareline.plans import oracle, registered

CHECKED = [
    "requested_periods", "file_inventory_verdict", "ledger_latest_load", "replace_by_file",
    "bronze_incremental", "silver_reason", "silver_dedup_rank", "silver_repairs", "dim_date",
    "star_report", "derived_measures", "check_relationships", "check_silver_rules",
    "profile_duplicates", "profile_negative_amounts", "profile_zero_matrix",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_twin():
    assert set(registered.QUERIES) == set(oracle.statements())
    assert set(registered.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_twin(spark, duck, name):
    mine = contract.queries()[name](spark, SF).toArrow()
    theirs = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    columns = ", ".join(f'"{c}"' for c in sorted(mine.column_names))
    duck.register("mine", mine)
    duck.register("theirs", theirs)
    for a, b in (("mine", "theirs"), ("theirs", "mine")):
        left = f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}"
        assert duck.execute(left).fetchall() == []
    kinds = [
        duck.execute(f"SELECT column_type FROM (DESCRIBE SELECT {columns} FROM {t})").fetchall()
        for t in ("mine", "theirs")
    ]
    assert kinds[0] == kinds[1]


def test_landing_gathers_little_per_task(spark, monkeypatch):
    """The exchanged columns are few and widened afterwards, so a task of the landing takes fewer bytes of them."""
    setting, seen, whole = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], registered.tables.overwrite

    def watched(*given, **more):
        seen.append(spark.conf.get(setting))
        return whole(*given, **more)

    monkeypatch.setattr(registered.tables, "overwrite", watched)
    before = spark.conf.get(setting)
    landed = registered.Built(registered.prepare(spark), SF).raw()
    assert int(seen[0]) <= 8 << 20 and spark.conf.get(setting) == before == "16m"
    assert landed.read("yellow_trips").count() == registered.standin.raw_trips(spark, SF).count()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_damaged_tables_do_not_add_up(spark, tmp_path, monkeypatch):
    """A large damaged table is there alone: rows that nothing reads any more go before others are written."""
    registered.layers(spark, SF).gold()
    large = {"yellow_trips", "bronze_yellow_trips", "silver_yellow_trips_evaluated", "silver_yellow_trips", "fct_trips"}
    there, whole = [], registered.tables.overwrite

    def watched(df, path, *given, **more):
        whole(df, path, *given, **more)
        folders = {os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{tmp_path}/damaged/*/*/data")}
        there.append(sorted(folders & large))

    monkeypatch.setattr(registered.tables, "overwrite", watched)
    monkeypatch.setattr(registered, "scratch_path", lambda spark, name: str(tmp_path / name))
    found = registered.quality_gate_damaged(spark, SF)
    assert {t for tables in there for t in tables} == large and max(map(len, there)) == 1
    assert found.count() == found.select("check").distinct().count() == 87
    assert not any(glob.glob(f"{tmp_path}/damaged/*/{t}/data") for t in large)


def test_what_a_query_shuffled_goes_when_it_ends(spark, tmp_path):
    spark.conf.unset("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    registered.prepare(spark)
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set:
        files = found.getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    before = shuffled()
    spark.range(10_000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "rows"))
    deadline = time.time() + 30
    while shuffled() - before and time.time() < deadline:  # they go in the background
        time.sleep(0.2)
    assert not shuffled() - before


@pytest.fixture(scope="module")
def damaged(spark):
    return registered._damaged(spark, SF)


@pytest.mark.parametrize("layer", ["raw", "bronze", "silver", "gold"])
def test_checks_counted_while_writing_equal_checks_that_read(spark, damaged, layer):
    counted, read = quality.stored_results(layer, damaged), quality.layer_results(layer, damaged.read)
    assert counted.exceptAll(read).isEmpty() and read.exceptAll(counted).isEmpty()
    kinds = {r["check"].split(".")[1] if "." in r["check"] else r["check"] for r in counted.filter("offenders > 0").collect()}
    declared = {r["check"].split(".")[1] if "." in r["check"] else r["check"] for r in counted.collect()}
    assert kinds == declared  # every kind of check has found offenders


def test_row_tests_counts_and_totals_scan_nothing(spark, damaged):
    """What is left to read are the keys and the references, once each."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole paths in plans
    for layer, table, scans in (
        ("raw", "yellow_trips", 0), ("bronze", "bronze_yellow_trips", 0), ("silver", "silver_yellow_trips_evaluated", 0),
        ("silver", "silver_yellow_trips", 2), ("gold", "fct_trips", 2),
    ):
        plan = quality.stored_results(layer, damaged)._jdf.queryExecution().executedPlan()
        assert plan.toString().count(f"/{table}/data") == scans, (layer, table)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
