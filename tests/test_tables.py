"""Versioned tables: what readers see while writers write, die, and clean up."""

import os

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from fareline.operators import bronze, quality
from fareline.plans import pipeline
from fareline.schemas import TRIP_COLUMNS
from fareline.sources import tables


def trips(spark, **counts):
    """`count` trips of each file, told apart by their fare."""
    return raw(
        spark,
        *[{"_source_file": f"trips_{f}.parquet", "fare_amount": float(k)} for f, n in counts.items() for k in range(n)],
    )


def seen(spark, path):
    return rows(tables.read(spark, path).groupBy("_source_file").count(), "_source_file", "count")


@pytest.fixture
def path(spark, tmp_path):
    place = str(tmp_path / "trips")
    tables.overwrite(trips(spark, a=3, b=4, c=5), place, "_source_file", tables.marks())
    return place


OLD = [("trips_a.parquet", 3), ("trips_b.parquet", 4), ("trips_c.parquet", 5)]
NEW = [("trips_a.parquet", 1), ("trips_b.parquet", 2)]


class Killed(BaseException):
    """Not an Exception: nothing on the way may catch it."""


@pytest.mark.parametrize("point", ["files", "listing", "figures", "draft", "rename", "done"])
def test_a_writer_that_dies_leaves_the_old_or_the_new_version(spark, path, monkeypatch, point):
    """Replacing two files and taking one away, killed at any point."""

    def die(*_, **__):
        raise Killed

    batch = trips(spark, a=1, b=2)
    if point == "files":  # some tasks have written, others have not
        lost = F.when(F.col("_source_file") == "trips_b.parquet", F.raise_error(F.lit("gone")).cast("double"))
        batch = batch.withColumn("fare_amount", F.coalesce(lost, "fare_amount"))
    real_place = tables._place
    with monkeypatch.context() as patch:
        if point == "listing":
            patch.setattr(tables, "_listed", die)
        if point == "figures":
            patch.setattr(tables, "_figures_of", die)
        if point == "draft":
            patch.setattr(tables.Manifest, "text", die)
        if point == "rename":
            def place(spark, name):
                files, found = real_place(spark, name)
                if name.endswith(".json") and "manifests" in name and name > f"{path}/manifests/000000000001.json":
                    raise Killed
                return files, found
            patch.setattr(tables, "_place", place)
        try:
            tables.replace_by_file(batch, path, figures=tables.marks(), names=["trips_c.parquet"])
        except (Killed, Exception):
            assert point != "done"
    assert seen(spark, path) == (NEW if point == "done" else OLD)
    # The next writer is not hindered by what was left.
    tables.replace_by_file(trips(spark, a=1, b=2), path, figures=tables.marks(), names=["trips_c.parquet"])
    assert seen(spark, path) == NEW
    tables.vacuum(spark, path, keep=1)
    assert seen(spark, path) == NEW and len(os.listdir(f"{path}/data")) == 1


def test_a_reader_keeps_the_version_it_began_with(spark, path):
    reading = tables.read(spark, path)
    tables.replace_by_file(trips(spark, a=1), path)
    tables.overwrite(trips(spark, d=9), path, "_source_file")
    assert rows(reading.groupBy("_source_file").count(), "_source_file", "count") == OLD
    assert seen(spark, path) == [("trips_d.parquet", 9)]


def test_a_table_may_be_rebuilt_from_itself(spark, path):
    tables.overwrite(tables.read(spark, path).filter("fare_amount > 0"), path, "_source_file")
    assert [n for _, n in seen(spark, path)] == [2, 3, 4]


def test_a_second_writer_of_the_same_version_fails(spark, path):
    manifest = tables.current(spark, path)
    with pytest.raises(tables.ConcurrentCommit):
        tables._commit(spark, path, manifest)
    assert seen(spark, path) == OLD


def test_replacing_one_file_writes_only_that_file(spark, path):
    before = set(os.listdir(f"{path}/data"))
    tables.replace_by_file(trips(spark, b=1), path)
    (fresh,) = set(os.listdir(f"{path}/data")) - before
    assert [n for n in os.listdir(f"{path}/data/{fresh}") if "=" in n] == ["_source_file=trips_b.parquet"]
    assert [n for _, n in seen(spark, path)] == [3, 1, 5]


def test_clones_share_files_until_they_are_replaced(spark, path, tmp_path):
    other = str(tmp_path / "clone")
    tables.clone(spark, path, other)
    assert seen(spark, other) == OLD and not os.path.exists(f"{other}/data")
    tables.replace_by_file(trips(spark, a=7), other)
    tables.without_files(spark, other, ["trips_c.parquet"])
    assert seen(spark, other) == [("trips_a.parquet", 7), ("trips_b.parquet", 4)] and seen(spark, path) == OLD
    tables.vacuum(spark, other, keep=1)
    assert seen(spark, other) == [("trips_a.parquet", 7), ("trips_b.parquet", 4)]


def test_marks_and_counts_open_no_file(spark, path, tmp_path):
    copy = str(tmp_path / "bronze")
    tables.overwrite(trips(spark, a=3, b=4), copy, "_source_file", tables.marks())
    changed = bronze.changed_marks(tables.parts(spark, path), tables.parts(spark, copy))
    for df in (changed, tables.rows_present(spark, path)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "parquet" not in plan.replace("trips_", "")
    assert rows(changed, "source_file", "gone") == [("trips_c.parquet", False)]
    assert rows(tables.rows_present(spark, path), "source_file", "rows_present") == OLD


def test_empty_tables_and_files_without_a_name(spark, tmp_path):
    place = str(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        tables.read(spark, place)
    tables.overwrite(trips(spark), place, "_source_file", tables.marks())
    assert tables.read(spark, place).count() == 0 and tables.parts(spark, place).count() == 0
    odd = raw(spark, {"_source_file": None}, {"_source_file": "a b=c%.parquet"}, {"_source_file": "a b=c%.parquet"})
    tables.replace_by_file(odd, place, figures=tables.marks())
    assert seen(spark, place) == [("a b=c%.parquet", 2), (None, 1)]
    assert sorted(r.rows for r in tables.parts(spark, place).collect()) == [1, 2]


def test_contents_tell_rows_apart_that_counts_do_not(spark, tmp_path):
    place = str(tmp_path / "raw")
    landed = trips(spark, a=4, b=4, c=4).withColumn("extra", F.when(F.col("fare_amount") > 1, F.col("extra")))
    kept = landed.withColumn("fare_amount", F.when(F.col("_source_file") == "trips_b.parquet", 1.0).otherwise(F.col("fare_amount")))
    # NULL and value change places between two columns.
    c = (F.col("_source_file") == "trips_c.parquet") & F.col("extra").isNull()
    kept = kept.withColumns({"extra": F.when(c, F.col("mta_tax")).otherwise(F.col("extra")), "mta_tax": F.when(~c, F.col("mta_tax"))})
    tables.overwrite(landed, place, "_source_file", pipeline.landing_figures())
    gaps = quality.content_gaps(tables.parts(spark, place), bronze.bronze_trips(kept.orderBy(F.desc("fare_amount"))))
    assert rows(gaps, "_source_file", "raw_rows", "bronze_rows") == [("trips_b.parquet", 4, 4), ("trips_c.parquet", 4, 4)]
    same = quality.content_gaps(tables.parts(spark, place), bronze.bronze_trips(landed.orderBy(F.desc("fare_amount"))))
    assert same.isEmpty() and len(TRIP_COLUMNS) == 20
