"""Data checks. Each check has an offender query (empty = pass); a gate counts them all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import words as W
from fareline.functions import columns as C
from fareline.operators import silver
from fareline.schemas import TRIP_COLUMNS
from fareline.session import scratch_path
from fareline.sources import tables
from fareline.sources.store import Store

RESULT_COLUMNS = ["check", "offenders"]


# --- Offender queries ----------------------------------------------------------------


def null_rows(table: DataFrame, column: str) -> DataFrame:
    return table.filter(F.col(column).isNull())


def repeated_values(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL does not count as a value."""
    counts = table.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference is not in the parent; a NULL reference is not an offence."""
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    return child.filter(F.col(column).isNotNull()).join(
        keys, child[column] == keys["_parent_key"], "left_anti"
    )


def unexpected_values(table: DataFrame, column: str, allowed: list) -> DataFrame:
    return table.filter(~F.col(column).isin(*allowed))


def file_count_gaps(raw: DataFrame, bronze: DataFrame) -> DataFrame:
    """Files whose row counts differ between the landing table and bronze."""

    def counts(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("_source_file").agg(F.count("*").alias(name))

    both = counts(raw, "raw_rows").join(counts(bronze, "bronze_rows"), "_source_file", "full_outer")
    return both.filter(~F.col("raw_rows").eqNullSafe(F.col("bronze_rows")))


def content_gaps(landed: DataFrame, bronze: DataFrame) -> DataFrame:
    """Files whose rows differ between the landing table and bronze, also where their counts agree.

    `landed` holds the figures of the landing table's manifest, taken when its files were written; bronze is scanned
    once. Compared are multisets of the source columns: order does not matter, copies do.
    """
    kept = bronze.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count("*").alias("bronze_rows"),
        *[figure.alias(f"kept_{name}") for name, figure in tables.content(TRIP_COLUMNS).items()],
    )
    both = landed.select("source_file", F.col("rows").alias("raw_rows"), "content_sum", "content_xor").join(
        kept, "source_file", "full_outer"
    )
    same = (
        F.col("raw_rows").eqNullSafe(F.col("bronze_rows"))
        & F.col("content_sum").eqNullSafe(F.col("kept_content_sum"))
        & F.col("content_xor").eqNullSafe(F.col("kept_content_xor"))
    )
    return both.filter(~same).select(F.col("source_file").alias("_source_file"), "raw_rows", "bronze_rows")


def split_gap(bronze: DataFrame, valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row when bronze is not valid plus rejected."""

    def rows(table: DataFrame) -> DataFrame:
        return table.agg(F.count("*").alias("rows"))

    counts = rows(bronze).select(
        F.col("rows").alias("bronze_rows"),
        rows(valid).scalar().alias("valid_rows"),
        rows(rejected).scalar().alias("rejected_rows"),
    )
    return counts.filter("bronze_rows <> valid_rows + rejected_rows")


def silver_rule() -> Column:
    """True for a clean row that breaks a rule all the same."""
    total, miles = F.col("total_amount"), F.col("trip_distance_miles")
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return C.any_of(
        [
            ~total.between(0, silver.MAX_TOTAL),
            F.col("fare_amount") < 0,
            dropoff < pickup,
            C.seconds_between(pickup, dropoff) > silver.MAX_SECONDS,
            C.month_start(pickup) != F.col("_source_period"),
            (miles <= 0) | (miles > silver.MAX_MILES),
            F.col("trip_duration_minutes") <= 0,
            ~F.col("passenger_count").between(*silver.PASSENGERS),
        ]
    )


def silver_rule_rows(trips: DataFrame) -> DataFrame:
    return trips.filter(silver_rule()).select(
        "trip_id", "pickup_datetime", "dropoff_datetime", "trip_distance_miles",
        "passenger_count", "fare_amount", "total_amount",
    )


def total_gap(trips: DataFrame, fact: DataFrame) -> DataFrame:
    """One row when the fact table has other rows or another revenue than silver."""

    def totals(table: DataFrame) -> DataFrame:
        return table.agg(
            F.struct(F.count("*").alias("n"), F.sum("total_amount").alias("t")).alias("s")
        )

    both = totals(trips).select(
        F.col("s").alias("silver"), totals(fact).scalar().alias("gold")
    ).select(
        F.col("silver.n").alias("silver_rows"), F.col("gold.n").alias("gold_rows"),
        F.col("silver.t").alias("silver_total"), F.col("gold.t").alias("gold_total"),
    )
    return both.filter("silver_rows <> gold_rows or silver_total <> gold_total")


# --- Declared checks per table --------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> parent
    accepted: dict[str, list] = field(default_factory=dict)


TRIP_REFERENCES = {
    "vendor_id": ("ref_vendors", "vendor_id"),
    "rate_code_id": ("ref_rate_codes", "rate_code_id"),
    "pickup_location_id": ("silver_taxi_zones", "location_id"),
    "dropoff_location_id": ("silver_taxi_zones", "location_id"),
    "payment_type_id": ("ref_payment_types", "payment_type_id"),
}
FACT_REFERENCES = {
    "pickup_date_key": ("dim_date", "date_key"),
    "pickup_time_key": ("dim_time", "time_key"),
    "dropoff_date_key": ("dim_date", "date_key"),
    "dropoff_time_key": ("dim_time", "time_key"),
    "pickup_zone_key": ("dim_zone", "zone_key"),
    "dropoff_zone_key": ("dim_zone", "zone_key"),
    "vendor_key": ("dim_vendor", "vendor_key"),
    "rate_code_key": ("dim_rate_code", "rate_code_key"),
    "payment_type_key": ("dim_payment_type", "payment_type_key"),
}


def declared(words: W.Words = W.SOURCE) -> dict[str, dict[str, TableChecks]]:
    """The 83 column checks: layer -> table -> checks."""
    seeds = {
        name: TableChecks([key, label], [key])
        for name, key, label in (
            ("ref_vendors", "vendor_id", "vendor_name"),
            ("ref_rate_codes", "rate_code_id", "rate_code_name"),
            ("ref_payment_types", "payment_type_id", "payment_type_name"),
        )
    }
    return {
        "raw": {
            "yellow_trips": TableChecks(["_source_file", "_loaded_at"]),
            "taxi_zones": TableChecks(["locationid"], ["locationid"]),
            **seeds,
        },
        "bronze": {
            "bronze_yellow_trips": TableChecks(
                ["_source_file", "_source_period", "_loaded_at", "_bronze_loaded_at"]
            ),
            "bronze_taxi_zones": TableChecks(
                ["locationid", "_source_file", "_loaded_at"], ["locationid"]
            ),
        },
        "silver": {
            "silver_yellow_trips_evaluated": TableChecks(
                ["trip_id"], accepted={"rejection_reason": words.reasons}
            ),
            "silver_yellow_trips_rejected": TableChecks(["rejection_reason"]),
            "silver_yellow_trips": TableChecks(
                ["trip_id", "pickup_datetime", "dropoff_datetime", *TRIP_REFERENCES,
                 "total_amount", "has_reversal"],
                ["trip_id"],
                TRIP_REFERENCES,
            ),
            "silver_taxi_zones": TableChecks(
                ["location_id", "borough", "zone_name", "service_zone"], ["location_id"]
            ),
        },
        "gold": {
            "fct_trips": TableChecks(
                ["trip_id", *FACT_REFERENCES, "total_amount"], ["trip_id"], FACT_REFERENCES
            ),
            "dim_date": TableChecks(["date_key", "full_date"], ["date_key", "full_date"]),
            "dim_time": TableChecks(["time_key", "day_period"], ["time_key"]),
            "dim_zone": TableChecks(["zone_key", "borough", "zone_name"], ["zone_key"]),
            "dim_vendor": TableChecks(["vendor_key"], ["vendor_key"]),
            "dim_rate_code": TableChecks(["rate_code_key"], ["rate_code_key"]),
            "dim_payment_type": TableChecks(["payment_type_key"], ["payment_type_key"]),
        },
    }


# --- Counting the offenders -----------------------------------------------------------


def _results(df: DataFrame, check: Column | str, offenders: Column) -> DataFrame:
    name = F.lit(check) if isinstance(check, str) else check
    return df.select(name.alias("check"), offenders.cast("bigint").alias("offenders"))


def count_row_tests(table: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Offenders of many row-wise tests from a single pass over the table."""
    names = list(tests)
    counts = table.agg(*[F.count_if(tests[name]).alias(f"c{i}") for i, name in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("n")) for i, name in enumerate(names)]
    )
    return _results(counts.select(F.inline(pairs)), F.col("check"), F.col("n"))


def count_orphans(child: DataFrame, references: dict[str, tuple[DataFrame, str]], prefix: str) -> DataFrame:
    """Offenders of all references of a table from a single pass over it.

    Each column is reduced to its distinct values with counts before any join, so neither
    the size of the table nor a value shared by most rows reaches the join.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value")) for c in references]
    )
    values = (
        child.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("name", "value").agg(F.count("*").alias("n"))
    )
    parents = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(c).alias("name"), F.col(key).cast("bigint").alias("value"))
            for c, (parent, key) in references.items()
        ],
    )
    lost = values.join(parents, ["name", "value"], "left_anti").select("name", "n")
    # Every reference gets a line, also one without offenders or with an empty parent.
    zero = child.sparkSession.createDataFrame([(c, 0) for c in references], "name string, n bigint")
    lines = lost.unionByName(zero).groupBy("name").agg(F.sum("n").alias("n"))
    return _results(lines, F.concat(F.lit(f"{prefix}.references."), "name"), F.col("n"))


def count_repeats(columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Repeated values of many columns, also of different tables.

    Values are counted by a hash first, so only hashes are exchanged; values whose hash occurs again, few in
    a sound table, are then counted themselves. The hashes that do are written, so that their
    size is known and small ones go to the rows instead of the rows to them.
    """
    names = list(columns)
    values = reduce(
        DataFrame.unionByName,
        [
            table.select(F.lit(i).alias("i"), F.col(column).cast("string").alias("value"))
            for i, (table, column) in enumerate(columns.values())
        ],
    )
    spark, path = values.sparkSession, scratch_path(values.sparkSession, "repeats")
    values = values.filter(F.col("value").isNotNull()).withColumn("hash", F.xxhash64("value"))
    seen = values.groupBy("i", "hash").agg(F.count("*").alias("copies")).filter("copies > 1").select("i", "hash")
    seen.write.parquet(path)
    repeated = (
        values.join(spark.read.schema(seen.schema).parquet(path), ["i", "hash"], "left_semi")
        .groupBy("i", "value").agg(F.count("*").alias("copies"))
        .select("i", F.when(F.col("copies") > 1, 1).otherwise(0).alias("n"))
    )
    # Every column gets a line, also one of an empty table.
    zero = spark.createDataFrame([(i, 0) for i in range(len(names))], "i int, n int")
    lines = repeated.unionByName(zero).groupBy("i").agg(F.sum("n").alias("n"))
    return _results(lines, C.pick(F.col("i") + 1, tuple(names)), F.col("n"))


def count_rows(offenders: DataFrame, name: str) -> DataFrame:
    return _results(offenders.agg(F.count("*").alias("n")), name, F.col("n"))


def row_tests(name: str, words: W.Words = W.SOURCE) -> dict[str, Column]:
    """Tests of a table that look at one row at a time: name of the check -> true for an offender."""
    checks = next(found[name] for found in declared(words).values() if name in found)
    tests = {f"{name}.not_null.{c}": F.col(c).isNull() for c in checks.not_null}
    tests |= {f"{name}.accepted.{c}": ~F.col(c).isin(*v) for c, v in checks.accepted.items()}
    return tests | ({"silver_rules": silver_rule()} if name == "silver_yellow_trips" else {})


def observed(name: str, words: W.Words = W.SOURCE) -> dict[str, Column]:
    """Aggregates for the job that writes a table: offenders of its row tests, rows, and money."""
    found = {check: F.count_if(test) for check, test in row_tests(name, words).items()}
    if name == "silver_yellow_trips_evaluated":
        # Rejected rows are a part of this table; their tests are counted over that part.
        part = row_tests("silver_yellow_trips_rejected", words)
        found |= {check: F.count_if(F.col("_rejected") & test) for check, test in part.items()}
        found["rejected"] = F.count_if("_rejected")
    if name in ("silver_yellow_trips", "fct_trips"):
        found["total_amount"] = F.sum("total_amount")
    return {"rows": F.count("*"), **found}


def _several(layer: str, read: Callable[[str], DataFrame], words: W.Words) -> list[DataFrame]:
    """Checks of a layer that compare rows with each other or with another table."""
    parts, unique = [], {}
    for name, checks in declared(words)[layer].items():
        if checks.references:
            parents = {c: (read(parent), key) for c, (parent, key) in checks.references.items()}
            parts.append(count_orphans(read(name), parents, name))
        unique |= {f"{name}.unique.{c}": (read(name), c) for c in checks.unique}
    return parts + ([count_repeats(unique)] if unique else [])


def layer_results(layer: str, read: Callable[[str], DataFrame], words: W.Words = W.SOURCE) -> DataFrame:
    """(check, offenders) for every check of a layer, reconciliations included, by reading its tables."""
    parts = []
    for name in declared(words)[layer]:
        if tests := row_tests(name, words):
            parts.append(count_row_tests(read(name), tests))
    parts += _several(layer, read, words)
    if layer == "bronze":
        gaps = file_count_gaps(read("yellow_trips"), read("bronze_yellow_trips"))
        parts.append(count_rows(gaps, "raw_equals_bronze"))
    if layer == "silver":
        gap = split_gap(
            read("bronze_yellow_trips"), read("silver_yellow_trips"), read("silver_yellow_trips_rejected")
        )
        parts.append(count_rows(gap, "bronze_equals_silver_and_rejected"))
    if layer == "gold":
        parts.append(count_rows(total_gap(read("silver_yellow_trips"), read("fct_trips")), "silver_equals_gold"))
    return reduce(DataFrame.unionByName, parts)


def stored_results(layer: str, store: Store, words: W.Words = W.SOURCE) -> DataFrame:
    """The same for the stored tables of a layer, from what was counted when they were written.

    Row tests, row counts and totals come from the manifests of the versions that are checked; no
    table is scanned for them. Only uniqueness and references read rows. A table that was
    written without its figures is read, as `layer_results` does.
    """
    lines, parts = [], []
    for name in declared(words)[layer]:
        tests, figures = row_tests(name, words), store.figures(name)
        lines += [(check, figures[check]) for check in tests if check in figures]
        if unknown := {check: test for check, test in tests.items() if check not in figures}:
            parts.append(count_row_tests(store.read(name), unknown))

    def total(table: str, figure: str):
        return store.figures(table).get(figure)

    if layer == "bronze":
        landed, kept = store.part_rows("yellow_trips"), store.part_rows("bronze_yellow_trips")
        lines.append(("raw_equals_bronze", sum(landed.get(f) != kept.get(f) for f in landed.keys() | kept.keys())))
    if layer == "silver":
        split = (total("silver_yellow_trips", "rows"), total("silver_yellow_trips_evaluated", "rejected"))
        gap = None in split or sum(split) != sum(store.part_rows("bronze_yellow_trips").values())
        lines.append(("bronze_equals_silver_and_rejected", int(gap)))
    if layer == "gold":
        clean, fact = ([total(t, f) for f in ("rows", "total_amount")] for t in ("silver_yellow_trips", "fct_trips"))
        # As in SQL, a total that is not known does not differ.
        gap = clean[0] != fact[0] or (None not in (clean[1], fact[1]) and Decimal(clean[1]) != Decimal(fact[1]))
        lines.append(("silver_equals_gold", int(gap)))
    counted = store.spark.createDataFrame(lines, "`check` string, offenders bigint")
    return reduce(DataFrame.unionByName, [counted, *parts, *_several(layer, store.read, words)])


class ChecksFailed(RuntimeError):
    """A layer has offenders; nothing after it may be built."""


def gate(layer: str, results: DataFrame) -> None:
    """Raise when a stored check result of the layer has offenders."""
    failed = results.filter("offenders > 0").orderBy("check").collect()  # at most 87 rows
    if failed:
        lines = ", ".join(f"{row['check']} ({row['offenders']})" for row in failed)
        raise ChecksFailed(f"{layer}: {lines}")
