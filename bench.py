"""Times the layer builds and the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from fareline.plans import pipeline, registered
from fareline.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Layer builds come first, in order; the reports after them read the stored layers.
REPORTS = [
    "fact_trips", "star_report", "role_playing_report", "derived_measures", "additive_measures",
    "net_revenue", "rejections_by_reason", "silver_dedup_rank", "silver_quarantine",
    "bronze_incremental", "change_detection", "check_unique", "check_relationships",
    "profile_completeness", "profile_categories", "profile_duplicates", "profile_orphans",
    "profile_negative_amounts", "profile_duplicate_patterns", "profile_zero_matrix",
]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        begin = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - begin, 3)

    layers = registered.layers(spark, SF_DIR)
    layers.raw()  # the stand-in's landing tables are a fixture, not a measured step
    timed("build_bronze", layers.bronze)
    timed("build_silver", layers.silver)
    timed("build_gold", layers.gold)
    for layer in ("raw", "bronze", "silver", "gold"):
        timed(f"check_{layer}", lambda: pipeline.check(layers.store, layer))
    for name in REPORTS:
        query = registered.QUERIES[name]
        timed(name, lambda: query(spark, SF_DIR).write.mode("overwrite").format("noop").save())

    rows = layers.store.read("bronze_yellow_trips").count()
    build = sum(seconds[n] for n in ("build_bronze", "build_silver", "build_gold"))
    check = sum(seconds[f"check_{layer}"] for layer in ("raw", "bronze", "silver", "gold"))
    print(
        json.dumps(
            {
                "metric": "layer builds, checks and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "bronze_rows": rows,
                "bronze_rows_per_sec_through_build": round(rows / build),
                "bronze_rows_per_sec_through_checks": round(rows / check),
                "bronze_rows_per_sec_through_build_and_checks": round(rows / (build + check)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
