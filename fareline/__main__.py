"""Run the pipeline: spark-submit or `python -m fareline --landing DIR --root DIR`."""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime

from pyspark.sql import DataFrame

from fareline import words as W
from fareline.plans import pipeline
from fareline.session import build_session
from fareline.sources import ledger


MESSAGE_SHOWN = 1000  # the ledger keeps whole messages


def month(text: str) -> date:
    try:
        return datetime.strptime(text, "%Y-%m").date()
    except ValueError:
        raise argparse.ArgumentTypeError(f"{text!r} is no month of the form YYYY-MM") from None


def main() -> None:
    parser = argparse.ArgumentParser(prog="fareline", description=__doc__)
    parser.add_argument("--landing", required=True, help="directory with the published files")
    parser.add_argument("--root", required=True, help="directory of the stored layers")
    parser.add_argument("--first", type=month, default="2025-01")
    parser.add_argument("--last", type=month, default="2026-08")
    parser.add_argument("--force", action="store_true", help="load files again although unchanged")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild bronze from all landed rows")
    parser.add_argument("--english", action="store_true", help="store English words as values")
    args = parser.parse_args()

    spark = build_session()
    request = pipeline.Request(
        landing=args.landing, first=args.first, last=args.last, today=date.today(),
        force=args.force, full_refresh=args.full_refresh,
        words=W.ENGLISH if args.english else W.SOURCE,
    )
    try:
        report(pipeline.run(spark, args.root, request))
    except pipeline.LoadFailed as failure:
        report(failure.results)
        sys.exit(str(failure))


def report(results: DataFrame) -> None:
    """Every file of the run, cut at MESSAGE_SHOWN characters of message, and the rows present."""
    for line in ledger.run_lines(results).toLocalIterator():
        message = (line.message or "")[:MESSAGE_SHOWN]
        print(line.source_file, line.status, "-" if line.rows_loaded is None else line.rows_loaded, message, sep="\t")
    print("trip rows", ledger.run_total(results).first()["trip_rows"], sep="\t")


if __name__ == "__main__":
    main()
