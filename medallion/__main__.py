"""Run the trip preset: ``spark-submit run.py`` or ``python -m medallion``.

The steps can run as separate jobs in the order bronze, silver, staging, gold, check;
``all`` runs them in one application behind the input check.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame

from medallion.operators.checks import require_passed
from medallion.operators.enrich import BROADCAST_BYTES
from medallion.operators.numbering import RANGE_ROWS
from medallion.plans import pipeline
from medallion.session import build_session
from medallion.sources.files import MONTH_LAYOUT, parse_months, require_inputs

STEPS = ["inputs", "bronze", "silver", "staging", "gold", "check", "all"]


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="medallion", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--trips-root", required=True, help="folder of the monthly raw files")
    parser.add_argument("--lookup", required=True, help="zone lookup CSV with header")
    given = os.environ.get("RAW_TRIP_MONTHS")
    parser.add_argument(
        "--months", default=given, required=not given, help="comma list, default from RAW_TRIP_MONTHS"
    )
    parser.add_argument(
        "--fill", action="append", default=[], metavar="COLUMN=TYPE",
        help="column that a month may lack or have in another type",
    )
    parser.add_argument("--layout", default=MONTH_LAYOUT, help="path of a month below the root")
    parser.add_argument("--raw", default="raw", help="namespace of raw and clean tables")
    parser.add_argument("--staging", default="staging", help="namespace of the views")
    parser.add_argument("--gold", default="gold", help="namespace of the marts")
    parser.add_argument("--location", help="folder for namespaces that do not exist yet")
    parser.add_argument("--provider", help="table format, e.g. iceberg; default parquet")
    parser.add_argument("--partition-by", action="append", default=[], help="trip table partitions")
    parser.add_argument("--coalesce", type=int, help="number of raw output files")
    parser.add_argument("--check-before-publish", action="store_true")
    parser.add_argument("--allow-empty", action="store_true", help="no trip at all is no failure")
    parser.add_argument(
        "--broadcast-bytes", type=int, default=BROADCAST_BYTES,
        help="largest lookup to broadcast; a larger one is shuffled, with the same result",
    )
    parser.add_argument("--resume", action="store_true", help="with all: leave out steps that are done")
    parser.add_argument("--range-rows", type=int, default=RANGE_ROWS, help="rows a task numbers")
    return parser.parse_args(arguments)


def configure(options: argparse.Namespace) -> pipeline.RunConfig:
    return pipeline.RunConfig(
        trips_root=options.trips_root,
        lookup_path=options.lookup,
        months=parse_months(options.months),
        layers=pipeline.Layers(options.raw, options.staging, options.gold),
        location=options.location,
        layout=options.layout,
        provider=options.provider,
        coalesce_to=options.coalesce,
        partition_by=tuple(options.partition_by),
        check_before_publish=options.check_before_publish,
        fill=dict(pair.split("=", 1) for pair in options.fill) or None,
        allow_empty=options.allow_empty,
        broadcast_bytes=options.broadcast_bytes,
        range_rows=options.range_rows,
        resume=options.resume,
    )


def display(report: DataFrame) -> None:
    """All rows of a report, evaluated once: a row per month, step or check."""
    rows = report.collect()
    print(*report.columns, sep=" | ")
    for row in rows:
        print(*row, sep=" | ")


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    config = configure(options)
    spark = build_session("medallion")
    if options.step == "inputs":
        display(require_inputs(spark, config.trips_root, config.months, config.layout))
    elif options.step == "bronze":
        pipeline.bronze(spark, config)
    elif options.step == "silver":
        report = pipeline.silver(spark, config)
        print(report.summary.asDict())
        display(report.steps)
    elif options.step == "staging":
        pipeline.staging(spark, config)
    elif options.step == "gold":
        pipeline.gold(spark, config)
    elif options.step == "check":
        display(require_passed(pipeline.check(spark, config)))
    else:
        display(pipeline.run(spark, config))


if __name__ == "__main__":
    main()
