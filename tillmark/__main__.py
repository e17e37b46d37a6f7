"""The nightly run from the command line: python -m tillmark RAW_DIR ROOT [--steps gate,silver]."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tillmark.plans import pipeline


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillmark", description=__doc__)
    parser.add_argument("raw_dir", help="folder of the CSV exports")
    parser.add_argument("root", help="folder of the tables, the load state and the reports")
    parser.add_argument("--day", type=date.fromisoformat, help="date of the reports (today)")
    parser.add_argument(
        "--steps", default=",".join(pipeline.STEPS),
        help="which steps to run, in this order whatever the order given; default: %(default)s",
    )
    parser.add_argument(
        "--late", action="store_true",
        help="also take orders of the last loaded day and lines that come before or after their orders",
    )
    given = parser.parse_args(arguments)
    steps = given.steps.split(",")
    unknown = set(steps) - set(pipeline.STEPS)
    if unknown:
        parser.error(f"unknown steps: {', '.join(sorted(unknown))}")
    spark = SparkSession.builder.appName("tillmark").getOrCreate()
    result = pipeline.run(spark, given.raw_dir, given.root, day=given.day, steps=steps, late=given.late)
    for table, rows in result.audit.items():
        print(f"{table}\t{rows}")


if __name__ == "__main__":
    main()
