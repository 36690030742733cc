"""Run the pipeline: python -m groupledger LANDING WAREHOUSE --run-id 2024-05-01."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from .plans.pipeline import run_pipeline
from .plans.warehouse import Settings
from .session import SETTINGS


def main() -> None:
    parser = argparse.ArgumentParser(prog="groupledger", description=__doc__)
    parser.add_argument("landing", help="folder of the landing files")
    parser.add_argument("warehouse", help="folder of the stored tables, shared by all executors")
    parser.add_argument("--run-id", required=True, help="repeat a lost run under its own id")
    parser.add_argument("--calendar-start", type=date.fromisoformat, default=Settings.calendar_start)
    parser.add_argument("--calendar-end", type=date.fromisoformat, default=Settings.calendar_end)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    args = parser.parse_args()

    builder = SparkSession.builder.appName("groupledger")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    settings = Settings(args.calendar_start, args.calendar_end, args.as_of)
    run = run_pipeline(
        builder.getOrCreate(), args.landing, args.warehouse, args.run_id, settings
    )
    run.new_rows.orderBy("target_table").show(truncate=False)
    run.freshness.orderBy("target_table").show(truncate=False)
    run.report.filter("failing_rows > 0").orderBy("table_name", "column_name").show(500, False)


if __name__ == "__main__":
    main()
