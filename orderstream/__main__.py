"""Run a job: ``spark-submit ... -m orderstream {etl,reports,chart} settings.properties``."""

from __future__ import annotations

import argparse
from pathlib import Path

from orderstream import session
from orderstream.config import Settings
from orderstream.operators.dashboard import dashboard_feed
from orderstream.streaming import jobs


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderstream", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    etl = commands.add_parser("etl", help="raw topic to ETL topic")
    etl.add_argument("--open-only", action="store_true", help="keep open orders only")
    reports = commands.add_parser("reports", help="ETL topic to the stored reports")
    reports.add_argument(
        "--sums-together", action="store_true", help="read the topic once for all sums"
    )
    chart = commands.add_parser("chart", help="chart rows of the stored reports as JSON")
    chart.add_argument("--output", required=True, help="folder to write")
    for command in commands.choices.values():
        command.add_argument("properties", type=Path, help="settings file")
    given = parser.parse_args(arguments)

    settings = Settings.from_properties(given.properties.read_text(encoding="utf-8"))
    spark = session.build(settings, f"orderstream-{given.command}")
    if given.command == "etl":
        jobs.run_etl(spark, settings, given.open_only)
    elif given.command == "reports":
        jobs.run_reports(spark, settings, sums_together=given.sums_together)
    else:
        rows = dashboard_feed(jobs.stored_cities(spark, settings.store_path))
        rows.write.mode("overwrite").json(given.output)


if __name__ == "__main__":
    main()
