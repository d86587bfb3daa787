"""spark-submit jobs/weather_report.py --trips 'data/tripdata/*.csv' --weather data/hourly.csv --output Weather_Analysis"""

from __future__ import annotations

import argparse

import common  # noqa: F401

from velorank.operators.weather import ZONE, month_span, prepare_weather
from velorank.plans.trips import run_weather_reports
from velorank.session import build_session
from velorank.sources.tables import read_trips, read_weather


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the weather impact reports as CSV")
    parser.add_argument("--trips", required=True, help="path or glob of trip CSV files")
    parser.add_argument("--weather", required=True, help="hourly weather CSV, times in UTC")
    parser.add_argument("--output", required=True, help="folder for the reports")
    parser.add_argument("--year", type=int, default=2024)
    parser.add_argument("--month", type=int, default=10)
    parser.add_argument("--zone", default=ZONE, help="time zone of the trips")
    parser.add_argument("--month-in", choices=["utc", "local"], default="utc", help="zone the month is taken in")
    parser.add_argument("--repeated-hours", choices=["keep", "first"], default="keep",
                        help="what to do with a local hour that occurs twice")
    parser.add_argument("--positional", action="store_true", help="take columns by position, whatever the header says")
    parser.add_argument("--many-files", action="store_true", help="do not merge each report into one file")
    args = parser.parse_args(argv)
    spark = build_session("Weather reports")
    weather = prepare_weather(
        read_weather(spark, args.weather, not args.positional), args.year, args.month, args.zone, args.month_in, args.repeated_hours
    )
    span = month_span(args.year, args.month, args.zone, args.month_in)
    trips = read_trips(spark, args.trips, not args.positional)
    print(run_weather_reports(trips, weather, args.output, not args.many_files, span=span))


if __name__ == "__main__":
    main()
