"""spark-submit jobs/trip_report.py --trips 'data/tripdata/*.csv' --output Trip_Analysis"""

from __future__ import annotations

import argparse

import common  # noqa: F401

from velorank.plans.trips import run_trip_reports
from velorank.session import build_session
from velorank.sources.tables import read_trips


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the trip reports as CSV")
    parser.add_argument("--trips", required=True, help="path or glob of trip CSV files")
    parser.add_argument("--output", required=True, help="folder for the reports")
    parser.add_argument("--top", type=int, default=10, help="rows of the station and route reports")
    parser.add_argument("--min-rides", type=int, default=100, help="leave out smaller stations and routes")
    parser.add_argument("--staging", help="shared folder for the cleaned trips; cached if not given")
    parser.add_argument("--positional", action="store_true", help="take columns by position, whatever the header says")
    parser.add_argument("--many-files", action="store_true", help="do not merge each report into one file")
    args = parser.parse_args(argv)
    spark = build_session("Trip reports")
    counts = run_trip_reports(
        read_trips(spark, args.trips, not args.positional), args.output, args.top, args.min_rides, args.staging, not args.many_files
    )
    print(counts)


if __name__ == "__main__":
    main()
