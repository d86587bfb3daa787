"""The trip and weather report sets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from velorank.operators import trip_reports as reports
from velorank.operators import weather as impact
from velorank.operators.trips import clean_trips, enrich_trips
from velorank.sinks.files import write_report

# What the reports read; everything else is dropped before rows are kept.
REPORT_COLUMNS = [
    "started_at", "start_station_name", "start_station_id", "end_station_name", "member_casual",
    "duration_minutes", "hour_in_day", "weekend_indicator", "round_trip", "ride_type",
]


# Names of reports and their folders are fixed values.  Each with the column it is ordered by.
STATION_REPORTS = {
    "2a_stations_by_member_ratio": "member_ratio",
    "2b_stations_by_roundtrip_ratio": "round_trip_ratio",
    "2c_stations_by_total_rides": "total_rides",
}


@contextmanager
def kept(df: DataFrame, staging: str | None = None) -> Iterator[DataFrame]:
    """Rows several reports share, computed once.

    With ``staging``, a shared folder, they are written there as Parquet and
    each report reads back only its columns; otherwise they are cached.
    """
    if staging:
        df.write.mode("overwrite").parquet(staging)
        yield df.sparkSession.read.schema(df.schema).parquet(staging)
        return
    cached = df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


class RowCounts:
    """Rows seen at some steps of a job, counted while the job runs, without another pass."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def at(self, step: str, df: DataFrame) -> DataFrame:
        self._seen[step] = Observation()
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("rows"))

    def get(self) -> dict[str, int]:
        """After the job has run: rows by step, and what cleaning rejected."""
        rows = {step: seen.get["rows"] for step, seen in self._seen.items()}
        return rows | {"rejected": rows["loaded"] - rows["clean"]}


def report_trips(trips: DataFrame, counts: RowCounts | None = None, span: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Clean, enriched trips with the columns the reports need."""
    counts = counts or RowCounts()
    clean = counts.at("clean", clean_trips(counts.at("loaded", trips)))
    if span is not None:
        clean = impact.within(clean, span)
    return enrich_trips(clean).select(*REPORT_COLUMNS)


def run_trip_reports(
    trips: DataFrame, output: str, n: int = 10, min_rides: int = reports.MIN_RIDES,
    staging: str | None = None, single_file: bool = True,
) -> dict[str, int]:
    """Write every trip report below ``output``; returns the rows loaded, clean and rejected.

    What two or more reports build on, the cleaned trips, the stations and the
    counted round trips, is computed once.
    """
    def write(report: DataFrame, name: str) -> None:
        write_report(report, f"{output}/{name}", single_file)

    counts = RowCounts()
    with kept(report_trips(trips, counts), staging) as rows:
        write(reports.rides_by_hour_and_type(rows), "1_rides_by_hour_type")
        with kept(reports.station_metrics(rows, min_rides)) as stations:
            for name, order_by in STATION_REPORTS.items():
                write(reports.top_by(stations, n, order_by, reports.STATION_KEYS), name)
        write(reports.common_routes(rows, n, min_rides), "3_most_common_routes")
        with kept(reports.count_round_trips(rows)) as counted:
            write(reports.round_trips_overall(counted, weight="rides"), "4a_roundtrip_overall")
            write(reports.round_trips_by_rider(counted, weight="rides"), "4b_roundtrip_by_member")
    return counts.get()


def run_weather_reports(
    trips: DataFrame, weather: DataFrame, output: str, single_file: bool = True,
    weather_rows_at_most: int | None = None, span: tuple[datetime, datetime] | None = None,
) -> dict[str, int]:
    """Write every weather report below ``output``, in one pass over the trips.

    Returns the rows loaded, clean, rejected and joined.  ``span`` (see
    `velorank.operators.weather.month_span`) is the time the weather covers: trips
    outside it are cleaned and counted, then dropped before they are enriched.
    """
    counts = RowCounts()
    joined = impact.join_weather(report_trips(trips, counts, span), weather, weather_rows_at_most)
    with kept(impact.impact_totals(counts.at("joined", joined))) as totals:
        for name, report in (
            ("1_rain_impact_by_hour", impact.rain_impact_by_hour(totals)),
            ("2_rain_impact_by_member", impact.rain_impact_by_rider(totals)),
            ("3_temp_impact_comparison", impact.temperature_impact(totals)),
        ):
            write_report(report, f"{output}/{name}", single_file)
    return counts.get()
