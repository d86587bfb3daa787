"""Reports over cleaned and enriched trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velorank.functions.columns import mean_minutes, percent, share
from velorank.operators.profiles import count_durations, duration_profile
from velorank.operators.selection import top_k
from velorank.session import BROADCAST_ROWS

# Groups with fewer rides are noise.
MIN_RIDES = 100

STATION_KEYS = ("start_station_name", "start_station_id")
STATION_COUNTS: Mapping[str, str] = {
    "member_rides": "member_casual = 'member'",
    "casual_rides": "member_casual = 'casual'",
    "round_trip_rides": "round_trip",
    "short_rides": "ride_type = 'short'",
    "medium_rides": "ride_type = 'medium'",
    "long_rides": "ride_type = 'long'",
}
STATION_SHARES: Mapping[str, str] = {
    "member_ratio": "member_rides",
    "round_trip_ratio": "round_trip_rides",
    "short_ratio": "short_rides",
    "medium_ratio": "medium_rides",
    "long_ratio": "long_rides",
}
ROUTE_KEYS = ("start_station_name", "end_station_name")


def rides_by_hour_and_type(trips: DataFrame) -> DataFrame:
    """Ride counts per weekend flag, rider kind, start hour and length band."""
    keys = ["weekend_indicator", "member_casual", "hour_in_day", "ride_type"]
    return trips.groupBy(*keys).agg(F.count("*").alias("num_of_rides")).orderBy(*keys)


def group_metrics(
    trips: DataFrame,
    keys: Sequence[str],
    counts: Mapping[str, str],
    shares: Mapping[str, str],
    min_rides: int = MIN_RIDES,
) -> DataFrame:
    """Totals, conditional counts, mean duration and shares of the total per group."""
    totals = trips.groupBy(*keys).agg(
        F.count("*").alias("total_rides"),
        *[F.count_if(F.expr(condition)).alias(name) for name, condition in counts.items()],
        F.round(mean_minutes(F.col("duration_minutes")), 2).alias("avg_duration"),
    )
    return totals.filter(F.col("total_rides") >= min_rides).withColumns(
        {name: share(F.col(part), F.col("total_rides")) for name, part in shares.items()}
    )


def station_metrics(trips: DataFrame, min_rides: int = MIN_RIDES) -> DataFrame:
    """Metrics of every start station with at least ``min_rides`` rides."""
    return group_metrics(trips, STATION_KEYS, STATION_COUNTS, STATION_SHARES, min_rides)


def top_by(report: DataFrame, n: int, order_by: str, keys: Sequence[str]) -> DataFrame:
    """First ``n`` rows by descending ``order_by``; equal ones in ascending key order."""
    return top_k(report, [], _ranking(order_by, keys), n)


def _ranking(order_by: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(order_by).desc_nulls_last(), *[F.col(key).asc_nulls_last() for key in keys]]


def top_stations(trips: DataFrame, n: int, min_rides: int = MIN_RIDES, order_by: str = "member_ratio") -> DataFrame:
    """The ``n`` start stations with the highest ``order_by``, any output column."""
    return top_by(station_metrics(trips, min_rides), n, order_by, STATION_KEYS)


def common_routes(
    trips: DataFrame, n: int, min_rides: int = MIN_RIDES, median_accuracy: int | None = None
) -> DataFrame:
    """The ``n`` most ridden routes with median, mean and spread of their duration.

    Routes are counted first, in a cheap aggregation; the costly measures are
    then taken for the ``n`` winners alone.
    """
    counts = trips.groupBy(*ROUTE_KEYS).agg(F.count("*").alias("total_rides")).filter(F.col("total_rides") >= min_rides)
    winners = top_by(counts, n, "total_rides", ROUTE_KEYS).select(
        *[F.col(key).alias(f"_{key}") for key in ROUTE_KEYS]
    )
    if n <= BROADCAST_ROWS:  # the limit above is the size bound
        winners = F.broadcast(winners)
    same_route = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in ROUTE_KEYS]
    rides = trips.select(*ROUTE_KEYS, "duration_minutes").join(winners, same_route, "left_semi")
    profile = duration_profile(rides, ROUTE_KEYS, accuracy=median_accuracy)
    rounded = profile.select(
        *ROUTE_KEYS,
        F.col("total").alias("total_rides"),
        F.round("median", 2).alias("median_duration"),
        F.round("mean", 2).alias("avg_duration"),
        F.round("spread", 2).alias("stddev_duration"),
    )
    # Taken from the rounded columns, as shown.
    return rounded.withColumn(
        "coef_variation", percent(F.col("stddev_duration"), F.col("avg_duration"))
    ).orderBy(*_ranking("total_rides", ROUTE_KEYS))


def round_trips_overall(
    trips: DataFrame, median_accuracy: int | None = None, weight: str | None = None
) -> DataFrame:
    """Round trips against one-way rides, with their share of all rides.

    ``weight`` is the count column if ``trips`` are counted by `count_round_trips`.
    """
    profile = _round_trip_profile(trips, ["round_trip"], median_accuracy, weight)
    # Over the report's two rows, not over the trips.
    everything = F.sum("num_rides").over(Window.partitionBy())
    return profile.withColumn("percentage", percent(F.col("num_rides"), everything)).orderBy("round_trip")


def round_trips_by_rider(
    trips: DataFrame, median_accuracy: int | None = None, weight: str | None = None
) -> DataFrame:
    """Round trips against one-way rides per rider kind."""
    return _round_trip_profile(trips, ["member_casual", "round_trip"], median_accuracy, weight)


def count_round_trips(trips: DataFrame) -> DataFrame:
    """Trips counted in ``rides`` so that both round-trip reports can start from the result."""
    return count_durations(trips, ["member_casual", "round_trip"])


def _round_trip_profile(
    trips: DataFrame, keys: list[str], median_accuracy: int | None, weight: str | None
) -> DataFrame:
    return duration_profile(trips, keys, accuracy=median_accuracy, weight=weight).select(
        *keys,
        F.col("total").alias("num_rides"),
        F.round("median", 2).alias("median_duration"),
        F.round("mean", 2).alias("avg_duration"),
    )
