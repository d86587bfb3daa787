"""Cleaning and enriching trip rows: narrow, row-by-row transforms without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorank.functions.columns import (
    RIDE_BAND_ABOVE,
    RIDE_BANDS,
    as_timestamp,
    band,
    is_weekend,
    minutes_between,
    same_value,
)

MAX_MINUTES = 1440


def with_duration(trips: DataFrame) -> DataFrame:
    """Parsed start and end times and ``duration_minutes``."""
    times = {name: as_timestamp(trips, name) for name in ("started_at", "ended_at")}
    if any(isinstance(trips.schema[name].dataType, T.StringType) for name in times):
        # Generated columns keep Spark from parsing again for every condition on them.
        parsed = F.struct(*[value.alias(f"_{name}") for name, value in times.items()])
        trips = trips.select("*", F.inline(F.array(parsed)))
        times = {name: F.col(f"_{name}") for name in times}
    timed = trips.withColumns(times).drop("_started_at", "_ended_at")
    return timed.withColumn("duration_minutes", minutes_between(F.col("started_at"), F.col("ended_at")))


def clean_trips(trips: DataFrame, max_minutes: float = MAX_MINUTES, require_end_station: bool = False) -> DataFrame:
    """Trips with an id, a start station, both times, and a plausible length.

    Conditions on untouched columns come first and reach the scan.
    """
    present = ["ride_id", "start_station_id"] + (["end_station_id"] if require_end_station else [])
    for name in present:
        trips = trips.filter(F.col(name).isNotNull())
    return with_duration(trips).filter(_plausible(max_minutes))


def is_clean(max_minutes: float = MAX_MINUTES, require_end_station: bool = False) -> Column:
    """Whether `clean_trips` keeps a row of `with_duration`; never NULL."""
    present = ["ride_id", "start_station_id"] + (["end_station_id"] if require_end_station else [])
    kept = _plausible(max_minutes)
    for name in present:
        kept = kept & F.col(name).isNotNull()
    return F.coalesce(kept, F.lit(False))


def _plausible(max_minutes: float) -> Column:
    minutes = F.col("duration_minutes")
    return (
        F.col("started_at").isNotNull()
        & F.col("ended_at").isNotNull()
        & (F.col("ended_at") > F.col("started_at"))
        & (minutes > 0)
        & (minutes <= max_minutes)
    )


def reject_counts(trips: DataFrame, max_minutes: float = MAX_MINUTES, require_end_station: bool = False) -> DataFrame:
    """One row: rows loaded, rows kept, and rows failing each condition first.

    The conditions are tried in the order of the columns, so the counts of
    rejects and of clean rows add up to ``loaded``.
    """
    started, ended, minutes = F.col("started_at"), F.col("ended_at"), F.col("duration_minutes")
    reasons = [
        ("no_ride_id", F.col("ride_id").isNull()),
        ("no_start_time", started.isNull()),
        ("no_start_station", F.col("start_station_id").isNull()),
        ("no_end_time", ended.isNull()),
        ("not_after_start", ended <= started),
        ("no_duration", minutes <= 0),
        ("too_long", minutes > max_minutes),
    ]
    if require_end_station:
        reasons.insert(3, ("no_end_station", F.col("end_station_id").isNull()))
    first = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in reasons], F.lit("clean"))
    return with_duration(trips).select(first.alias("reason")).agg(
        F.count("*").alias("loaded"),
        *[F.count_if(F.col("reason") == name).alias(name) for name in ["clean", *[name for name, _ in reasons]]],
    )


def enrich_trips(trips: DataFrame) -> DataFrame:
    """Start hour, day name, weekend, round trip and length band."""
    start = F.col("started_at")
    return trips.withColumns(
        {
            "hour_in_day": F.hour(start),
            "day_of_week": F.date_format(start, "EEEE"),
            "weekend_indicator": is_weekend(start),
            "round_trip": same_value(F.col("start_station_id"), F.col("end_station_id")),
            "ride_type": band(F.col("duration_minutes"), RIDE_BANDS, RIDE_BAND_ABOVE),
        }
    )
