"""Hourly weather, its join to trips, and weather impact reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.functions.columns import (
    PRECIPITATION_CODES,
    PRECIPITATION_NONE,
    TEMPERATURE_BAND_ABOVE,
    TEMPERATURE_BANDS,
    band,
    code_class,
    percent,
)
from velorank.operators.trips import is_clean, with_duration
from velorank.session import broadcast_if_small

ZONE = "America/New_York"
# Hours a month of one weather row per hour can have.
HOURS_IN_MONTH = 31 * 24


def prepare_weather(
    weather: DataFrame,
    year: int,
    month: int,
    zone: str = ZONE,
    month_in: str = "utc",
    repeated_hours: str = "keep",
) -> DataFrame:
    """Weather of one month with local hour, precipitation class and temperature band.

    The month is that of the UTC time, or with ``month_in="local"`` that of the
    local time.  When the clock goes back a local hour occurs twice;
    ``repeated_hours="first"`` keeps the earlier UTC hour only, so that rides of
    that hour are not doubled.
    """
    rows = weather.filter(F.col("temp").isNotNull())
    if month_in == "utc":
        rows = rows.filter((F.col("year") == year) & (F.col("month") == month))
    rows = rows.withColumn(
        "hour_timestamp_utc",
        F.try_make_timestamp(*[F.col(part) for part in ("year", "month", "day", "hour")], F.lit(0), F.lit(0)),
    ).withColumn("hour_timestamp", F.from_utc_timestamp("hour_timestamp_utc", zone))
    if month_in == "local":
        local = F.col("hour_timestamp")
        rows = rows.filter((F.year(local) == year) & (F.month(local) == month))
    if repeated_hours == "first":
        rows = _first_per_hour(rows)
    return rows.withColumns(
        {
            "rain_indicator": code_class(F.col("coco"), PRECIPITATION_CODES, PRECIPITATION_NONE),
            "temp_band": band(F.col("temp"), TEMPERATURE_BANDS, TEMPERATURE_BAND_ABOVE),
        }
    )


def month_span(year: int, month: int, zone: str = ZONE, month_in: str = "utc") -> tuple[datetime, datetime]:
    """The local times, from the first to before the second, that the weather of a month can be joined to."""
    hours = [datetime(year, month, 1) + timedelta(hours=h) for h in range(-48, HOURS_IN_MONTH + 48)]
    local = [h.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None) for h in hours]
    by = hours if month_in == "utc" else local
    inside = [t for t, h in zip(local, by) if (h.year, h.month) == (year, month)]
    return min(inside), max(inside) + timedelta(hours=1)


def _first_per_hour(rows: DataFrame) -> DataFrame:
    whole = F.struct(*[F.col(name) for name in rows.columns])
    return (
        rows.groupBy("hour_timestamp")
        .agg(F.min_by(whole, F.col("hour_timestamp_utc")).alias("_row"))
        .select("_row.*")
    )


def join_weather(
    trips: DataFrame,
    weather: DataFrame,
    weather_rows_at_most: int | None = None,
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Trips with the weather of their start hour and ``is_rainy``; other trips are dropped.

    The weather side is broadcast while it is small: ``weather_rows_at_most``
    is a bound the caller knows, otherwise the rows are counted.  Past that the
    join is shuffled, and Spark splits the busy hours.  ``span``, as `month_span`
    gives it, lets the scan skip trips outside the weather's time.
    """
    if span is not None:
        trips = within(trips, span)
    hourly = weather.select("hour_timestamp", "rain_indicator", "temp", "temp_band")
    hourly = broadcast_if_small(hourly, weather_rows_at_most)
    return _with_hour(trips).join(hourly, "hour_timestamp").withColumn("is_rainy", _rainy())


def within(trips: DataFrame, span: tuple[datetime, datetime]) -> DataFrame:
    """Trips that start in a span of local time; a stored timestamp is compared in the scan."""
    return trips.filter((F.col("started_at") >= _moment(span[0])) & (F.col("started_at") < _moment(span[1])))


def _moment(local: datetime) -> Column:
    return F.lit(local.isoformat(sep=" ")).cast("timestamp")


def _with_hour(trips: DataFrame) -> DataFrame:
    return trips.withColumn("hour_timestamp", F.date_trunc("hour", "started_at"))


def _rainy() -> Column:
    return F.when(F.col("rain_indicator") != PRECIPITATION_NONE, "rainy").otherwise("non_rainy")


def join_counts(raw_trips: DataFrame, weather: DataFrame, weather_rows_at_most: int | None = None) -> DataFrame:
    """One row: trips loaded, clean trips, and rows of their join to the weather; one pass over the trips."""
    hours = weather.groupBy("hour_timestamp").agg(F.count(F.lit(1)).alias("matches"))
    rows = _with_hour(with_duration(raw_trips)).withColumn("clean", is_clean())
    joined = rows.join(broadcast_if_small(hours, weather_rows_at_most), "hour_timestamp", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if("clean").alias("clean"),
        F.coalesce(F.sum(F.when(F.col("clean"), F.col("matches"))), F.lit(0)).alias("joined"),
    )


def total_rides(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rides`` and whole ``seconds`` ridden per group.

    ``joined`` are trips, or totals of finer groups, which are added up.
    """
    if "rides" in joined.columns:
        rides, seconds = F.sum("rides"), F.sum("seconds")
    else:
        rides, seconds = F.count("*"), F.sum(F.round(F.col("duration_minutes") * 60).cast("bigint"))
    return joined.groupBy(*keys).agg(rides.alias("rides"), seconds.alias("seconds"))


def impact_totals(joined: DataFrame) -> DataFrame:
    """A few hundred rows that all weather reports can be taken from, in one pass over the trips."""
    return total_rides(joined, ["hour_in_day", "member_casual", "is_rainy", "temp_band"])


def rain_impact_by_hour(joined: DataFrame) -> DataFrame:
    """Rides and mean duration per start hour, rainy or not; of trips or of `impact_totals`."""
    return _impact(joined, ["hour_in_day", "is_rainy"])


def rain_impact_by_rider(joined: DataFrame) -> DataFrame:
    """Rides and mean duration per start hour and rider kind, rainy or not; of trips or of `impact_totals`."""
    return _impact(joined, ["hour_in_day", "member_casual", "is_rainy"])


def _impact(joined: DataFrame, keys: list[str]) -> DataFrame:
    return total_rides(joined, keys).select(
        *keys, F.col("rides").alias("num_rides"), _mean(F.col("seconds"), F.col("rides")).alias("avg_duration")
    ).orderBy(*keys)


def _mean(seconds: Column, rides: Column) -> Column:
    return F.round(F.try_divide(seconds, rides * 60), 2)


def temperature_impact(joined: DataFrame) -> DataFrame:
    """Rider kinds per temperature band, of trips or of `impact_totals`; other kinds are left out of the total."""
    per_kind = total_rides(joined, ["temp_band", "member_casual"])

    def of(kind: str, column: str) -> Column:
        return F.sum(F.when(F.col("member_casual") == kind, F.col(column)))

    counted = per_kind.groupBy("temp_band").agg(
        F.coalesce(of("member", "rides"), F.lit(0)).alias("member_rides"),
        F.coalesce(of("casual", "rides"), F.lit(0)).alias("casual_rides"),
        _mean(of("casual", "seconds"), of("casual", "rides")).alias("casual_avg_duration"),
    )
    return (
        counted.withColumn("total_rides", F.col("member_rides") + F.col("casual_rides"))
        .withColumns(
            {
                "member_percentage": percent(F.col("member_rides"), F.col("total_rides")),
                "casual_percentage": percent(F.col("casual_rides"), F.col("total_rides")),
            }
        )
        .orderBy("temp_band")
    )
