import datetime as dt

import pytest

from velorank.operators import weather as w
from velorank.sources.tables import WEATHER_SCHEMA


def hour(year, month, day, hour_of_day, temp=12.0, coco=1.0):
    values = [year, month, day, hour_of_day]
    for name in ("temp", "rhum", "prcp", "wdir", "wspd", "wpgt", "pres", "cldc", "coco"):
        values += [{"temp": temp, "coco": coco}.get(name, 0.0), "station"]
    return tuple(values)


@pytest.fixture(scope="module")
def weather(spark):
    def make(*hours):
        return spark.createDataFrame(list(hours), WEATHER_SCHEMA)

    return make


def test_times_are_shifted_to_local(weather):
    row = w.prepare_weather(weather(hour(2024, 10, 1, 3)), 2024, 10).first()
    assert row.hour_timestamp_utc == dt.datetime(2024, 10, 1, 3)
    assert row.hour_timestamp == dt.datetime(2024, 9, 30, 23)


def test_month_and_missing_temperature(weather):
    rows = weather(
        hour(2024, 10, 1, 0), hour(2024, 10, 31, 23), hour(2024, 11, 1, 2), hour(2023, 10, 5, 5), hour(2024, 10, 2, 1, temp=None)
    )
    utc = w.prepare_weather(rows, 2024, 10)
    assert sorted(r.hour_timestamp_utc for r in utc.collect()) == [dt.datetime(2024, 10, 1), dt.datetime(2024, 10, 31, 23)]
    local = w.prepare_weather(rows, 2024, 10, month_in="local")
    assert sorted(r.hour_timestamp for r in local.collect()) == [dt.datetime(2024, 10, 31, 19), dt.datetime(2024, 10, 31, 22)]


@pytest.mark.parametrize("month_in", ["utc", "local"])
@pytest.mark.parametrize("year, month", [(2024, 3), (2024, 10), (2024, 11), (2023, 2), (2024, 12)])
def test_span_covers_exactly_the_hours_of_a_month(weather, year, month, month_in):
    """At both edges of months with and without a change of the clock."""
    first = dt.datetime(year, month, 1) - dt.timedelta(days=2)
    times = [first + dt.timedelta(hours=h) for h in range(36 * 24)]
    rows = w.prepare_weather(weather(*[hour(t.year, t.month, t.day, t.hour) for t in times]), year, month, month_in=month_in)
    local = [r.hour_timestamp for r in rows.collect()]
    start, end = w.month_span(year, month, month_in=month_in)
    assert (min(local), max(local)) == (start, end - dt.timedelta(hours=1))


def test_span_loses_no_trip(spark, weather):
    hours = weather(hour(2024, 10, 1, 0), hour(2024, 10, 31, 23))
    times = ["2024-09-30 19:59:59", "2024-09-30 20:00:00", "2024-10-31 19:59:59", "2024-10-31 20:00:00"]
    trips = spark.createDataFrame([(t,) for t in times], "t string").selectExpr("cast(t as timestamp) AS started_at")
    prepared = w.prepare_weather(hours, 2024, 10)
    for span in (None, w.month_span(2024, 10)):
        assert w.join_weather(trips, prepared, 744, span).count() == 2


def test_classes(weather):
    rows = weather(hour(2024, 10, 1, 5, 4.0, 7.0), hour(2024, 10, 1, 6, 30.0, None), hour(2024, 10, 1, 7, 20.0, 10.0))
    got = w.prepare_weather(rows, 2024, 10).orderBy("hour").select("rain_indicator", "temp_band").collect()
    assert [tuple(x) for x in got] == [("light_precip", "very_cold"), ("clear", "hot"), ("hazardous", "mild")]


@pytest.fixture(scope="module")
def trips(spark):
    rows = [
        ("a", dt.datetime(2024, 11, 3, 1, 20), 1, "member", 10.0),
        ("b", dt.datetime(2024, 11, 3, 4, 59, 59), 4, "casual", 20.0),
        ("c", dt.datetime(2024, 11, 9, 9, 0), 9, "casual", 30.0),
    ]
    return spark.createDataFrame(
        rows, "ride_id string, started_at timestamp, hour_in_day int, member_casual string, duration_minutes double"
    )


# 05:00 and 06:00 UTC are both 01:00 in New York on the day the clock goes back.
NOVEMBER = [hour(2024, 11, 3, 5, coco=1.0), hour(2024, 11, 3, 6, coco=8.0), hour(2024, 11, 3, 9, 31.0, 9.0)]


def test_join_drops_trips_without_weather(weather, trips):
    joined = w.join_weather(trips, w.prepare_weather(weather(*NOVEMBER), 2024, 11))
    got = sorted((r.ride_id, r.rain_indicator, r.is_rainy) for r in joined.collect())
    assert got == [("a", "clear", "non_rainy"), ("a", "moderate_precip", "rainy"), ("b", "heavy_precip", "rainy")]


def test_repeated_hour_can_be_taken_once(weather, trips):
    prepared = w.prepare_weather(weather(*NOVEMBER), 2024, 11, repeated_hours="first")
    got = sorted((r.ride_id, r.rain_indicator) for r in w.join_weather(trips, prepared).collect())
    assert got == [("a", "clear"), ("b", "heavy_precip")]


def test_join_is_the_same_without_a_broadcast(weather, trips, monkeypatch):
    prepared = w.prepare_weather(weather(*NOVEMBER), 2024, 11)
    small = w.join_weather(trips, prepared).select("ride_id", "temp", "is_rainy")
    import velorank.session as session

    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    large = w.join_weather(trips, prepared).select("ride_id", "temp", "is_rainy")
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


@pytest.fixture(scope="module")
def joined(spark):
    rows = [
        (8, "member", "rainy", "cold", 10.0), (8, "casual", "rainy", "cold", 20.0), (8, "casual", "rainy", "cold", 25.0),
        (8, "member", "non_rainy", "mild", 7.0), (9, "guest", "rainy", "cold", 99.0), (9, "guest", "rainy", "hot", 1.0),
        (9, "member", "rainy", "very_cold", 1.0),
    ]
    return spark.createDataFrame(
        rows, "hour_in_day int, member_casual string, is_rainy string, temp_band string, duration_minutes double"
    )


@pytest.fixture(params=["trips", "totals"])
def rides(request, joined):
    return joined if request.param == "trips" else w.impact_totals(joined)


def test_rain_reports(rides):
    assert [tuple(x) for x in w.rain_impact_by_hour(rides).collect()] == [
        (8, "non_rainy", 1, 7.0), (8, "rainy", 3, 18.33), (9, "rainy", 3, 33.67),
    ]
    assert [tuple(x) for x in w.rain_impact_by_rider(rides).collect()] == [
        (8, "casual", "rainy", 2, 22.5), (8, "member", "non_rainy", 1, 7.0), (8, "member", "rainy", 1, 10.0),
        (9, "guest", "rainy", 2, 50.0), (9, "member", "rainy", 1, 1.0),
    ]


def test_temperature_report_counts_members_and_casuals_only(rides):
    assert [tuple(x) for x in w.temperature_impact(rides).collect()] == [
        ("cold", 1, 2, 22.5, 3, 33.33, 66.67),
        ("hot", 0, 0, None, 0, None, None),
        ("mild", 1, 0, None, 1, 100.0, 0.0),
        ("very_cold", 1, 0, None, 1, 100.0, 0.0),
    ]
