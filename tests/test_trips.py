import datetime as dt

import pytest

from velorank.operators.trips import clean_trips, enrich_trips, reject_counts
from velorank.sources.tables import TRIP_SCHEMA

START = "2024-10-01 10:00:00"


def trip(ride_id="r", start=START, end="2024-10-01 10:10:00", station="s1", to="s2", rider="member"):
    return (ride_id, "classic", start, end, "A", station, "B", to, 40.0, -73.0, 40.0, -73.0, rider)


@pytest.fixture(scope="module")
def rows(spark):
    def make(*trips):
        return spark.createDataFrame(list(trips), TRIP_SCHEMA)

    return make


CASES = [
    ("kept", trip()),
    ("no_ride_id", trip(ride_id=None)),
    ("no_start_time", trip(start=None)),
    ("no_start_time", trip(start="yesterday")),
    ("no_start_station", trip(station=None)),
    ("no_end_time", trip(end=None)),
    ("no_end_time", trip(end="2024-10-01T99:00")),
    ("not_after_start", trip(end="2024-10-01 09:59:59")),
    ("not_after_start", trip(end=START)),
    ("no_duration", trip(start="2024-10-01 10:00:00.100", end="2024-10-01 10:00:00.900")),
    ("kept", trip(start="2024-10-01 10:00:00.900", end="2024-10-01 10:00:01.100")),
    ("kept", trip(end="2024-10-02 10:00:00")),
    ("too_long", trip(end="2024-10-02 10:00:01")),
    ("kept", trip(to=None)),
]


@pytest.mark.parametrize("outcome, row", CASES)
def test_cleaning(rows, outcome, row):
    frame = rows(row)
    assert clean_trips(frame).count() == (outcome == "kept")
    counts = reject_counts(frame).first().asDict()
    assert counts["loaded"] == 1
    assert counts["clean" if outcome == "kept" else outcome] == 1
    assert sum(counts.values()) == 2


def test_counts_add_up(rows):
    frame = rows(*[row for _, row in CASES])
    counts = reject_counts(frame).first().asDict()
    assert counts.pop("loaded") == len(CASES) == sum(counts.values())
    assert counts["clean"] == clean_trips(frame).count()


def test_end_station_can_be_required(rows):
    frame = rows(trip(), trip(to=None))
    assert clean_trips(frame, require_end_station=True).count() == 1
    assert reject_counts(frame, require_end_station=True).first()["no_end_station"] == 1


def test_longest_ride_is_a_parameter(rows):
    assert clean_trips(rows(trip()), max_minutes=9.9).count() == 0
    assert clean_trips(rows(trip()), max_minutes=10).count() == 1


def test_enrichment(rows):
    frame = rows(
        trip("a", "2024-10-05 23:59:59", "2024-10-06 00:14:59", to="s1"),
        trip("b", "2024-10-07 00:00:00", "2024-10-07 00:45:01", to=None),
    )
    a, b = enrich_trips(clean_trips(frame)).orderBy("ride_id").collect()
    assert (a.duration_minutes, a.hour_in_day, a.day_of_week) == (15.0, 23, "Saturday")
    assert (a.weekend_indicator, a.round_trip, a.ride_type) == (True, True, "short")
    assert (b.hour_in_day, b.day_of_week, b.weekend_indicator, b.round_trip, b.ride_type) == (
        0, "Monday", False, False, "long",
    )
    assert a.started_at == dt.datetime(2024, 10, 5, 23, 59, 59)


def test_columns_of_the_enriched_table(rows):
    frame = enrich_trips(clean_trips(rows(trip())))
    assert frame.columns == [f.name for f in TRIP_SCHEMA] + [
        "duration_minutes", "hour_in_day", "day_of_week", "weekend_indicator", "round_trip", "ride_type",
    ]
