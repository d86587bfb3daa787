import math
import random
import statistics
from collections import defaultdict

import pytest

from velorank.operators import trip_reports as r
from velorank.operators.profiles import duration_profile

SCHEMA = (
    "start_station_name string, start_station_id string, end_station_name string, member_casual string, "
    "weekend_indicator boolean, hour_in_day int, ride_type string, round_trip boolean, duration_minutes double"
)


def make_rows(n=3000, seed=5):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        # A third of all rides starts at one station.
        start = "S0" if draw.random() < 1 / 3 else f"S{draw.randrange(8)}"
        end = draw.choice([None, start, f"S{draw.randrange(8)}"])
        minutes = draw.randrange(1, 5400) / 60
        kind = "short" if minutes <= 15 else "medium" if minutes <= 45 else "long"
        rows.append((
            start, "id" + start, end, draw.choice(["member", "casual", "guest"]), draw.random() < 0.3,
            draw.randrange(24), kind, end == start, minutes,
        ))
    return rows


@pytest.fixture(scope="module")
def data():
    return make_rows()


@pytest.fixture(scope="module")
def trips(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(6).cache()


def half_up(x, digits=2):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def mean(minutes):
    return sum(round(m * 60) for m in minutes) / (60 * len(minutes))


def test_rides_by_hour_and_type(trips, data):
    want = defaultdict(int)
    for row in data:
        want[(row[4], row[3], row[5], row[6])] += 1
    got = [tuple(x) for x in r.rides_by_hour_and_type(trips).collect()]
    assert got == [(*k, v) for k, v in sorted(want.items())]
    assert sum(x[-1] for x in got) == len(data)


@pytest.mark.parametrize("order_by", ["member_ratio", "round_trip_ratio", "total_rides", "avg_duration", "long_ratio"])
def test_stations(trips, data, order_by):
    groups = defaultdict(list)
    for row in data:
        groups[row[0], row[1]].append(row)
    want = []
    for (name, key), rows in groups.items():
        if len(rows) < 200:
            continue
        n = len(rows)
        counts = [
            sum(x[3] == "member" for x in rows), sum(x[3] == "casual" for x in rows), sum(x[7] for x in rows),
            sum(x[6] == "short" for x in rows), sum(x[6] == "medium" for x in rows), sum(x[6] == "long" for x in rows),
        ]
        shares = [half_up(c / n) for c in (counts[0], *counts[2:])]
        want.append((name, key, n, *counts, half_up(mean([x[8] for x in rows])), *shares))
    report = r.top_stations(trips, 4, 200, order_by)
    place = report.columns.index(order_by)
    want.sort(key=lambda x: (-x[place], x[0], x[1]))
    assert len(want) > 4
    assert [tuple(x) for x in report.collect()] == want[:4]


def routes(data, least):
    groups = defaultdict(list)
    for row in data:
        groups[row[0], row[2]].append(row[8])
    out = []
    for (start, end), minutes in groups.items():
        if len(minutes) < least:
            continue
        average, spread = half_up(mean(minutes)), half_up(statistics.stdev(minutes)) if len(minutes) > 1 else None
        out.append((
            start, end, len(minutes), half_up(statistics.median_low(minutes)), average, spread,
            half_up(spread / average * 100) if spread is not None else None,
        ))
    out.sort(key=lambda x: (-x[2], x[0], x[1] is None, x[1] or ""))
    return out


@pytest.mark.parametrize("n, least", [(3, 1), (10, 100), (1000, 1)])
def test_routes(trips, data, n, least):
    assert [tuple(x) for x in r.common_routes(trips, n, least).collect()] == routes(data, least)[:n]


def test_routes_with_sketched_medians(trips, data):
    got = r.common_routes(trips, 1000, 1, median_accuracy=10000).collect()
    assert [tuple(x) for x in got] == routes(data, 1)


def test_a_route_with_one_ride_has_no_spread(spark):
    one = spark.createDataFrame([("A", "a", None, "member", False, 1, "short", False, 5.0)], SCHEMA)
    row = r.common_routes(one, 5, 1).first()
    assert (row.end_station_name, row.total_rides, row.median_duration) == (None, 1, 5.0)
    assert row.stddev_duration is None and row.coef_variation is None


def test_round_trips(trips, data):
    overall = [tuple(x) for x in r.round_trips_overall(trips).collect()]
    assert [tuple(x) for x in r.round_trips_overall(r.count_round_trips(trips), weight="rides").collect()] == overall
    want = []
    for flag in (False, True):
        minutes = [x[8] for x in data if x[7] is flag]
        want.append((
            flag, len(minutes), half_up(statistics.median_low(minutes)), half_up(mean(minutes)),
            half_up(len(minutes) / len(data) * 100),
        ))
    assert overall == want
    assert math.isclose(sum(x[4] for x in overall), 100, abs_tol=0.02)


def test_round_trips_by_rider(trips, data):
    want = set()
    for kind in ("member", "casual", "guest"):
        for flag in (False, True):
            minutes = [x[8] for x in data if x[7] is flag and x[3] == kind]
            want.add((kind, flag, len(minutes), half_up(statistics.median_low(minutes)), half_up(mean(minutes))))
    assert {tuple(x) for x in r.round_trips_by_rider(trips).collect()} == want
    counted = r.count_round_trips(trips)
    assert {tuple(x) for x in r.round_trips_by_rider(counted, weight="rides").collect()} == want


def test_even_sized_median_is_the_lower_value(spark):
    frame = spark.createDataFrame([("x", float(i)) for i in (1, 2, 3, 4)], "k string, duration_minutes double")
    assert duration_profile(frame, ["k"]).first()["median"] == 2.0
