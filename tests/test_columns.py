import datetime as dt

import pytest
from pyspark.sql import functions as F

from velorank.functions import columns as c


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("minutes, label", [
    (0.5, "short"), (15.0, "short"), (15.01, "medium"), (45.0, "medium"), (45.02, "long"), (1440.0, "long"),
])
def test_ride_bands(spark, minutes, label):
    assert one(spark, c.band(F.lit(minutes), c.RIDE_BANDS, c.RIDE_BAND_ABOVE)) == label


@pytest.mark.parametrize("degrees, label", [
    (-3.0, "very_cold"), (4.9, "very_cold"), (5.0, "cold"), (10.0, "cold"), (10.1, "mild"),
    (20.0, "mild"), (20.1, "warm"), (29.9, "warm"), (30.0, "hot"),
])
def test_temperature_bands(spark, degrees, label):
    assert one(spark, c.band(F.lit(degrees), c.TEMPERATURE_BANDS, c.TEMPERATURE_BAND_ABOVE)) == label


def test_precipitation_classes(spark):
    expected = {
        7: "light_precip", 14: "light_precip", 8: "moderate_precip", 15: "moderate_precip", 17: "moderate_precip",
        21: "moderate_precip", 9: "heavy_precip", 16: "heavy_precip", 18: "heavy_precip", 22: "heavy_precip",
        10: "hazardous", 11: "hazardous", 12: "hazardous", 13: "hazardous", 19: "hazardous", 20: "hazardous",
    }
    codes = spark.range(0, 30).select(F.col("id").cast("double").alias("code"))
    column = c.code_class(F.col("code"), c.PRECIPITATION_CODES, c.PRECIPITATION_NONE)
    for row in codes.select("code", column.alias("x")).collect():
        assert row["x"] == expected.get(int(row["code"]), "clear")
    assert one(spark, c.code_class(F.lit(None).cast("double"), c.PRECIPITATION_CODES, "clear")) == "clear"


def test_timestamps_from_text(spark):
    rows = spark.createDataFrame(
        [("2024-10-01 12:00:00.123",), ("2024-10-01 12:00:00",), ("soon",), ("2024-13-01 00:00:00",), ("",), (None,)], "t string"
    )
    got = [r["x"] for r in rows.select(c.as_timestamp(rows, "t").alias("x")).collect()]
    assert got[:2] == [dt.datetime(2024, 10, 1, 12, 0, 0, 123000), dt.datetime(2024, 10, 1, 12)]
    assert got[2:] == [None] * 4


def test_duration_drops_fractions_of_each_side(spark):
    def minutes(start, end):
        return one(spark, c.minutes_between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))))

    assert minutes("2024-10-01 10:00:00.900", "2024-10-01 10:01:30.100") == 1.5
    assert minutes("2024-10-01 10:00:00.100", "2024-10-01 10:00:00.900") == 0.0


@pytest.mark.parametrize("left, right, same", [("a", "a", True), ("a", "b", False), ("a", None, False), (None, None, False)])
def test_same_value(spark, left, right, same):
    assert one(spark, c.same_value(F.lit(left), F.lit(right))) is same


def test_weekend(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-09-30', DATE'2024-10-06')) AS d")
    flags = [r["w"] for r in days.select(c.is_weekend(F.col("d")).alias("w"), "d").orderBy("d").collect()]
    assert flags == [False] * 5 + [True] * 2


def test_shares_and_percentages(spark):
    assert one(spark, c.share(F.lit(1), F.lit(3))) == 0.33
    assert one(spark, c.share(F.lit(1), F.lit(8))) == 0.13
    assert one(spark, c.percent(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, c.percent(F.lit(1), F.lit(0))) is None


def test_mean_minutes_of_nothing_is_null(spark):
    empty = spark.createDataFrame([(None,)], "m double")
    assert empty.agg(c.mean_minutes(F.col("m")).alias("x")).first()["x"] is None
