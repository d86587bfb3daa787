"""Small column expressions: time parts, bands, shares.

Everything here is a built-in Spark expression, so it stays inside generated
code and can be pushed or folded by the optimizer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Band(NamedTuple):
    """One step of a banding: values below ``upper`` get ``label``."""

    label: str
    upper: float
    inclusive: bool


# Ride length in minutes.
RIDE_BANDS = (Band("short", 15, True), Band("medium", 45, True))
RIDE_BAND_ABOVE = "long"

# Air temperature in degrees Celsius.
TEMPERATURE_BANDS = (
    Band("very_cold", 5, False),
    Band("cold", 10, True),
    Band("mild", 20, True),
    Band("warm", 30, False),
)
TEMPERATURE_BAND_ABOVE = "hot"

# Hourly weather condition codes per precipitation class.
PRECIPITATION_CODES = {
    "light_precip": (7, 14),
    "moderate_precip": (8, 15, 17, 21),
    "heavy_precip": (9, 16, 18, 22),
    "hazardous": (10, 11, 12, 13, 19, 20),
}
PRECIPITATION_NONE = "clear"


def band(value: Column, bands: Sequence[Band], above: str) -> Column:
    """Label of the first band ``value`` falls in, ``above`` past the last one."""
    branches = [(value <= b.upper if b.inclusive else value < b.upper, b.label) for b in bands]
    return choose(branches, above)


def code_class(code: Column, classes: Mapping[str, Sequence[int]], default: str) -> Column:
    """Class that lists ``code``; unlisted and missing codes get ``default``."""
    return choose([(code.isin(*codes), label) for label, codes in classes.items()], default)


def choose(branches: Sequence[tuple[Column, str]], default: str) -> Column:
    (condition, label), *rest = branches
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """``name`` as a timestamp; malformed text becomes NULL instead of an error."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, as fractional minutes."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def is_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))


def same_value(left: Column, right: Column) -> Column:
    """Equality that is false, not NULL, when a side is missing."""
    return F.coalesce(left == right, F.lit(False))


def mean_minutes(minutes: Column) -> Column:
    """Mean of whole-second durations given in minutes.

    The sum runs over integers, so the result does not depend on how rows were
    partitioned, which a sum of doubles would.
    """
    seconds = F.round(minutes * 60).cast("bigint")
    return F.try_divide(F.sum(seconds), F.count(seconds) * 60)


def share(part: Column, total: Column) -> Column:
    return F.round(F.try_divide(part, total), 2)


def percent(part: Column, total: Column) -> Column:
    return F.round(F.try_divide(part, total) * 100, 2)


def md5_number(text: Column, first_digit: int) -> Column:
    """Sixty bits of the MD5 of ``text`` as a non-negative bigint."""
    digits = F.substring(F.md5(text), first_digit, 15)
    return F.conv(digits, 16, 10).cast("bigint")
