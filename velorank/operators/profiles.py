"""Count, median, mean and spread of a duration per group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velorank.functions.columns import mean_minutes


def count_durations(trips: DataFrame, keys: Sequence[str], minutes: str = "duration_minutes") -> DataFrame:
    """Rides per group and distinct duration: ``keys, minutes, rides``.

    Small however many trips there are, and all that exact profiles of these
    groups, or of coarser ones, need.
    """
    return trips.groupBy(*keys, minutes).agg(F.count("*").alias("rides"))


def duration_profile(
    trips: DataFrame,
    keys: Sequence[str],
    minutes: str = "duration_minutes",
    accuracy: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """``keys, total, median, mean, spread`` of each group, unrounded.

    By default the median is exact: the lowest value that at least half of the
    group does not exceed.  Rows are first counted per group and distinct value,
    which spreads even a group with most of the rows over all tasks, and what
    is then ordered per group is one row per distinct value - for clean trips,
    whole seconds of at most a day, 86,400 at most.  ``weight`` names the count
    column of trips counted already.

    With ``accuracy`` the median is a sketch of that accuracy, in one pass.
    """
    if accuracy is not None:
        return trips.groupBy(*keys).agg(
            F.count("*").alias("total"),
            F.percentile_approx(minutes, 0.5, accuracy).alias("median"),
            mean_minutes(F.col(minutes)).alias("mean"),
            F.stddev_samp(minutes).alias("spread"),
        )
    rides = F.count("*") if weight is None else F.sum(weight)
    counted = trips.groupBy(*keys, F.col(minutes).alias("_value")).agg(rides.alias("_rows"))
    group = Window.partitionBy(*keys)
    ascending = group.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    seconds = F.round(F.col("_value") * 60).cast("bigint")
    placed = counted.select(
        *keys,
        "_value",
        "_rows",
        F.sum("_rows").over(ascending).alias("_upto"),
        F.sum("_rows").over(group).alias("_total"),
        F.sum(seconds * F.col("_rows")).over(group).alias("_seconds"),
    ).withColumn("_mean", F.col("_seconds") / (F.col("_total") * 60))
    squares = F.sum(F.col("_rows") * (F.col("_value") - F.col("_mean")) * (F.col("_value") - F.col("_mean")))
    total = F.max("_total")
    return placed.groupBy(*keys).agg(
        total.alias("total"),
        F.min(F.when(F.col("_upto") * 2 >= F.col("_total"), F.col("_value"))).alias("median"),
        F.max("_mean").alias("mean"),
        F.when(total > 1, F.sqrt(squares / (total - 1))).alias("spread"),
    )
