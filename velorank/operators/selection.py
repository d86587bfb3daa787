"""Keeping the first rows of each group without gathering a group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this limit Spark trims every window group before its shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold, default value).
GROUP_LIMIT = 1_000
SPREAD = 256


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order``, per group of ``keys`` or overall.

    ``order`` must be total.  A group may hold any share of the rows: without
    keys each task keeps its own ``k`` best; with keys Spark does the same per
    group while ``k`` is small, and for larger ``k`` the group is first cut down
    in ``SPREAD`` parts.
    """
    if k <= 0:
        return df.limit(0)
    if not keys:
        return df.orderBy(*order).limit(k)
    if k > GROUP_LIMIT:
        parted = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)))
        df = _first_rows(parted, [*keys, "_part"], order, k).drop("_part")
    return _first_rows(df, keys, order, k)


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def position_cutoffs(df: DataFrame, keys: Sequence[str], position: str, k: int, domain: int) -> DataFrame:
    """Per group, the position of its ``k``-th row, or ``domain`` if it has fewer.

    Positions are distinct within a group and lie in ``0 .. domain - 1``.  They
    are counted in about ``sqrt(domain)`` buckets; only the bucket holding the
    ``k``-th row is looked into, and it has no more rows than it has positions.
    Neither step handles more than ``sqrt(domain)`` rows of a group in a task.
    """
    width = max(1, math.isqrt(domain))
    bucket = F.expr(f"{position} div {width}")
    groups = df.select(*keys, F.col(position).alias("_at"), bucket.alias("_bucket"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counted = groups.groupBy(*keys, "_bucket").agg(F.count("*").alias("_rows"))
    running = counted.withColumn("_seen", F.sum("_rows").over(upto))
    edge = running.filter((F.col("_seen") >= k) & (F.col("_seen") - F.col("_rows") < k)).select(
        *keys, "_bucket", (F.lit(k) - F.col("_seen") + F.col("_rows")).cast("int").alias("_need")
    )
    found = (
        groups.join(F.broadcast(edge), [*keys, "_bucket"])  # one row per group
        .groupBy(*keys, "_need")
        .agg(F.sort_array(F.collect_list("_at")).alias("_ats"))
        .select(*keys, F.element_at("_ats", F.col("_need")).alias("_cut"))
    )
    all_groups = counted.select(*keys).distinct()
    nothing = F.lit(-1) if k <= 0 else F.lit(domain)
    return all_groups.join(found, list(keys), "left").select(
        *keys, F.coalesce(F.col("_cut"), nothing).cast("bigint").alias("cutoff")
    )
