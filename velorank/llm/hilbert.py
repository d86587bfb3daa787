"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised at its own quantiles over all rows, rows are ordered by
their cell's place on the curve, and the order is cut into runs of equal length.
Neighbours on the curve are neighbours in every dimension, so a run spans a narrow
range of each, and readers can skip files by any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorank.llm.common import partitions, stored, unused, with_positions

BITS = 6


def curve_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points, one row each, of ``bits`` bits per axis.

    The coordinates' bits are turned into those of the curve axis by axis from the
    highest bit down, by exchanges and inversions (Skilling, 2004), then interleaved.
    """
    axes = [cells[:, k].astype(np.int64).copy() for k in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for x in axes:
            swap = np.where(x & q, 0, (axes[0] ^ x) & low)
            flip = np.where(x & q, low, 0)
            axes[0] ^= flip | swap if x is not axes[0] else flip
            if x is not axes[0]:
                x ^= swap
        q >>= 1
    for k in range(1, len(axes)):
        axes[k] ^= axes[k - 1]
    turn = np.zeros(len(cells), np.int64)
    q = top
    while q > 1:
        turn ^= np.where(axes[-1] & q, q - 1, 0)
        q >>= 1
    place = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for x in axes:
            place = place << 1 | ((x ^ turn) >> bit & 1)
    return place


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))


def _text_cuts(df: DataFrame, name: str, cells: int) -> list:
    """The whole values at the quantiles of a column of text, at most ``cells`` - 1, in order.

    Rows are counted per value first; the distinct values are sorted over sampled
    splitters, and only those at a quantile reach the driver.
    """
    values = df.select(F.col(name).alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(
        values.repartitionByRange(partitions(df.sparkSession), "value").sortWithinPartitions("value")
        .select("value", "n", F.spark_partition_id().alias("part"))
    )
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    starts = rows.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return []
    last = F.col("start") + F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))

    def passed(place: str) -> Column:  # quantiles below a place
        return F.least(F.greatest(F.expr(f"({place} * {cells} + {total - 1}) div {total} - 1"), F.lit(0)), F.lit(cells - 1))

    placed = rows.join(F.broadcast(starts), "part").withColumn("last", last).withColumn("first", F.col("last") - F.col("n"))
    return [r.value for r in placed.where(passed("last") > passed("first")).orderBy("value").select("value").collect()]


def _measure(df: DataFrame, name: str) -> Column:
    """A number that orders the dimension's values; null for null."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def _text_measure(name: str, cuts: list) -> Column:
    """How many cuts a text has reached."""
    reached = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(name))) if cuts else F.lit(0)
    return F.when(F.col(name).isNotNull(), reached.cast("double"))


def _with_room(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns that bear one of the names renamed, and what each is called now."""
    new = dict(zip(names, unused(df, *names)))
    called = {c: new[c.lower()] for c in df.columns if c.lower() in new}
    return df.withColumnsRenamed(called), called


def hilbert_order(df: DataFrame, dimensions: list[str], order: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, its cell's place on the curve, and ``position``, its place in the whole order.

    Rows of a cell follow ``order``, which should identify a row, so that a cell with
    a third of all rows is spread over many partitions.  A dimension's cut points,
    at most 2^bits - 1 of them, come from all rows; those of text are whole values in
    their exact order.  Nulls (and not-a-numbers) are the lowest cell.  All columns
    are kept; ones called like the results get underscores before their names.  An
    empty table stays empty.
    """
    df, called = _with_room(df, ["curve", "position"])
    dimensions, order = ([called.get(c, c) for c in names] for names in (dimensions, order))
    cells = 1 << bits
    steps = [i / cells for i in range(1, cells)]
    names = [f"m{k}" for k in range(len(dimensions))]
    texts = {m: _text_cuts(df, d, cells) for m, d in zip(names, dimensions) if _is_text(df, d)}
    measures = [(_text_measure(d, texts[m]) if m in texts else _measure(df, d)).alias(m) for m, d in zip(names, dimensions)]
    numbers = [m for m in names if m not in texts]
    cuts = df.select(*measures).agg(F.lit(0), *[F.percentile_approx(m, steps).alias(m) for m in numbers]).first()
    edges = [np.arange(1, len(texts[m]) + 1) if m in texts else np.unique(cuts[m]) if cuts[m] else np.array([]) for m in names]
    width = bits * len(dimensions)
    if width > 62:
        raise ValueError("too many dimensions for these bits")

    @F.pandas_udf("bigint")
    def curve(points: pd.DataFrame) -> pd.Series:
        columns = [points[m].to_numpy(np.float64) for m in names]
        cells = [np.where(np.isnan(c), 0, np.searchsorted(e, c, "right")) for c, e in zip(columns, edges)]
        return pd.Series(curve_index(np.stack(cells, axis=1), bits))

    return with_positions(df.withColumn("curve", curve(F.struct(*measures))), "curve", *order)


def hilbert_shards(df: DataFrame, dimensions: list[str], order: list[str], shards: int, bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``: runs of the curve whose row counts differ by at most one.

    Columns of ``df`` called so, or ``position``, get underscores before their names.
    """
    df, called = _with_room(df, ["curve", "position", "shard", "slot"])
    dimensions, order = ([called.get(c, c) for c in names] for names in (dimensions, order))
    placed = hilbert_order(df, dimensions, order, bits)
    total = placed.count()
    shard = F.expr(f"cast((position * {shards}) div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("position") - first).drop("position")


def shard_ranges(sharded: DataFrame, dimensions: list[str]) -> DataFrame:
    """A row per shard: rows and the least and greatest value of each dimension, for readers that skip files."""
    spans = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *spans)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """Write a Parquet folder per shard; files hold consecutive runs of its curve order."""
    runs = sharded.repartitionByRange(partitions(sharded.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot")
    runs.write.partitionBy("shard").parquet(folder)
