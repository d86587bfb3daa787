"""Helpers the operators of this folder share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velorank.session import SHUFFLE_PARTITIONS, ensure_checkpoint_dir

# Low bits of monotonically_increasing_id: the row's place in its partition.
_ROW_BITS = (1 << 33) - 1


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "library.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the folder all executors share; the lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """URI of a new folder, below the checkpoint folder, for files of this run."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(SHUFFLE_PARTITIONS))


def with_positions(df: DataFrame, *order: str, position: str = "position") -> DataFrame:
    """Rows with their place (from 0) in the total order of ``order``.

    Sampled splitters range-partition the rows, so a value that many rows share is
    spread as long as ``order`` ends in a unique column.  The sorted rows are
    written once; each partition's first place follows from one count per
    partition, which is what is broadcast.
    """
    spark = df.sparkSession
    number = F.monotonically_increasing_id()
    part, row = unused(df, "_part", "_row")
    rows = stored(
        df.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias(part), number.bitwiseAND(F.lit(_ROW_BITS)).alias(row))
    )
    return add_offsets(rows, part, F.col(row), position).drop(part, row)


def add_offsets(rows: DataFrame, part: str, place: Column, position: str) -> DataFrame:
    """``place`` plus the number of rows in parts before the own one; one row per part is broadcast."""
    n, name = unused(rows, "_n", "_before")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    before = F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(part, F.coalesce(before, F.lit(0)).alias(name))
    return rows.join(F.broadcast(offsets), part).withColumn(position, F.col(name) + place).drop(name)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that lists made of them stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
