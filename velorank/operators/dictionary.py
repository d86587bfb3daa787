"""Dense ids for vertices that are named by text, or by integers of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velorank.operators.graph import Graph
from velorank.session import SHUFFLE_PARTITIONS, ensure_checkpoint_dir

# Low bits of monotonically_increasing_id: the row's place in its partition.
_ROW_BITS = (1 << 33) - 1


def by_text(name: Column) -> list[Column]:
    """The order of names as text."""
    return [name]


def by_number(name: Column) -> list[Column]:
    """The order of integers in their shortest text, however long."""
    negative, size = name.startswith("-"), F.length(name)
    return [F.when(negative, -size).otherwise(size), F.when(negative, F.translate(name, "0123456789", "9876543210")).otherwise(name)]


def vertex_dictionary(names: DataFrame, order=by_text) -> DataFrame:
    """``name`` and ``id`` from 0 for the distinct names, in their order; nulls are left out.

    Sampled splitters range-partition the names and each partition is sorted; a
    name's id is its place in its partition and the rows of the partitions before,
    of which there is one count each.  The rows are written once, so ids are the
    same for all that reads them.
    """
    spark = names.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [k.alias(f"_k{i}") for i, k in enumerate(order(F.col("name")))]
    places = [f"_k{i}" for i in range(len(keys))]
    distinct = names.filter("name IS NOT NULL").select("name").distinct().select("name", *keys)
    rows = (
        distinct.repartitionByRange(int(spark.conf.get(SHUFFLE_PARTITIONS)), *places)
        .sortWithinPartitions(*places)
        .select("name", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"))
        .checkpoint()
    )
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(starts), "_part").select("name", (F.col("_before") + F.col("_row")).alias("id"))


def encode_graph(edges: DataFrame, order=by_text) -> tuple[Graph, DataFrame]:
    """Graph with dense ids of edges ``src, dst`` between names, and its dictionary."""
    names = vertex_dictionary(edges.select(F.explode(F.array("src", "dst")).alias("name")), order)
    coded = edges
    for end in ("src", "dst"):
        coded = coded.join(names.select(F.col("name").alias(end), F.col("id").alias(f"_{end}")), end)
    return Graph(coded.select(F.col("_src").alias("src"), F.col("_dst").alias("dst"))), names


def decode_ids(rows: DataFrame, names: DataFrame, columns: Sequence[str] = ("id",)) -> DataFrame:
    """``rows`` with the names of the vertices in place of their ids."""
    for column in columns:
        named = names.select(F.col("id").alias(column), F.col("name").alias("_name"))
        rows = rows.join(named, column).withColumn(column, F.col("_name")).drop("_name")
    return rows
