"""Checks on a rank table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.operators.graph import Graph, PreparedGraph, vertex_degrees


def validate_ranks(graph: Graph | PreparedGraph, ranks: DataFrame, epsilon: float) -> DataFrame:
    """One row saying whether ``ranks`` (``id, rank``) fit ``graph``.

    The checks are ordered; ``reason`` is the code of the first that fails, and
    numbers that only later checks need are then NULL.  Vertices and ranks meet in one
    aggregation, so a missing or repeated rank shows up as a count.
    """
    degrees = graph.vertices if isinstance(graph, PreparedGraph) else vertex_degrees(graph)
    vertices = degrees.select(
        "id", F.lit(1).alias("node"), F.lit(0).alias("ranked"),
        (F.col("out_degree") == 0).cast("int").alias("dangling"), F.lit(None).cast("double").alias("rank"),
    )
    given = ranks.select(
        "id", F.lit(0).alias("node"), F.lit(1).alias("ranked"), F.lit(0).alias("dangling"), F.col("rank"),
    )
    per_id = vertices.unionAll(given).groupBy("id").agg(
        F.sum("node").alias("node"),
        F.sum("ranked").alias("ranked"),
        F.max("dangling").alias("dangling"),
        F.sum("rank").alias("rank"),
        F.min("rank").alias("lowest"),
        F.count_if(F.col("rank") < 0).alias("negative"),
    )
    dangling = F.col("dangling") == 1
    totals = per_id.agg(
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative_ranks_count"),
        F.coalesce(F.sum("rank"), F.lit(0.0)).alias("rank_sum"),
        F.coalesce(F.sum("node"), F.lit(0)).alias("num_nodes"),
        F.coalesce(F.sum("ranked"), F.lit(0)).alias("num_ranks"),
        F.count_if(dangling).alias("dangling_nodes_count"),
        F.count_if(dangling & (F.col("ranked") == 0)).alias("missing_dangling_ranks"),
        F.min(F.when(dangling, F.col("lowest"))).alias("min_dangling_rank"),
    )
    # Each entry: condition of failure, its code, the numbers first known at that check.
    some_dangling = F.col("dangling_nodes_count") > 0
    checks = [
        (F.col("negative_ranks_count") > 0, "negative_rank", ["negative_ranks_count"]),
        (F.abs(F.col("rank_sum") - 1.0) > epsilon, "sum_off", ["rank_sum"]),
        (F.col("num_nodes") != F.col("num_ranks"), "count_differs", ["num_nodes", "num_ranks"]),
        (F.col("missing_dangling_ranks") > 0, "dangling_unranked", ["dangling_nodes_count", "missing_dangling_ranks"]),
        (some_dangling & (F.col("min_dangling_rank") <= 0), "dangling_not_positive", ["min_dangling_rank"]),
    ]
    reason = F.coalesce(*[F.when(failed, F.lit(code)) for failed, code, _ in checks])
    columns, passed = [], F.lit(True)
    for failed, _, names in checks:
        for name in names:
            known = passed & some_dangling if name.endswith(("dangling_ranks", "dangling_rank")) else passed
            columns.append(F.when(known, F.col(name)).alias(name))
        passed = passed & ~failed
    return totals.select(reason.isNull().alias("valid"), reason.alias("reason"), *columns)
