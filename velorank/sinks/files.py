"""Report, graph, rank and comparison files, all written by Spark tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velorank.operators.comparison import Comparison
from velorank.operators.graph import Graph, PreparedGraph, adjacency


def write_report(report: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with a header.  One file by default: a report is a small aggregate."""
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").option("header", True).csv(path)


def write_report_file(report: DataFrame, path: str) -> None:
    """One CSV file of the very name ``path``, with a header.

    An attempt is written beside it and moved to its name when it is whole, so
    readers see the former file or the new one.  Where the store can replace a file
    in one step, that is how it is done.
    """
    spark, attempt = report.sparkSession, f"{path}.attempt-{uuid.uuid4().hex}"
    report.coalesce(1).write.option("header", True).csv(attempt)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    folder, target = hadoop.Path(attempt), hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        (part,) = [status.getPath() for status in files.globStatus(hadoop.Path(folder, "part-*"))]
        context = hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(files.makeQualified(part), files.makeQualified(target), how)
    finally:
        files.delete(folder, True)


# Names of columns, fields and files below are fixed values: readers of the outputs rely on them.


def write_edge_list(graph: Graph, path: str, delimiter: str = "\t") -> None:
    """``src<delimiter>dst`` lines, one per edge."""
    graph.edges.select("src", "dst").write.mode("overwrite").option("sep", delimiter).csv(path)


def write_adjacency(graph: Graph | PreparedGraph, path: str) -> None:
    """One ``{"node_id", "slice", "out_neighbors"}`` object per line, isolated vertices included.

    `velorank.sources.graphs.read_adjacency` reads it back; ``slice`` numbers the
    lines of a vertex, of which there is one for each 100,000 neighbours.
    """
    adjacency(graph).write.mode("overwrite").json(path)


def write_ranks(ranks: DataFrame, path: str) -> None:
    """``id<TAB>rank`` lines in ascending id order, range-partitioned over the files, and a manifest beside them.

    The manifest, in ``<path>-manifest``, has a line for each file in their order:
    ``file``, ``first_id``, ``last_id``, ``rows``.
    """
    ranks.select("id", "rank").orderBy("id").write.mode("overwrite").option("sep", "\t").csv(path)
    found = _rank_files(ranks.sparkSession, path)
    found.orderBy("first_id").coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}-manifest")


_RANK_LINES = "id bigint, rank double"


def _rank_lines(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(_RANK_LINES).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    return rows.select("id", "rank", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_at"))


def _rank_files(spark: SparkSession, path: str) -> DataFrame:
    return _rank_lines(spark, path).groupBy("file").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("rows"))


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``rank`` and ``place``, the line's place (from 0) over all files in their order.

    The files must be those of the manifest, with its first and last ids and counts,
    each beginning after the end of the one before; anything else is an error.
    """
    manifest = spark.read.schema("file string, first_id bigint, last_id bigint, rows bigint").json(f"{path.rstrip('/')}-manifest")
    whole = Window.orderBy("first_id")  # a row per file
    files = manifest.withColumns({
        "before": F.coalesce(F.sum("rows").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "follows": F.coalesce(F.col("first_id") > F.lag("last_id").over(whole), F.lit(True)),
    })
    seen = _rank_files(spark, path).select("file", *[F.col(c).alias(f"_{c}") for c in ("first_id", "last_id", "rows")])
    same = F.col("follows")
    for c in ("first_id", "last_id", "rows"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    wrong = files.join(seen, "file", "full").filter(~F.coalesce(same, F.lit(False))).select("file").limit(5).collect()
    if wrong:
        raise ValueError(f"{path} is not what its manifest says: {', '.join(r.file for r in wrong)}")
    line = F.row_number().over(Window.partitionBy("file").orderBy("_at", "_line"))
    lines = _rank_lines(spark, path).withColumn("_line", F.monotonically_increasing_id())
    return lines.withColumn("_line", line).join(F.broadcast(files.select("file", "before")), "file").select(
        "id", "rank", (F.col("before") + F.col("_line") - 1).alias("place")
    )


def _runs(comparison: Comparison, first_seed: int) -> DataFrame:
    return comparison.per_run.select(
        "run",
        (F.col("run") + first_seed).cast("bigint").alias("graph_seed"),
        "seeds", "topK_standard", "topK_personalized", "overlap_count", "overlap_ratio",
    )


def write_comparison(comparison: Comparison, path: str, parameters: dict[str, int | float], first_seed: int) -> None:
    """One JSON document: the parameters, the runs in order and the mean overlap ratio.

    The document has an entry for each run that was asked for by name; for runs as
    many as the data make them, use `write_comparison_lines`.
    """
    run = F.struct(*_runs(comparison, first_seed).columns)
    document = _runs(comparison, first_seed).agg(
        F.sort_array(F.collect_list(run)).alias("per_run"),
        F.coalesce(F.avg("overlap_ratio"), F.lit(0.0)).alias("average_overlap_ratio"),
    ).select(*[F.lit(value).alias(name) for name, value in parameters.items()], "per_run", "average_overlap_ratio")
    document.write.mode("overwrite").json(path)


def write_comparison_lines(comparison: Comparison, path: str) -> None:
    """A JSON line per run, in order over all files."""
    comparison.per_run.orderBy("run").write.mode("overwrite").json(path)
