"""Rank and comparison jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from velorank.operators.comparison import Comparison, compare_rankings, no_comparison
from velorank.operators.graph import Graph, PreparedGraph
from velorank.operators.ranking import Ranking, pagerank, personalized_pagerank
from velorank.sinks.files import write_comparison
from velorank.sources.graphs import random_graphs, sample_vertices


@dataclass(frozen=True)
class RankSettings:
    """Settings of a rank run; the defaults are fixed values."""

    k: int = 20
    max_iter: int = 20
    epsilon: float = 1e-3
    damping: float = 0.85
    num_partitions: int | None = None


def rank_graph(
    graph: Graph | PreparedGraph, settings: RankSettings, seeds: DataFrame | None = None, progress: str | None = None
) -> Ranking:
    """Standard ranks, or personalized ones where ``seeds`` are given; ``progress`` is a folder to go on from."""
    common = (settings.max_iter, settings.epsilon, settings.damping, settings.num_partitions)
    if seeds is None:
        return pagerank(graph, *common, progress)
    return personalized_pagerank(graph, seeds, *common, progress)


def compare_random_graphs(
    spark: SparkSession, runs: int, num_nodes: int, num_edges: int, seeds_per_run: int,
    settings: RankSettings, first_seed: int = 42,
) -> Comparison:
    """Compare both kinds of rank on ``runs`` random graphs, all in one loop."""
    if runs < 1:
        return no_comparison(spark)
    seeds = [first_seed + i for i in range(runs)]
    graphs = random_graphs(spark, num_nodes, num_edges, seeds)
    chosen = sample_vertices(graphs.vertices, seeds_per_run, seeds, ("run",))
    return compare_rankings(
        graphs, chosen, settings.k, settings.max_iter, settings.epsilon, settings.damping, settings.num_partitions
    )


def write_random_comparison(
    spark: SparkSession, path: str, runs: int, num_nodes: int, num_edges: int, seeds_per_run: int,
    settings: RankSettings, first_seed: int = 42,
) -> Comparison:
    comparison = compare_random_graphs(spark, runs, num_nodes, num_edges, seeds_per_run, settings, first_seed)
    parameters = {
        "runs": runs, "K": settings.k, "d": settings.damping, "max_iter": settings.max_iter,
        "epsilon": settings.epsilon, "num_nodes": num_nodes, "num_edges": num_edges, "seeds_per_run": seeds_per_run,
    }
    write_comparison(comparison, path, parameters, first_seed)
    return comparison
