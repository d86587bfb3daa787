"""Standard against personalized ranks over many graphs at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.operators.graph import Graph
from velorank.operators.ranking import PERSONALIZED, STANDARD, rank_variants, top_ranks


@dataclass(frozen=True)
class Comparison:
    """``per_run`` has one row per run, ``summary`` the mean overlap ratio."""

    per_run: DataFrame
    summary: DataFrame


def compare_rankings(
    graphs: Graph,
    seeds: DataFrame,
    k: int,
    max_iter: int = 20,
    epsilon: float = 1e-3,
    damping: float = 0.85,
    num_partitions: int | None = None,
) -> Comparison:
    """Overlap of the standard and the personalized top ``k`` of every run.

    ``graphs`` is keyed by ``run``; ``seeds`` has ``run, id``.  All runs and both
    kinds of rank advance in the same rounds.
    """
    ranking = rank_variants(graphs, [STANDARD, PERSONALIZED], seeds, max_iter, epsilon, damping, num_partitions)
    ranks = ranking.ranks
    best = {v: top_ranks(ranks.select("run", "id", F.col(v).alias("rank")), k, keys=["run"]) for v in (STANDARD, PERSONALIZED)}
    lists = {v: _ordered_ids(top, f"topK_{v}") for v, top in best.items()}
    found = {v: F.coalesce(f"topK_{v}", F.array().cast("array<bigint>")) for v in lists}
    # The ids of a list are distinct; a missing id equals no other.
    count = F.size(F.array_compact(F.array_intersect(*found.values()))).cast("bigint")
    ratio = count / k if k > 0 else F.lit(0.0)

    def with_lists(runs: DataFrame) -> DataFrame:
        return runs.join(lists[STANDARD], "run", "left").join(lists[PERSONALIZED], "run", "left")

    chosen = seeds.groupBy("run").agg(F.sort_array(F.collect_set("id")).alias("seeds"))
    per_run = with_lists(chosen).select(
        "run", "seeds", *[ids.alias(f"topK_{v}") for v, ids in found.items()], count.alias("overlap_count"), ratio.alias("overlap_ratio")
    )
    # The mean does not need the seeds themselves.
    ratios = with_lists(seeds.select("run").distinct()).select(ratio.alias("overlap_ratio"))
    return Comparison(per_run, _summary(ratios))


def no_comparison(spark: SparkSession) -> Comparison:
    """The comparison of no runs: no rows and a mean overlap of zero."""
    schema = (
        "run int, seeds array<bigint>, topK_standard array<bigint>, topK_personalized array<bigint>, "
        "overlap_count bigint, overlap_ratio double"
    )
    per_run = spark.createDataFrame([], schema)
    return Comparison(per_run, _summary(per_run))


def _summary(per_run: DataFrame) -> DataFrame:
    return per_run.agg(F.coalesce(F.avg("overlap_ratio"), F.lit(0.0)).alias("average_overlap_ratio"))


def _ordered_ids(top: DataFrame, name: str) -> DataFrame:
    """The at most ``k`` ids of each run, best first."""
    packed = F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("below"), "id")))
    return top.groupBy("run").agg(packed.alias("_packed")).select("run", F.col("_packed.id").alias(name))
