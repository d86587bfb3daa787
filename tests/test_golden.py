"""Published sample values of ten seeded random graphs."""

import hashlib
import random

import pytest
from plain_ranks import library_random_edges, plain_pagerank

from velorank.operators.comparison import compare_rankings
from velorank.operators.graph import Graph

NODES, EDGES, K, EPSILON = 5000, 20_000, 30, 1e-4

# First digits of the SHA-256 of all thirty best ids in ascending order, standard and personalized, by graph seed.
LISTS = {
    42: ("522370defbf8f92b", "12c015de88d1284b"), 43: ("d5018ba845a08c01", "918335c36cb73b51"),
    44: ("0d9863599fd46d44", "de620f81c01c2535"), 45: ("1d1ae98b302a3a3c", "09d8d02184e4eee1"),
    46: ("28e81c6c05a7e47d", "732366c48d5e75bd"), 47: ("9741fba83db3b549", "b4528ee0c16267fa"),
    48: ("0f2617bf33a9bcbf", "a152824b3c1b1bed"), 49: ("8d0d90af412750fd", "2fd44e9668ab1591"),
    50: ("fa9728c465d43d19", "afe10fe1e3862aca"), 51: ("71ba23eb3171fc6f", "795ae1b11e5ec336"),
}

# Graph seed, seed vertices, five best standard and five best
# personalized vertices, size of the overlap of the two top-30 lists.
RUNS = [
    (42, [912, 204, 2253, 2006, 1828], [1285, 1555, 1224, 3122, 1777], [2006, 204, 1828, 2253, 912], 0),
    (43, [315, 2343, 1179, 3789, 3030], [2877, 3128, 2629, 1498, 1750], [2343, 3789, 315, 3030, 1179], 0),
    (44, [3346, 4260, 4439, 955, 1447], [1957, 3565, 703, 845, 4499], [955, 4260, 3346, 1447, 4439], 0),
    (45, [2227, 3421, 3997, 2110, 670], [2015, 3991, 1474, 1042, 2395], [2110, 3421, 2227, 3997, 670], 0),
    (46, [625, 3276, 327, 4821, 4807], [2288, 3166, 3697, 3355, 4826], [4821, 3276, 625, 327, 4807], 0),
    (47, [2882, 512, 3524, 4535, 3716], [2035, 147, 1195, 4009, 521], [4535, 512, 2882, 3716, 3524], 2),
    (48, [4490, 2584, 1080, 4562, 4380], [2715, 2671, 3828, 3454, 1417], [2584, 4562, 1080, 4380, 4490], 0),
    (49, [547, 2820, 3385, 905, 2650], [4681, 856, 4247, 702, 681], [2820, 905, 2650, 3385, 547], 1),
    (50, [4075, 2180, 2982, 1986, 3876], [4649, 1461, 3480, 3508, 2224], [2180, 1986, 4075, 3876, 2982], 2),
    (51, [1994, 4114, 4524, 1326, 2015], [3712, 4841, 1333, 3534, 1586], [1326, 4114, 4524, 1994, 2015], 0),
]
AVERAGE_OVERLAP = 0.016666666666666666


def digest(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()[:16]


def test_sample_values(spark):
    edges, seeds, vertices = [], [], []
    for run, (seed, chosen, *_) in enumerate(RUNS):
        assert random.Random(seed).sample(range(NODES), k=5) == chosen
        edges += [(run, *pair) for pair in library_random_edges(NODES, EDGES, seed)]
        seeds += [(run, s) for s in chosen]
    edge_frame = spark.createDataFrame(edges, "run int, src bigint, dst bigint").repartition(8).cache()
    vertices = spark.range(NODES * len(RUNS)).selectExpr(f"cast(id div {NODES} as int) AS run", f"id % {NODES} AS id")
    graph = Graph(edge_frame, vertices, ("run",))
    compared = compare_rankings(graph, spark.createDataFrame(seeds, "run int, id bigint"), K, 20, EPSILON)
    rows = compared.per_run.orderBy("run").collect()
    for row, (seed, chosen, standard, personalized, overlap) in zip(rows, RUNS, strict=True):
        assert sorted(chosen) == row.seeds
        assert row.topK_standard[:5] == standard
        assert row.topK_personalized[:5] == personalized
        assert row.overlap_count == overlap
        assert (digest(row.topK_standard), digest(row.topK_personalized)) == LISTS[seed]
        # The whole lists, against the same graph ranked in memory.
        plain_edges = [e[1:] for e in edges if e[0] == row.run]
        for got, wanted in ((row.topK_standard, None), (row.topK_personalized, chosen)):
            ranks, _ = plain_pagerank(range(NODES), plain_edges, wanted, 20, EPSILON)
            assert [ranks[v] for v in got] == pytest.approx(sorted(ranks.values(), reverse=True)[:K], abs=1e-12)
    assert compared.summary.first()[0] == pytest.approx(AVERAGE_OVERLAP)
    edge_frame.unpersist()
