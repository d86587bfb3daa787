import hashlib
import random

import pytest
from pyspark.sql import functions as F

from velorank.operators import graph as g
from velorank.sources.graphs import random_graph, random_graphs, sample_vertices


@pytest.fixture(scope="module")
def star():
    """One source with most of the edges, a repeated edge, and a target that is no vertex."""
    edges = [(1, i) for i in range(2, 60)] + [(2, 1), (3, 1), (3, 1), (4, 999)]
    return edges, list(range(1, 61))


def frames(spark, edges, vertices=None):
    return g.Graph(
        spark.createDataFrame(edges, "src bigint, dst bigint"),
        None if vertices is None else spark.createDataFrame([(v,) for v in vertices], "id bigint"),
    )


def test_degrees_from_the_edges(spark):
    graph = frames(spark, [(1, 2), (1, 3), (3, 2)])
    assert {r.id: r.out_degree for r in g.vertex_degrees(graph).collect()} == {1: 2, 2: 0, 3: 1}
    assert [r.id for r in g.dangling_vertices(graph).collect()] == [2]


def test_degrees_with_listed_vertices(spark, star):
    degrees = {r.id: r.out_degree for r in g.vertex_degrees(frames(spark, *star)).collect()}
    assert sorted(degrees) == star[1]
    assert (degrees[1], degrees[3], degrees[4], degrees[60]) == (58, 2, 1, 0)


@pytest.mark.parametrize("length", [7, 100_000])
@pytest.mark.parametrize("stored_length", [7, 100_000])
def test_adjacency_has_one_shape(spark, star, length, stored_length):
    """The rows follow from the edges and the length, however sources are stored."""
    edges, vertices = star
    frame = g.adjacency(g.prepare_graph(frames(spark, edges, vertices), slice_edges=stored_length), length)
    assert frame.columns == ["node_id", "slice", "out_neighbors"]
    want = []
    for v in vertices:
        targets = sorted(t for s, t in edges if s == v)
        want += [(v, k // length, targets[k : k + length]) for k in range(0, max(len(targets), 1), length)]
    assert sorted((r.node_id, r.slice, r.out_neighbors) for r in frame.collect()) == sorted(want)


def test_adjacency_of_vertices_only(spark):
    frame = g.adjacency(frames(spark, [(1, 2), (9, 1)], [1, 2]))
    assert sorted((r.node_id, r.out_neighbors) for r in frame.collect()) == [(1, [2]), (2, [])]


def test_sources_are_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(1, 2), (1, 3), (3, 2)], "src bigint, dst bigint").mapInArrow(counted, "src bigint, dst bigint")
    ready = g.prepare_graph(g.Graph(edges))
    assert g.adjacency(ready).count() == 3
    assert g.contributions(ready, ready.vertices.selectExpr("id", "1D AS rank")).count() == 2
    assert reads.value == 3


@pytest.mark.parametrize("length", [7, 100_000])
def test_contributions(spark, star, length):
    edges, vertices = star
    ranks = spark.createDataFrame([(v, float(v)) for v in vertices], "id bigint, rank double")
    got = {r.id: r.contribution for r in g.contributions(frames(spark, edges, vertices), ranks, length).collect()}
    degree = {v: sum(s == v for s, _ in edges) for v in vertices}
    want = {}
    for src, dst in edges:
        want[dst] = want.get(dst, 0) + src / degree[src]
    assert got == pytest.approx(want)


def test_few_vertices_can_be_sliced():
    assert g.slice_length(10**13, 500) == g.SLICE_EDGES
    for edges in (10**12, 10**15):
        assert edges / g.slice_length(edges, g.MAX_SLICED + 1) <= g.MAX_SLICED


def plain_random_edges(nodes, wanted, seed):
    """Pairs in the order of their attempts, from the same digests."""
    kept = {}
    for attempt in range(max(10 * wanted, 1)):
        if len(kept) >= wanted:
            break
        digest = hashlib.md5(f"{seed}:{attempt}".encode()).hexdigest()
        pair = int(digest[:15], 16) % nodes, int(digest[15:30], 16) % nodes
        if pair[0] != pair[1]:
            kept.setdefault(pair)
    return sorted(kept)


# The last three cannot or can hardly reach the number of edges asked for.
@pytest.mark.parametrize("nodes, wanted", [(50, 200), (1000, 3000), (7, 0), (5, 18), (5, 20), (3, 50), (1, 4)])
def test_random_graph(spark, nodes, wanted):
    graph = random_graph(spark, nodes, wanted, 9)
    assert sorted(map(tuple, graph.edges.collect())) == plain_random_edges(nodes, wanted, 9)
    assert sorted(r.id for r in graph.vertices.collect()) == list(range(nodes))


def test_random_graphs_are_the_single_ones(spark):
    many = random_graphs(spark, 40, 100, [1, 2, 3])
    for run, seed in enumerate([1, 2, 3]):
        edges = many.edges.filter(f"run = {run}").drop("run").collect()
        assert sorted(map(tuple, edges)) == plain_random_edges(40, 100, seed)
    assert many.vertices.count() == 120


def test_random_graph_is_uniform(spark):
    degrees = [r.out_degree for r in g.vertex_degrees(random_graph(spark, 200, 20_000, 4)).collect()]
    assert sum(degrees) == 20_000
    assert 60 < min(degrees) and max(degrees) < 140


def test_no_vertices(spark):
    with pytest.raises(ValueError, match="empty graph"):
        random_graph(spark, 0, 10)


def test_sample(spark):
    vertices = spark.range(100)
    first = [r.id for r in sample_vertices(vertices, 10, 1).collect()]
    assert len(set(first)) == 10
    assert sorted(first) == sorted(r.id for r in sample_vertices(vertices.repartition(7), 10, 1).collect())
    assert sorted(first) != sorted(r.id for r in sample_vertices(vertices, 10, 2).collect())
    assert sample_vertices(vertices, 1000, 1).count() == 100


def test_sample_per_run(spark):
    graphs = random_graphs(spark, 30, 10, [5, 6])
    rows = sample_vertices(graphs.vertices, 4, [5, 6], ("run",)).collect()
    for run, seed in enumerate([5, 6]):
        alone = {r.id for r in sample_vertices(spark.range(30), 4, seed).collect()}
        assert {r.id for r in rows if r.run == run} == alone


def test_what_a_task_makes_distinct_follows_from_the_rows(spark, monkeypatch):
    """Adaptive execution does not merge the partitions, so that tasks get no more rows in a larger graph."""
    monkeypatch.setattr(g, "MOST_DISTINCT", 1000)
    rows = spark.range(40_000).selectExpr("id % 20000 AS src", "id % 20000 + 1 AS dst")
    edges = g.distinct_edges(rows, 40_000)
    per_task = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 20_000 and len(per_task) == 40 and max(per_task) < 1000
    several = g.distinct_edges(rows.selectExpr("cast(src % 2 AS INT) AS run", "1L AS src", "2L AS dst"), 40_000, ("run",))
    assert sorted(several.collect()) == [(0, 1, 2), (1, 1, 2)]
