import glob
import json

import pytest

from velorank.operators.graph import Graph
from velorank.operators.ranking import pagerank
from velorank.plans.ranks import RankSettings, compare_random_graphs, rank_graph, write_random_comparison
from velorank.sinks import files
from velorank.sources.graphs import read_adjacency, read_edge_list, seed_frame


@pytest.fixture
def small_files(spark):
    """Files stay as many as partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def graph(spark):
    edges = spark.createDataFrame([(3, 1), (1, 2), (1, 3), (2, 1), (12, 3)], "src bigint, dst bigint")
    return Graph(edges, spark.createDataFrame([(i,) for i in (1, 2, 3, 12, 50)], "id bigint"))


def parts(path):
    return sorted(glob.glob(f"{path}/part-*"))


def pairs(graph):
    return sorted(map(tuple, graph.edges.select("src", "dst").collect()))


def test_report(spark, tmp_path):
    report = spark.createDataFrame([("b", 2), ("a", None)], "k string, n int").repartition(2).orderBy("k")
    for _ in range(2):  # the second write replaces the first
        files.write_report(report, f"{tmp_path}/one")
    (part,) = parts(f"{tmp_path}/one")
    assert open(part).read() == 'k,n\na,""\nb,2\n' or open(part).read() == "k,n\na,\nb,2\n"
    files.write_report(report.repartition(2), f"{tmp_path}/many", single_file=False)
    assert len(parts(f"{tmp_path}/many")) > 1


def test_edge_list_round_trip(spark, graph, tmp_path):
    files.write_edge_list(graph, f"{tmp_path}/e")
    assert "1\t2\n" in "".join(open(p).read() for p in parts(f"{tmp_path}/e"))
    assert pairs(read_edge_list(spark, f"{tmp_path}/e", "\t")) == pairs(graph)
    files.write_edge_list(graph, f"{tmp_path}/f", " ")
    assert pairs(read_edge_list(spark, f"{tmp_path}/f")) == pairs(graph)


def test_adjacency_round_trip(spark, graph, tmp_path):
    files.write_adjacency(graph, f"{tmp_path}/a")
    lines = [json.loads(line) for p in parts(f"{tmp_path}/a") for line in open(p)]
    assert {"node_id": 1, "slice": 0, "out_neighbors": [2, 3]} in lines and {"node_id": 50, "slice": 0, "out_neighbors": []} in lines
    back = read_adjacency(spark, f"{tmp_path}/a")
    assert pairs(back) == pairs(graph)
    assert sorted(r.id for r in back.vertices.collect()) == [1, 2, 3, 12, 50]


def test_ranks_are_in_id_order_over_all_files(spark, graph, tmp_path):
    ranks = pagerank(graph, 3).ranks
    files.write_ranks(ranks, f"{tmp_path}/r")
    lines = [line.rstrip("\n").split("\t") for p in parts(f"{tmp_path}/r") for line in open(p)]
    assert [int(i) for i, _ in lines] == [1, 2, 3, 12, 50]
    assert {int(i): float(r) for i, r in lines} == {r.id: r["rank"] for r in ranks.collect()}


def test_comparison_document(spark, tmp_path):
    settings = RankSettings(k=5, max_iter=4)
    comparison = write_random_comparison(spark, f"{tmp_path}/c", 2, 40, 100, 3, settings, 7)
    (line,) = [line for p in parts(f"{tmp_path}/c") for line in open(p)]
    document = json.loads(line)
    assert list(document) == [
        "runs", "K", "d", "max_iter", "epsilon", "num_nodes", "num_edges", "seeds_per_run", "per_run",
        "average_overlap_ratio",
    ]
    assert (document["runs"], document["K"], document["d"], document["num_nodes"]) == (2, 5, 0.85, 40)
    assert [r["graph_seed"] for r in document["per_run"]] == [7, 8]
    assert list(document["per_run"][0]) == [
        "run", "graph_seed", "seeds", "topK_standard", "topK_personalized", "overlap_count", "overlap_ratio",
    ]
    for row, run in zip(document["per_run"], comparison.per_run.orderBy("run").collect(), strict=True):
        assert row["topK_standard"] == run.topK_standard and len(run.topK_standard) == 5
        assert row["overlap_count"] == len(set(row["topK_standard"]) & set(row["topK_personalized"]))
    mean = sum(r["overlap_ratio"] for r in document["per_run"]) / 2
    assert document["average_overlap_ratio"] == pytest.approx(mean)


def test_comparison_lines(spark, tmp_path):
    comparison = compare_random_graphs(spark, 3, 30, 60, 2, RankSettings(k=4, max_iter=2))
    files.write_comparison_lines(comparison, f"{tmp_path}/l")
    assert [json.loads(line)["run"] for p in parts(f"{tmp_path}/l") for line in open(p)] == [0, 1, 2]


def test_no_runs_and_no_list(spark):
    assert compare_random_graphs(spark, 0, 10, 10, 1, RankSettings()).summary.first()[0] == 0.0
    row = compare_random_graphs(spark, 1, 10, 20, 2, RankSettings(k=0, max_iter=1)).per_run.first()
    assert (row.topK_standard, row.overlap_count, row.overlap_ratio) == ([], 0, 0.0)


def test_rank_graph_chooses_by_seeds(spark, graph):
    settings = RankSettings(max_iter=2)
    assert rank_graph(graph, settings).num_seeds == 0
    assert rank_graph(graph, settings, seed_frame(spark, "1,2")).num_seeds == 2


def test_ranks_are_read_back_in_place(spark, tmp_path, small_files):
    ranks = spark.range(1000).selectExpr("id * 3 - 50 AS id", "id / 7D AS rank").repartition(5)
    files.write_ranks(ranks, f"{tmp_path}/r")
    assert len(parts(f"{tmp_path}/r")) > 1
    back = sorted((r.place, r.id, r["rank"]) for r in files.read_ranks(spark, f"{tmp_path}/r").collect())
    assert back == [(i, i * 3 - 50, i / 7) for i in range(1000)]
    manifest = [json.loads(line) for p in parts(f"{tmp_path}/r-manifest") for line in open(p)]
    assert sum(m["rows"] for m in manifest) == 1000 and [m["first_id"] for m in manifest] == sorted(m["first_id"] for m in manifest)


@pytest.mark.parametrize("harm", ["lost", "more", "changed"])
def test_rank_files_that_differ_from_their_manifest(spark, tmp_path, small_files, harm):
    import os

    files.write_ranks(spark.range(100).selectExpr("id", "0.5D AS rank").repartition(3), f"{tmp_path}/r")
    first = parts(f"{tmp_path}/r")[0]
    for name in glob.glob(f"{tmp_path}/r/.*.crc"):
        os.remove(name)
    if harm == "lost":
        os.remove(first)
    elif harm == "more":
        open(f"{tmp_path}/r/part-99999-x.csv", "w").write("500\t0.1\n")
    else:
        text = open(first).read()
        open(first, "w").write(text + "200\t0.5\n")
    with pytest.raises(ValueError, match="manifest"):
        files.read_ranks(spark, f"{tmp_path}/r")


def test_report_file_has_its_name(spark, tmp_path):
    for n in (1, 2):  # the second one replaces the first
        files.write_report_file(spark.createDataFrame([("a", n)], "k string, n int").repartition(3), f"{tmp_path}/out/report.csv")
        assert open(f"{tmp_path}/out/report.csv").read() == f"k,n\na,{n}\n"
    assert [p for p in glob.glob(f"{tmp_path}/out/*")] == [f"{tmp_path}/out/report.csv"]
    empty = spark.createDataFrame([], "k string, n int")
    files.write_report_file(empty, f"{tmp_path}/out/empty.csv")
    assert open(f"{tmp_path}/out/empty.csv").read().startswith("k,n") or open(f"{tmp_path}/out/empty.csv").read() == ""
