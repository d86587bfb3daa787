import random

import pytest

from velorank.operators.dictionary import by_number, by_text, decode_ids, encode_graph, vertex_dictionary
from velorank.operators.ranking import pagerank
from velorank.sources.graphs import parse_named_edge_lines


def test_ids_follow_the_order_of_numbers_of_any_size(spark):
    draw = random.Random(1)
    numbers = sorted({draw.randrange(-(10**draw.randint(1, 60)), 10 ** draw.randint(1, 60)) for _ in range(500)} | {0, 2**63, -(2**63) - 1})
    names = spark.createDataFrame([(str(n),) for n in numbers for _ in range(2)] + [(None,)], "name string").repartition(5)
    got = vertex_dictionary(names, by_number).collect()
    assert sorted((r.id, int(r.name)) for r in got) == list(enumerate(numbers))


def test_ids_follow_the_order_of_text(spark):
    names = spark.createDataFrame([(n,) for n in ("b", "a", "", "é", "a b", "Z", "a")], "name string")
    got = {r.id: r.name for r in vertex_dictionary(names, by_text).collect()}
    assert [got[i] for i in range(len(got))] == ["", "Z", "a", "a b", "b", "é"]
    assert vertex_dictionary(names.limit(0)).count() == 0


def test_lines_of_long_ids(spark):
    lines = ["# c", "", "99999999999999999999 1", "+099999999999999999999\t01 more", "1 1", "-0 +5", "a b", "7", "-12345678901234567890123 -0"]
    rows = parse_named_edge_lines(spark.createDataFrame([(line,) for line in lines], "value string")).collect()
    assert sorted(map(tuple, rows)) == sorted([("99999999999999999999", "1"), ("0", "5"), ("-12345678901234567890123", "0")])


def test_ranks_of_named_vertices(spark):
    """The graph's ranks do not depend on how its vertices are called."""
    pairs = [(i % 17, (i * i + 1) % 23) for i in range(60) if i % 17 != (i * i + 1) % 23]
    big = 10**30
    plain, _ = encode_graph(spark.createDataFrame([(f"v{a:02}", f"v{b:02}") for a, b in set(pairs)], "src string, dst string"))
    graph, names = encode_graph(spark.createDataFrame([(str(a + big), str(b + big)) for a, b in set(pairs)], "src string, dst string"), by_number)
    assert sorted(map(tuple, graph.edges.collect())) == sorted(map(tuple, plain.edges.collect()))
    ranks = decode_ids(pagerank(graph, 4, 0.0).ranks, names)
    assert sum(r["rank"] for r in ranks.collect()) == pytest.approx(1)
    assert {int(r.id) - big for r in ranks.collect()} == {v for p in pairs for v in p}
