import random

import pytest
from plain_ranks import plain_pagerank
from plan_text import count, own_operators

from velorank.operators import ranking as k
from velorank.operators.comparison import compare_rankings
from velorank.operators.graph import Graph


def some_edges(nodes, count, seed):
    """Random pairs, a third of them from one source and a third to one target."""
    draw = random.Random(seed)
    pairs = set()
    while len(pairs) < count:
        pair = (draw.randrange(nodes), draw.randrange(nodes))
        turn = draw.random()
        if turn < 1 / 3:
            pair = (0, pair[1])
        elif turn < 2 / 3:
            pair = (pair[0], 1)
        if pair[0] != pair[1] and pair[0] % 11 != 5:
            pairs.add(pair)
    return sorted(pairs)


@pytest.fixture(scope="module")
def edges():
    return some_edges(120, 260, 1)


def graph_of(spark, edges, vertices=None):
    frame = spark.createDataFrame(edges, "src bigint, dst bigint")
    return Graph(frame, None if vertices is None else spark.createDataFrame([(v,) for v in vertices], "id bigint"))


def endpoints(edges):
    return {v for pair in edges for v in pair}


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def by_id(ranking):
    return {r.id: r["rank"] for r in ranking.ranks.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    assert got == pytest.approx(want, abs=1e-12)


def test_standard(spark, edges):
    want, changes = plain_pagerank(endpoints(edges), edges, max_iter=50, epsilon=1e-2)
    result = k.pagerank(graph_of(spark, edges), 50, 1e-2)
    close(by_id(result), want)
    assert [r.delta for r in result.convergence().orderBy("iteration").collect()] == pytest.approx(changes)
    assert result.iterations == len(changes) < 50
    (last,) = result.last_deltas().collect()
    assert last.last_delta < 1e-2 and last.iterations == len(result.round_seconds) == len(changes)
    assert sum(want.values()) == pytest.approx(1)


@pytest.mark.parametrize("partitions", [1, 3])
def test_number_of_partitions_does_not_matter(spark, edges, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    result = k.pagerank(graph_of(spark, edges), 5, 0.0, num_partitions=partitions)
    assert result.num_partitions == partitions
    close(by_id(result), plain_pagerank(endpoints(edges), edges, max_iter=5, epsilon=0)[0])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_damping(spark, edges):
    want, _ = plain_pagerank(endpoints(edges), edges, max_iter=4, epsilon=0, damping=0.5)
    close(by_id(k.pagerank(graph_of(spark, edges), 4, 0.0, 0.5)), want)


def test_personalized(spark, edges):
    want, changes = plain_pagerank(endpoints(edges), edges, [0, 3, 7], 50, 1e-2)
    result = k.personalized_pagerank(graph_of(spark, edges), ids(spark, [0, 3, 7, 7, 0]), 50, 1e-2)
    close(by_id(result), want)
    assert result.num_seeds == 3 and result.iterations == len(changes)


def test_unknown_seeds_take_their_share(spark, edges):
    want, _ = plain_pagerank(endpoints(edges), edges, [0, 5000], 6, 0)
    result = k.personalized_pagerank(graph_of(spark, edges), ids(spark, [0, 5000]), 6, 0.0)
    close(by_id(result), want)
    assert sum(want.values()) < 1 and result.num_seeds == 2


def test_all_vertices_as_seeds_is_the_standard_rank(spark, edges):
    graph = graph_of(spark, edges)
    close(
        by_id(k.personalized_pagerank(graph, ids(spark, endpoints(edges)), 8, 0.0)), by_id(k.pagerank(graph, 8, 0.0))
    )


def test_isolated_vertices_repeated_and_unknown_targets(spark):
    edges = [(1, 2), (1, 2), (1, 3), (2, 77), (3, 1)]
    vertices = [1, 2, 3, 4]
    want, _ = plain_pagerank(vertices, edges, max_iter=6, epsilon=0)
    result = k.pagerank(graph_of(spark, edges, vertices), 6, 0.0)
    close(by_id(result), want)
    assert {r.id: r.out_degree for r in result.ranks.collect()} == {1: 3, 2: 1, 3: 1, 4: 0}
    assert sum(want.values()) < 1


@pytest.mark.parametrize("slice_edges", [3, 20])
def test_cut_up_sources(spark, edges, slice_edges):
    result = k.rank_variants(graph_of(spark, edges), [k.STANDARD], None, 5, 0.0, 0.85, 4, slice_edges)
    got = {r.id: r[k.STANDARD] for r in result.ranks.collect()}
    close(got, plain_pagerank(endpoints(edges), edges, max_iter=5, epsilon=0)[0])


def test_no_rounds(spark, edges):
    result = k.pagerank(graph_of(spark, edges), 0)
    n = len(endpoints(edges))
    close(by_id(result), {v: 1 / n for v in endpoints(edges)})
    assert result.iterations == 0 and result.last_deltas().count() == 0
    assert result.convergence().count() == 0


def test_empty_graph(spark):
    with pytest.raises(ValueError, match="no vertex"):
        k.pagerank(graph_of(spark, []))


def test_no_seeds(spark, edges):
    with pytest.raises(ValueError, match="at least one seed"):
        k.personalized_pagerank(graph_of(spark, edges), ids(spark, []))
    with pytest.raises(ValueError, match="at least one seed"):
        k.rank_variants(graph_of(spark, edges), [k.PERSONALIZED], None, 1, 0.0, 0.85)


def test_relabelled_vertices_keep_their_ranks(spark, edges):
    moved = [(1000 - 3 * s, 1000 - 3 * t) for s, t in edges]
    plain, other = by_id(k.pagerank(graph_of(spark, edges), 5, 0.0)), by_id(k.pagerank(graph_of(spark, moved), 5, 0.0))
    close({(1000 - i) // 3: r for i, r in other.items()}, plain)


def test_top_ranks(spark):
    ranks = spark.createDataFrame([(4, 0.5), (2, 0.2), (1, 0.2), (3, 0.1)], "id bigint, rank double")
    assert [r.id for r in k.top_ranks(ranks, 2).collect()] == [4, 1]
    assert [r.id for r in k.top_ranks(ranks, 99).collect()] == [4, 1, 2, 3]
    assert k.top_ranks(ranks, 0).count() == 0


def test_convergence_table(spark, edges):
    result = k.pagerank(graph_of(spark, edges), 3, 0.0)
    rows = result.convergence().orderBy("iteration").collect()
    assert [(r.iteration, r.num_partitions, r.num_seeds) for r in rows] == [(n, result.num_partitions, 0) for n in (1, 2, 3)]
    assert all(r.seconds > 0 and r.variant == "standard" for r in rows)
    dangling = [v for v in endpoints(edges) if v not in {s for s, _ in edges}]
    assert rows[0].dangling_mass == pytest.approx(len(dangling) / len(endpoints(edges)))


@pytest.fixture(scope="module")
def several(spark):
    """Three graphs of different sizes that converge after different numbers of rounds."""
    all_edges = {0: some_edges(40, 60, 2), 1: some_edges(90, 300, 3), 2: [(1, 2), (2, 1)]}
    seeds = {0: [0, 3], 1: [7, 8, 9], 2: [1, 2]}
    frame = spark.createDataFrame([(r, *e) for r, es in all_edges.items() for e in es], "run int, src bigint, dst bigint")
    chosen = spark.createDataFrame([(r, s) for r, ss in seeds.items() for s in ss], "run int, id bigint")
    return all_edges, seeds, Graph(frame, None, ("run",)), chosen


def test_several_graphs_at_once(spark, several):
    all_edges, seeds, graph, chosen = several
    result = k.rank_variants(graph, [k.STANDARD, k.PERSONALIZED], chosen, 30, 2e-2, 0.85)
    rows, steps = result.ranks.collect(), result.convergence().collect()
    rounds = set()
    for run, edges in all_edges.items():
        for variant, wanted_seeds in ((k.STANDARD, None), (k.PERSONALIZED, seeds[run])):
            want, changes = plain_pagerank(endpoints(edges), edges, wanted_seeds, 30, 2e-2)
            close({r.id: r[variant] for r in rows if r.run == run}, want)
            own = sorted((x.iteration, x.delta) for x in steps if x.run == run and x.variant == variant)
            assert [d for _, d in own] == pytest.approx(changes)
            assert {x.num_seeds for x in steps if x.run == run} == {len(seeds[run])}
            rounds.add(len(changes))
    assert len(rounds) > 2
    assert len(result.round_seconds) == result.iterations == max(rounds)
    assert result.total_seconds == pytest.approx(sum(result.round_seconds))


@pytest.mark.parametrize("top", [5, 1000])
def test_comparison(spark, several, top):
    all_edges, seeds, graph, chosen = several
    compared = compare_rankings(graph, chosen, top, 30, 2e-2)
    ratios = []
    for row in compared.per_run.orderBy("run").collect():
        edges = all_edges[row.run]
        lists = []
        for wanted in (None, seeds[row.run]):
            ranks, _ = plain_pagerank(endpoints(edges), edges, wanted, 30, 2e-2)
            lists.append(sorted(ranks, key=lambda v: (-round(ranks[v], 12), v))[:top])
        assert row.seeds == seeds[row.run]
        assert set(row.topK_standard) == set(lists[0]) and set(row.topK_personalized) == set(lists[1])
        assert row.overlap_count == len(set(lists[0]) & set(lists[1]))
        assert row.overlap_ratio == row.overlap_count / top
        ratios.append(row.overlap_ratio)
    assert compared.summary.first()[0] == pytest.approx(sum(ratios) / 3)


def test_the_plan_does_not_grow(spark, edges, monkeypatch):
    sizes = []
    plain = k._next_state

    def watched(*args):
        frame = plain(*args)
        sizes.append(len(frame._jdf.queryExecution().optimizedPlan().toString()))
        return frame

    monkeypatch.setattr(k, "_next_state", watched)
    k.pagerank(graph_of(spark, edges), 6, 0.0)
    assert max(sizes[2:]) - min(sizes[2:]) < 200


@pytest.mark.parametrize("slice_edges, joins, exchanges", [(10, 3, 2), (1000, 2, 1)])
def test_a_round_moves_only_contributions(spark, edges, monkeypatch, slice_edges, joins, exchanges):
    """One exchange of pre-summed contributions; sources of very many edges also send their rank to their slices."""
    plans = []
    plain = k._next_state

    def watched(*args):
        frame = plain(*args)
        plans.append((own_operators(frame), [count(frame, n) for n in ("Exchange", "Sort ", "SortMergeJoin")]))
        return frame

    monkeypatch.setattr(k, "_next_state", watched)
    k.rank_variants(graph_of(spark, edges), [k.STANDARD], None, 3, 0.0, 0.85, 3, slice_edges)
    operators, (found, _, found_joins) = plans[-1]
    assert (found, found_joins) == (exchanges, joins)
    assert not any("Python" in line for line in operators)


def layered(width, depth):
    """Edges from each layer to the next one: what starts somewhere is past the last layer after ``depth`` rounds."""
    return sorted({(layer * width + i, (layer + 1) * width + j) for layer in range(depth) for i in range(width) for j in (i, (i * 7 + 1) % width)})


def test_only_vertices_a_wave_has_reached_send(spark):
    edges = layered(12, 4)
    result = k.rank_variants(graph_of(spark, edges), [k.STANDARD, k.PERSONALIZED], ids(spark, [0, 1, 15]), 25, 0.0, 0.85)
    assert result.senders == [48, 36, 24, 12] and result.iterations == 25
    rows = result.ranks.collect()
    for variant, seeds in ((k.STANDARD, None), (k.PERSONALIZED, [0, 1, 15])):
        want, changes = plain_pagerank(endpoints(edges), edges, seeds, 25, 0.0)
        close({r.id: r[variant] for r in rows}, want)
        steps = result.convergence().filter(f"variant = '{variant}'").orderBy("iteration").collect()
        assert [r.delta for r in steps] == pytest.approx(changes, abs=1e-14)


def test_rounds_go_on_where_all_vertices_keep_sending(spark, edges):
    """Loops of edges: waves never die, and several checks are needed."""
    want, _ = plain_pagerank(endpoints(edges), edges, max_iter=2 * k.ROUNDS_PER_CHECK + 1, epsilon=0)
    result = k.pagerank(graph_of(spark, edges), 2 * k.ROUNDS_PER_CHECK + 1, 0.0)
    close(by_id(result), want)
    assert len(result.senders) == 2 * k.ROUNDS_PER_CHECK + 1


def test_a_stopped_run_goes_on_after_its_last_round(spark, edges, tmp_path, monkeypatch):
    graph, chosen, folder = graph_of(spark, edges), ids(spark, [0, 3, 7]), str(tmp_path / "progress")
    whole = k.personalized_pagerank(graph, chosen, 12, 0.0)
    k.personalized_pagerank(graph, chosen, 7, 0.0, progress=folder)
    rounds, plain = [], k._next_state
    monkeypatch.setattr(k, "_next_state", lambda *args: rounds.append(1) or plain(*args))
    rest = k.personalized_pagerank(graph, chosen, 12, 0.0, progress=folder)
    assert len(rounds) == 5 and rest.iterations == 12
    close(by_id(rest), by_id(whole))

    def history(ranking):
        return [(r.iteration, r.num_seeds, pytest.approx(r.delta), pytest.approx(r.dangling_mass)) for r in ranking.convergence().orderBy("iteration").collect()]

    assert history(rest) == history(whole) and rest.senders == whole.senders
    with pytest.raises(ValueError, match="another graph"):
        k.personalized_pagerank(graph, chosen, 12, 0.0, 0.5, progress=folder)
    with pytest.raises(ValueError, match="another graph"):
        k.pagerank(graph_of(spark, [(1, 2)]), 3, progress=folder)


def test_a_round_is_one_write_and_checks_are_shared(spark, several, monkeypatch):
    """The sums of all graphs are taken once for some rounds."""
    _, _, graph, chosen = several
    measured, plain = [], k._Levels.measure
    monkeypatch.setattr(k._Levels, "measure", lambda self, waves, rounds: measured.append(rounds) or plain(self, waves, rounds))
    result = k.rank_variants(graph, [k.STANDARD, k.PERSONALIZED], chosen, 9, 0.0, 0.85)
    assert measured == [4, 8, 9] and result.iterations == 9


def test_changes_are_taken_by_compiled_arithmetic(spark, several, monkeypatch):
    """Functions over arrays are interpreted for every vertex; none is left in what is summed over the vertices."""
    _, _, graph, chosen = several
    plans, plain = [], k._Levels._merged
    monkeypatch.setattr(k._Levels, "_merged", lambda self, sums: plans.append(own_operators(sums)) or plain(self, sums))
    k.rank_variants(graph, [k.STANDARD, k.PERSONALIZED], chosen, 9, 0.0, 0.85)
    sums = [line for operators in plans for line in operators if "Aggregate" in line]
    assert sums and not [line for line in sums if "lambda" in line]


def test_rounds_at_once():
    assert k._rounds_at_once(3) == k.ROUNDS_PER_SUM and k._rounds_at_once(1000) == k.ROUNDS_PER_CHECK
