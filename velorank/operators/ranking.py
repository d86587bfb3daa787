"""Standard and personalized PageRank by waves over a DataFrame.

Ranks after t rounds are sums of waves: what starts at every vertex (or seed) and has
moved along k edges, weighed by how much started t - k rounds ago.  The weights depend
on the ranks of dangling vertices alone, whose sums follow from the waves' own sums.
So a round only moves the last wave along the edges: vertices that it has not reached
have nothing to send, and once no vertex has, the remaining rounds are arithmetic.

Waves are hash-partitioned by vertex and stay so: they meet the neighbour lists,
laid out by source in the same partitions, without a shuffle, and a round moves
nothing but the contributions, summed before the shuffle.  Its result is written to
the shared folder in one job, so the plan and the lineage are equally short in every
round and a lost executor costs at most one round.  The sums of all graphs are taken
once for some rounds, as rows of a DataFrame; of many graphs only how many have not
converged reaches the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from velorank.operators.graph import SLICE_EDGES, Graph, PreparedGraph, fixed_layout, moved, prepare_graph
from velorank.operators.selection import top_k
from velorank.session import broadcast_if_small

STANDARD = "standard"
PERSONALIZED = "personalized"
# Rows of per-graph sums that are not worth a task of their own.
GRAPHS_PER_TASK = 100_000
# Rounds whose sums are taken together while waves move.
ROUNDS_PER_CHECK = 4
# The same once no wave moves any more and rounds are arithmetic.
ROUNDS_PER_SUM = 32
# Products per variant and family that one expression spells out, see `_dot`; fewer rounds go with more waves.
PRODUCTS = 256
# A wave this small adds nothing to a rank, which is a multiple of at least (1 - damping) of the first wave's one.
SILENT = 1e-20


@dataclass(frozen=True)
class Ranking:
    """Ranks ``id, out_degree, <variant>...`` and how they were reached.

    ``history`` has a row per round, graph and variant that was still open:
    the graph's keys, ``variant``, ``iteration``, ``delta``, ``dangling_mass``,
    ``seconds``, ``num_partitions``, ``num_seeds``.  ``senders`` says how many
    vertices sent anything in each round that moved a wave.
    """

    ranks: DataFrame
    history: DataFrame
    round_seconds: list[float]
    num_partitions: int
    num_seeds: int = 0
    num_vertices: int = 0
    senders: list[int] = field(default_factory=list)

    @property
    def iterations(self) -> int:
        return len(self.round_seconds)

    @property
    def total_seconds(self) -> float:
        return sum(self.round_seconds)

    def convergence(self) -> DataFrame:
        return self.history

    def last_deltas(self) -> DataFrame:
        """The last change of each graph and variant."""
        keys = [c for c in self.history.columns if c not in _HISTORY]
        return self.history.groupBy(*keys, "variant").agg(
            F.max("iteration").alias("iterations"), F.max_by("delta", "iteration").alias("last_delta")
        )


_HISTORY = ("variant", "iteration", "delta", "dangling_mass", "seconds", "num_partitions", "num_seeds")


def pagerank(
    graph: Graph | PreparedGraph,
    max_iter: int = 20,
    epsilon: float = 1e-3,
    damping: float = 0.85,
    num_partitions: int | None = None,
    progress: str | None = None,
) -> Ranking:
    """Ranks ``id, out_degree, rank``; stops once the L1 change is below ``epsilon``."""
    return _single(rank_variants(graph, [STANDARD], None, max_iter, epsilon, damping, num_partitions, progress=progress), STANDARD)


def personalized_pagerank(
    graph: Graph | PreparedGraph,
    seeds: DataFrame | None = None,
    max_iter: int = 20,
    epsilon: float = 1e-3,
    damping: float = 0.85,
    num_partitions: int | None = None,
    progress: str | None = None,
) -> Ranking:
    """Ranks with random jumps to the ``seeds`` only (those of a prepared graph are known already).

    The rank of dangling vertices is still spread over all vertices.  Seeds that
    are no vertex count as seeds, so the share they would get is lost.
    """
    return _single(rank_variants(graph, [PERSONALIZED], seeds, max_iter, epsilon, damping, num_partitions, progress=progress), PERSONALIZED)


def _single(result: Ranking, variant: str) -> Ranking:
    return replace(result, ranks=result.ranks.withColumnRenamed(variant, "rank"))


def top_ranks(ranks: DataFrame, k: int, rank: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """The ``k`` highest ranks, ties by ascending id; all of them if fewer."""
    return top_k(ranks, list(keys), [F.col(rank).desc(), F.col("id").asc()], k)


def rank_variants(
    graph: Graph | PreparedGraph,
    variants: Sequence[str],
    seeds: DataFrame | None,
    max_iter: int,
    epsilon: float,
    damping: float,
    num_partitions: int | None = None,
    slice_edges: int = SLICE_EDGES,
    progress: str | None = None,
) -> Ranking:
    """Rank every graph in ``graph`` by every variant, in the same rounds.

    The variants share the neighbour lists and the shuffle.  A graph's variant
    that has converged keeps its ranks while the others go on.  With ``progress``, a
    durable folder, each round's waves are kept there as well, and a run that is
    started again with the same graph goes on after the last complete round.
    """
    ready = graph if isinstance(graph, PreparedGraph) else prepare_graph(graph, seeds, num_partitions, slice_edges)
    if ready.totals["vertices"] == 0:
        raise ValueError("the graph has no vertex")
    with fixed_layout(ready.flags.sparkSession, ready.partitions):
        levels = _Levels(ready, variants, epsilon, damping)
        if PERSONALIZED in variants and levels.without_seeds():
            raise ValueError("personalized ranks need at least one seed in every graph")
        waves = _Waves(ready, PERSONALIZED in variants, damping, progress)
        while True:
            while waves.alive and waves.depth < min(max_iter, levels.rounds + ROUNDS_PER_CHECK):
                waves.advance(levels)
            levels.measure(waves, min(max_iter, waves.depth if waves.alive else levels.rounds + _rounds_at_once(waves.depth)))
            if levels.rounds >= max_iter or not levels.open:
                break
        iterations = levels.iterations()
        history = levels.history(iterations)
        ranks = levels.ranks(waves)
    return Ranking(ranks, history, levels.seconds[:iterations], ready.partitions, ready.totals["seeds"], ready.totals["vertices"], waves.senders)


def _rounds_at_once(depth: int) -> int:
    """Rounds of arithmetic over ``depth`` waves whose changes are taken together."""
    return max(ROUNDS_PER_CHECK, min(ROUNDS_PER_SUM, PRODUCTS // (depth + 1)))


def _next_state(ready: PreparedGraph, state: DataFrame, levels: _Levels, families: Sequence[str], depth: int, damping: float) -> DataFrame:
    """The plan of a round: each family's wave, moved along one more edge.

    A vertex's waves are an array without the zeros at its end, so what has not
    been reached takes no room.
    """
    keys = list(ready.keys)
    names = [f"_give_{f}" for f in families]
    giving = levels.running(state.filter(_sends(families))).select(
        *keys, "id", "out_degree", *[(F.col(f"{f}_last") * damping / F.col("out_degree")).alias(n) for f, n in zip(families, names)]
    )
    # Ids that are no vertex are not in the state; what they receive is lost.
    got = moved(ready, giving, names).groupBy("id", *keys).agg(*[F.sum(n).alias(n) for n in names])
    both = state.join(got, ["id", *keys], "left")
    after = []
    for f, n in zip(families, names):
        waves = F.col(f"{f}_waves")
        gap = F.array_repeat(F.lit(0.0), F.lit(depth) - F.size(waves))
        after += [
            F.coalesce(n, F.lit(0.0)).alias(f"{f}_last"),
            F.when(F.col(n) > 0, F.concat(waves, gap, F.array(n))).otherwise(waves).alias(f"{f}_waves"),
        ]
    return both.select(*keys, "id", "out_degree", "is_seed", *after)


def _sends(families: Sequence[str]) -> Column:
    return (F.col("out_degree") > 0) & reduce(lambda a, b: a | b, [F.col(f"{f}_last") > SILENT for f in families])


UNIFORM, SEEDED = "uniform", "seeded"


class _Waves:
    """All waves so far: ``<family>_last`` and ``<family>_waves`` of each vertex.

    The uniform family starts with one at every vertex, the seeded one with one at
    every seed; these starts are wave 0 and not stored.
    """

    def __init__(self, ready: PreparedGraph, personalized: bool, damping: float, progress: str | None) -> None:
        self._ready, self._damping, self._progress = ready, damping, progress
        self.families = [UNIFORM, SEEDED] if personalized else [UNIFORM]
        self.depth, self.senders, self.seconds = 0, [], []
        columns = {f"{f}_last": F.expr(_start(f)) for f in self.families} | {f"{f}_waves": F.array().cast("array<double>") for f in self.families}
        self.state = ready.flags.filter("is_vertex").drop("is_vertex").withColumns(columns)
        self._next_senders = ready.totals["vertices"] - ready.totals["dangling"]
        if progress:
            self._resume()

    @property
    def alive(self) -> bool:
        return self._next_senders > 0

    def advance(self, levels: _Levels) -> None:
        began, watch = time.perf_counter(), Observation()
        plan = _next_state(self._ready, self.state, levels, self.families, self.depth, self._damping)
        self.state = plan.observe(watch, F.count_if(_sends(self.families)).alias("senders")).checkpoint()
        self.depth += 1
        self.senders.append(self._next_senders)
        self._next_senders = watch.get["senders"]
        self.seconds.append(time.perf_counter() - began)
        if self._progress:
            self._keep()

    # The manifest has a row per complete round, written after the round's waves.
    _MANIFEST = "round int, folder string, senders bigint, sent array<bigint>, seconds array<double>, vertices bigint, seeds bigint, damping double, families string"

    def _facts(self) -> tuple:
        return self._ready.totals["vertices"], self._ready.totals["seeds"], self._damping, ",".join(self.families)

    def _keep(self) -> None:
        spark, folder = self.state.sparkSession, f"{self._progress}/round-{self.depth}"
        self.state.write.mode("overwrite").parquet(folder)
        row = (self.depth, folder, self._next_senders, self.senders, self.seconds, *self._facts())
        spark.createDataFrame([row], self._MANIFEST).coalesce(1).write.mode("append").json(f"{self._progress}/manifest")

    def _resume(self) -> None:
        spark = self.state.sparkSession
        try:
            last = spark.read.schema(self._MANIFEST).json(f"{self._progress}/manifest").orderBy(F.col("round").desc()).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if last is None:
            return
        if (last.vertices, last.seeds, last.damping, last.families) != self._facts():
            raise ValueError(f"{self._progress} holds rounds of another graph or with other settings")
        place = ["id", *self._ready.keys]
        kept = spark.read.parquet(last.folder).select(self.state.columns)
        self.state = kept.repartition(self._ready.partitions, *place).sortWithinPartitions(*place).checkpoint()
        self.depth, self.senders, self.seconds, self._next_senders = last["round"], last.sent, last.seconds, last.senders


class _Levels:
    """Per graph: the waves' sums over dangling vertices, and what follows from them for every round.

    ``sum_<family>`` has a number per wave, ``mass_<variant>`` the rank of dangling
    vertices before each round, ``delta_<variant>`` the change of each, ``stop_<variant>``
    the round after which the variant has converged.  One graph's row is held by the
    driver, those of many graphs are a table.
    """

    def __init__(self, ready: PreparedGraph, variants: Sequence[str], epsilon: float, damping: float) -> None:
        self._ready, self._variants, self._epsilon, self._damping, self._keys = ready, list(variants), epsilon, damping, list(ready.keys)
        self.rounds, self.seconds, self._known, self._closed = 0, [], -1, False
        spark = ready.flags.sparkSession
        if self._keys:
            counts = ready.flags.groupBy(*self._keys).agg(
                F.count_if("is_vertex").alias("vertices"), F.count_if("is_seed").alias("seeds")
            ).filter("vertices > 0")
        else:
            counts = spark.createDataFrame([(ready.totals["vertices"], ready.totals["seeds"])], "vertices bigint, seeds bigint")
        empty = F.array().cast("array<double>")
        self._rows = counts.withColumns(
            {f"sum_{f}": empty for f in (UNIFORM, SEEDED)}
            | {f"delta_{v}": empty for v in self._variants} | {f"stop_{v}": F.lit(None).cast("int") for v in self._variants}
        )
        if self._keys:
            self._rows = self._rows.checkpoint()
        self._graphs = self._rows.count() if self._keys else 1
        self.open = self._graphs

    def without_seeds(self) -> bool:
        return not self._rows.filter("seeds = 0").isEmpty()

    def _small(self, rows: DataFrame) -> DataFrame:
        """Broadcast for up to a counted million graphs; beyond that Spark shuffles."""
        return broadcast_if_small(rows, self._graphs)

    def running(self, df: DataFrame) -> DataFrame:
        """Rows of graphs that have not converged."""
        if not self._closed:
            return df
        return df.join(self._small(self._rows.filter(self._is_open()).select(*self._keys)), self._keys, "left_semi")

    def _is_open(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(f"stop_{v}").isNull() for v in self._variants])

    def _joined(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """``df`` with values computed (in SQL) from each graph's row."""
        values = self._rows.selectExpr(*self._keys, *[f"{text} AS {n}" for n, text in columns.items()])
        if self._keys:
            return df.join(self._small(values), self._keys)
        row = values.first()
        return df.withColumns({n: F.expr(_literal(row[n])) for n in columns})

    def _merged(self, sums: DataFrame) -> DataFrame:
        """Each graph's row with newly taken sums, which are moved to the driver for one graph."""
        if self._keys:
            return self._rows.join(sums, self._keys)
        row = sums.first()
        return self._rows.withColumns({n: F.expr(_literal(row[n])) for n in sums.columns})

    def _written(self, rows: DataFrame, watch: Observation | None = None) -> DataFrame:
        """The rows, once computed: a table in few files, or the one row itself."""
        if self._keys:
            # Not coalesce: one task would then hold what all of the tasks before it do.
            rows = rows.repartition(self._graphs // GRAPHS_PER_TASK + 1)
            return (rows.observe(watch, F.count_if(self._is_open()).alias("open")) if watch else rows).checkpoint()
        return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)

    # What follows for a variant's rounds from the sums, as SQL over a graph's row.

    def _weight(self, variant: str, mass: str) -> str:
        """What every vertex gets in a round before which dangling vertices hold ``mass``."""
        jump = f"{1 - self._damping!r}D" if variant == STANDARD else "0D"
        return f"({jump} + {mass} * {float(self._damping)!r}D) / vertices"

    def _seed_weight(self) -> str:
        return f"{1 - self._damping!r}D / seeds"

    def _masses(self, variant: str, rounds: int) -> str:
        """Rank of dangling vertices before each of ``rounds`` rounds."""
        uniform, first = f"sum_{UNIFORM}", f"array(get(sum_{UNIFORM}, 0) / vertices)"
        if rounds < 2:
            return first
        moved_on = (
            f"aggregate(sequence(0, least(t, size({uniform})) - 1), 0D,"
            f" (total, k) -> total + {self._weight(variant, 'get(mass, t - 1 - k)')} * get({uniform}, k))"
        )
        if variant == PERSONALIZED:
            moved_on += f" + {self._seed_weight()} * aggregate(slice(sum_{SEEDED}, 1, t), 0D, (total, x) -> total + x)"
        after = f"{moved_on} + coalesce(get({uniform}, t), 0D) / vertices"
        return f"aggregate(sequence(1, {rounds - 1}), {first}, (mass, t) -> concat(mass, array({after})))"

    def _weights(self, variant: str, family: str, t: str, depth: int) -> str:
        """The weight of each wave in the ranks after round ``t``."""
        if family == SEEDED:
            case = f"CASE WHEN k < {t} THEN {self._seed_weight()} ELSE 0D END"
        else:
            started = self._weight(variant, f"get(mass_{variant}, {t} - 1 - k)")
            case = f"CASE WHEN k < {t} THEN {started} WHEN k = {t} THEN 1D / vertices ELSE 0D END"
        return f"transform(sequence(0, {depth}), k -> {case})"

    def _families(self, variant: str) -> list[str]:
        return [UNIFORM, SEEDED] if variant == PERSONALIZED else [UNIFORM]

    def measure(self, waves: _Waves, rounds: int) -> None:
        """Take the sums of new waves, and the changes of rounds up to ``rounds``.

        Two passes over the waves for all of these rounds and graphs: the changes
        need the masses, which need the sums.
        """
        began, before = time.perf_counter(), self.rounds
        fresh = range(self._known + 1, waves.depth + 1)
        if fresh:
            def total(f: str, k: int) -> str:
                wave = f"get({f}_waves, {k - 1})" if k else _start(f)
                return f"coalesce(sum(CASE WHEN out_degree = 0 THEN {wave} END), 0D)"

            sums = waves.state.groupBy(*self._keys).agg(*[
                F.expr(f"array({', '.join(total(f, k) for k in fresh)})").alias(f"new_{f}") for f in waves.families
            ])
            rows = self._merged(sums).withColumns({f"sum_{f}": F.concat(f"sum_{f}", f"new_{f}") for f in waves.families})
            self._rows = rows.drop(*[f"new_{f}" for f in waves.families], *[f"mass_{v}" for v in self._variants])
            self._known = waves.depth
        else:
            self._rows = self._rows.drop(*[f"mass_{v}" for v in self._variants])
        self._rows = self._written(self._rows.withColumns({f"mass_{v}": F.expr(self._masses(v, rounds)) for v in self._variants}))
        new = range(before + 1, rounds + 1)
        if new:
            self._take_changes(waves, new)
        self.rounds = rounds
        spent = (time.perf_counter() - began) / max(1, len(new))
        self.seconds += [spent + (waves.seconds[t - 1] if t <= len(waves.seconds) else 0.0) for t in new]

    def _take_changes(self, waves: _Waves, new: range) -> None:
        def steps(variant: str, family: str) -> str:
            after, then = (self._weights(variant, family, t, waves.depth) for t in ("t", "(t - 1)"))
            return f"flatten(transform(sequence({new.start}, {new.stop - 1}), t -> zip_with({after}, {then}, (a, b) -> a - b)))"

        def change(variant: str, i: int) -> str:
            parts = [_dot(f, f"_step_{variant}_{f}", waves.depth, i * (waves.depth + 1)) for f in self._families(variant)]
            return f"sum(abs({' + '.join(parts)}))"

        moves = self._joined(waves.state, {f"_step_{v}_{f}": steps(v, f) for v in self._variants for f in self._families(v)})
        sums = moves.groupBy(*self._keys).agg(*[
            F.expr(f"array({', '.join(change(v, i) for i in range(len(new)))})").alias(f"new_{v}") for v in self._variants
        ])
        rows, watch = self._merged(sums), Observation()
        for v in self._variants:
            small = f"filter(transform(new_{v}, (x, i) -> CASE WHEN x < {float(self._epsilon)!r}D THEN i + {new.start} END), t -> t IS NOT NULL)"
            rows = rows.withColumns({f"delta_{v}": F.concat(f"delta_{v}", f"new_{v}"), f"stop_{v}": F.expr(f"coalesce(stop_{v}, get({small}, 0))")})
        rows = rows.drop(*[f"new_{v}" for v in self._variants])
        self._rows = self._written(rows, watch)
        self.open = watch.get["open"] if self._keys else self._rows.filter(self._is_open()).count()
        self._closed = self.open < self._graphs

    def iterations(self) -> int:
        """The rounds of the graph and variant that took most of them."""
        last = F.greatest(*stops) if len(stops := [F.coalesce(f"stop_{v}", F.lit(self.rounds)) for v in self._variants]) > 1 else stops[0]
        return self._rows.agg(F.max(last)).first()[0] or 0

    def history(self, iterations: int) -> DataFrame:
        spent = F.expr(_literal(self.seconds[:iterations] or [0.0]))
        parts = []
        for v in self._variants:
            each = F.posexplode(F.expr(f"slice(delta_{v}, 1, coalesce(stop_{v}, {self.rounds}))")).alias("_at", "delta")
            parts.append(self._rows.select(*self._keys, "seeds", F.col(f"mass_{v}").alias("_mass"), each).select(
                *self._keys, F.lit(v).alias("variant"), (F.col("_at") + 1).alias("iteration"), "delta", F.get("_mass", "_at").alias("dangling_mass"),
                F.get(spent, "_at").alias("seconds"), F.lit(self._ready.partitions).alias("num_partitions"), F.col("seeds").alias("num_seeds"),
            ))
        return reduce(DataFrame.unionAll, parts)

    def ranks(self, waves: _Waves) -> DataFrame:
        stop = {v: f"coalesce(stop_{v}, {self.rounds})" for v in self._variants}
        ends = self._joined(waves.state, {
            f"_last_{v}_{f}": self._weights(v, f, stop[v], waves.depth) for v in self._variants for f in self._families(v)
        })
        return ends.selectExpr(*self._keys, "id", "out_degree", *[
            f"{' + '.join(_dot(f, f'_last_{v}_{f}', waves.depth) for f in self._families(v))} AS {v}" for v in self._variants
        ])


def _dot(family: str, weights: str, depth: int, first: int = 0) -> str:
    """A vertex's waves of a family by their weights, from the ``first`` on; wave 0 is not stored.

    Each product is spelled out: Spark compiles those, but interprets functions over arrays.
    """
    total = f"{_start(family)} * get({weights}, {first})"
    if depth:
        total += f" + ({' + '.join(f'coalesce(get({family}_waves, {k}), 0D) * get({weights}, {first + k + 1})' for k in range(depth))})"
    return f"({total})"


def _start(family: str) -> str:
    return "1D" if family == UNIFORM else "CASE WHEN is_seed THEN 1D ELSE 0D END"


def _literal(value: object) -> str:
    """SQL text of a number or of nested lists of numbers."""
    if isinstance(value, list):
        return f"array({', '.join(_literal(x) for x in value)})"
    return f"{value!r}D" if isinstance(value, float) else str(value)
