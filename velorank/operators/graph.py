"""Graph tables: vertices, degrees, and neighbour lists laid out once for everything that needs them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from velorank.session import (
    ADAPTIVE, BROADCAST_THRESHOLD, FILE_PARTITIONS, OBJECT_HASH, SHUFFLE_PARTITIONS, drop_folder, ensure_checkpoint_dir, scratch_folder, setting,
)

# Longest neighbour list kept in one row.  The edges of a source are numbered
# through in slices of this many, which are shuffled and stored apart.
SLICE_EDGES = 100_000
# At most this many vertices may exceed the slice length, see `slice_length`.
MAX_SLICED = 1_000_000
# Edges per partition of the stored lists: fewer than the first number are not
# worth a task of their own, more than the second outgrow one.
FEWEST_EDGES = 20_000
MOST_EDGES = 5_000_000
# Rows a task takes in where repeated edges are dropped or ids are counted: what it
# holds then has this bound in graphs of any size.
MOST_DISTINCT = 1_000_000


@dataclass(frozen=True)
class Graph:
    """Directed edges ``src, dst`` and, where they are not just the endpoints, vertices ``id``.

    ``keys`` names further columns that tell apart several graphs held together;
    no edge leads from one graph to another.
    """

    edges: DataFrame
    vertices: DataFrame | None = None
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class PreparedGraph:
    """A graph as it is stored, in the shared folder, for ranking and for its other tables.

    ``flags`` has every id seen anywhere with its degree and whether it is a vertex
    or a seed, hash-partitioned by id; ``lists`` has ``src, targets`` of the sources
    of at most ``length`` edges, hash-partitioned alike, so that the two meet without
    a shuffle; ``slices`` has ``src, slice, targets`` of the others, or is None.
    """

    keys: tuple[str, ...]
    flags: DataFrame
    lists: DataFrame
    slices: DataFrame | None
    length: int
    partitions: int
    totals: dict
    listed: bool

    @property
    def vertices(self) -> DataFrame:
        return self.flags.filter("is_vertex").select(*self.keys, "id", "out_degree")


def vertex_flags(graph: Graph, seeds: DataFrame | None = None) -> DataFrame:
    """Every id seen anywhere, with its out-degree and whether it is a vertex or a seed.

    Degrees, membership and seeds come from one pass over the edges and one shuffle
    of pre-aggregated ids.  Out-degree counts repeated neighbours and neighbours that
    are no vertex.
    """
    keys = list(graph.keys)
    listed = graph.vertices is not None

    def marked(ids: DataFrame, degree: Column, vertex: bool, seed: bool) -> DataFrame:
        return ids.select(
            *keys, "id", degree.cast("bigint").alias("out_degree"), F.lit(vertex).alias("is_vertex"), F.lit(seed).alias("is_seed")
        )

    if listed:
        seen = marked(graph.edges.select(*keys, F.col("src").alias("id")), F.lit(1), False, False)
        seen = seen.unionAll(marked(graph.vertices, F.lit(0), True, False))
    else:
        ends = graph.edges.select(*keys, F.posexplode(F.array("src", "dst")).alias("_end", "id"))
        seen = marked(ends, 1 - F.col("_end"), True, False)
    if seeds is not None:
        seen = seen.unionAll(marked(seeds, F.lit(0), False, True))
    return seen.groupBy("id", *keys).agg(
        F.sum("out_degree").alias("out_degree"),
        F.bool_or("is_vertex").alias("is_vertex"),
        F.bool_or("is_seed").alias("is_seed"),
    )


def vertex_degrees(graph: Graph) -> DataFrame:
    """All vertices with their out-degree, zero included."""
    return vertex_flags(graph).filter("is_vertex").select(*graph.keys, "id", "out_degree")


def dangling_vertices(graph: Graph) -> DataFrame:
    """Vertices without outgoing edges."""
    return vertex_degrees(graph).filter("out_degree = 0").select(*graph.keys, "id")


def slice_length(num_edges: int, num_busy: int, length: int = SLICE_EDGES) -> int:
    """Neighbours per slice of the rank loop, long enough that few vertices need several.

    ``num_busy`` vertices have more than ``length`` edges.  If those are too
    many, slices get so long that fewer than ``MAX_SLICED`` vertices exceed
    them: each takes more than that part of all ``num_edges``.
    """
    return length if num_busy <= MAX_SLICED else max(length, -(-num_edges // MAX_SLICED))


def slice_count(out_degree: Column, length: int) -> Column:
    return F.ceil(out_degree / F.lit(length)).cast("int")


def default_partitions(spark: SparkSession, num_edges: int, most: int = MOST_EDGES) -> int:
    """Two per core, more for graphs too large for that, fewer for tiny ones."""
    usual = max(2 * spark.sparkContext.defaultParallelism, 8)
    return max(min(usual, -(-num_edges // FEWEST_EDGES)), -(-num_edges // most), 1)


def distinct_edges(edges: DataFrame, num_rows: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Edges without repeats, in as many partitions as their ``num_rows`` rows ask for.

    Adaptive execution would merge partitions by their bytes as shuffled, of which the
    tables that the tasks hold are a large multiple.
    """
    place = [*keys, "src", "dst"]
    partitions = default_partitions(edges.sparkSession, num_rows, MOST_DISTINCT)
    return edges.repartition(partitions, *place).dropDuplicates(place)


def prepare_graph(
    graph: Graph, seeds: DataFrame | None = None, num_partitions: int | None = None, slice_edges: int = SLICE_EDGES
) -> PreparedGraph:
    """Read the graph's sources once and lay out what its other tables are made of.

    The edges are written as Parquet files, counted on the way, and dropped again when
    the degrees and the lists are.  Ids come before the graph's keys in all layouts: rows
    are sorted by their first column, and few graphs would leave it to the second.  Layouts are kept by planning without adaptive execution:
    the sizes are known.  Sources of more than ``length`` edges are broadcast;
    `slice_length` bounds their number.
    """
    spark = graph.edges.sparkSession
    ensure_checkpoint_dir(spark)
    keys = list(graph.keys)
    watch = Observation()
    given, folder = graph.edges.select(*keys, "src", "dst"), scratch_folder(spark, "edges")
    given.observe(watch, F.count(F.lit(1)).alias("edges")).write.parquet(folder)
    edges = spark.read.schema(given.schema).parquet(folder)
    num_edges = watch.get["edges"]
    partitions = num_partitions or default_partitions(spark, num_edges)
    pieces = default_partitions(spark, num_edges, MOST_DISTINCT)
    with fixed_layout(spark, partitions), setting(spark, FILE_PARTITIONS, pieces):
        seen = Observation()
        flags = vertex_flags(Graph(edges, graph.vertices, graph.keys), seeds)
        flags = flags.observe(seen, *_totals(slice_edges)).checkpoint()
        totals = seen.get
        length = slice_length(num_edges, totals["busy"], slice_edges)
        slices, plain = None, edges
        if totals["busy"]:
            busy = flags.filter(F.col("out_degree") > length).select(
                *keys, F.col("id").alias("src"), slice_count(F.col("out_degree"), length).alias("_slices")
            )
            parted = edges.join(F.broadcast(busy), [*keys, "src"], "left")
            place = F.pmod(F.xxhash64("dst"), F.col("_slices")).cast("int")
            slices = _listed(parted.filter("_slices IS NOT NULL").withColumn("slice", place), ["src", *keys, "slice"], partitions)
            plain = parted.filter("_slices IS NULL")
        lists = _listed(plain, ["src", *keys], partitions)
    drop_folder(spark, folder)
    return PreparedGraph(graph.keys, flags, lists, slices, length, partitions, totals, graph.vertices is not None)


def _totals(slice_edges: int) -> list[Column]:
    vertex = F.col("is_vertex")
    return [
        F.count_if(vertex).alias("vertices"),
        F.count_if(F.col("is_seed")).alias("seeds"),
        F.count_if(vertex & (F.col("out_degree") == 0)).alias("dangling"),
        F.count_if(F.col("out_degree") > slice_edges).alias("busy"),
    ]


def _listed(edges: DataFrame, place: list[str], partitions: int) -> DataFrame:
    """Rows of ``place`` and its targets.  They end up sorted, so they are gathered in one sort, not by hash and then sorted."""
    with setting(edges.sparkSession, OBJECT_HASH, "false"):
        return (
            edges.repartition(partitions, *place)
            .groupBy(*place)
            .agg(F.collect_list("dst").alias("targets"))
            .sortWithinPartitions(*place)
            .checkpoint()
        )


class fixed_layout:
    """While frames are planned: ``partitions`` shuffle partitions, and joins that keep the layout they find."""

    def __init__(self, spark: SparkSession, partitions: int) -> None:
        values = ((SHUFFLE_PARTITIONS, partitions), (ADAPTIVE, "false"), (BROADCAST_THRESHOLD, "-1"))
        self._settings = [setting(spark, name, value) for name, value in values]

    def __enter__(self) -> None:
        for one in self._settings:
            one.__enter__()

    def __exit__(self, *error: object) -> None:
        for one in reversed(self._settings):
            one.__exit__(None, None, None)


def adjacency(graph: Graph | PreparedGraph, length: int = SLICE_EDGES) -> DataFrame:
    """Rows ``node_id, slice, out_neighbors``; isolated vertices have one empty row.

    A vertex's ascending neighbours are numbered through and ``slice`` is the number
    divided by ``length``: a vertex of up to ``length`` edges has slice 0 only, and
    the rows of any graph follow from its edges and ``length`` alone.
    """
    ready = graph if isinstance(graph, PreparedGraph) else prepare_graph(graph, slice_edges=length)
    keys = list(ready.keys)
    rows = ready.lists.select(*keys, "src", F.sort_array("targets").alias("targets"))
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size("targets") / length), F.lit(1)).cast("int") - 1),
        lambda i: F.struct(i.alias("slice"), F.slice("targets", i * length + 1, length).alias("out_neighbors")),
    )
    cells = rows.select(*keys, F.col("src").alias("id"), F.inline(cut))
    if ready.slices is not None:
        cells = cells.unionAll(_numbered_through(ready.slices, keys, length))
    empty = ready.vertices.filter("out_degree = 0").select(
        *keys, "id", F.lit(0).alias("slice"), F.array().cast("array<bigint>").alias("out_neighbors")
    )
    if ready.listed:  # sources that are no vertex have no row
        cells = cells.join(ready.vertices.select(*keys, "id"), [*keys, "id"], "left_semi")
    return cells.unionAll(empty).select(*keys, F.col("id").alias("node_id"), "slice", "out_neighbors")


def _numbered_through(slices: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Ascending slices of the sources of very many edges.

    The edges are sorted by range partitions and numbered by their place in their
    partition, so no task holds a source.
    """
    spark = slices.sparkSession
    part = F.monotonically_increasing_id()
    ordered = (
        slices.select(*keys, "src", F.explode("targets").alias("dst"))
        .repartitionByRange(int(spark.conf.get(SHUFFLE_PARTITIONS)), *keys, "src", "dst")
        .sortWithinPartitions(*keys, "src", "dst")
        .select(*keys, "src", "dst", F.spark_partition_id().alias("_part"), part.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
        .checkpoint()
    )
    counts = ordered.groupBy(*keys, "src", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys, "src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "src", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_row") - F.col("_first")
    numbered = ordered.join(offsets, [*keys, "src", "_part"]).withColumn("slice", F.floor(number / length).cast("int"))
    return numbered.groupBy(*keys, F.col("src").alias("id"), "slice").agg(F.sort_array(F.collect_list("dst")).alias("out_neighbors"))


def contributions(graph: Graph | PreparedGraph, ranks: DataFrame, length: int = SLICE_EDGES) -> DataFrame:
    """What each target receives: the sum of rank over out-degree of its sources.

    ``ranks`` has ``id, rank``.  Ranks meet the stored lists, a list at a time, so a
    source of very many edges is spread over tasks.
    """
    ready = graph if isinstance(graph, PreparedGraph) else prepare_graph(graph, slice_edges=length)
    keys = list(ready.keys)
    gives = ready.vertices.filter("out_degree > 0").join(ranks, ["id", *keys]).selectExpr(
        *keys, "id", "out_degree", "rank / out_degree AS _give"
    )
    received = moved(ready, gives, ["_give"]).groupBy("id", *keys).agg(F.sum("_give").alias("contribution"))
    return received.select(*keys, "id", "contribution")


def moved(ready: PreparedGraph, gives: DataFrame, names: list[str]) -> DataFrame:
    """``id`` and what it is given, for every edge; ``gives`` has ``id, out_degree`` and the named columns."""
    keys = list(ready.keys)

    def sent(lists: DataFrame, per_list: DataFrame, place: list[str]) -> DataFrame:
        return lists.join(per_list, place).select(*keys, F.explode("targets").alias("id"), *names)

    plain = gives.filter(F.col("out_degree") <= ready.length) if ready.slices is not None else gives
    out = sent(ready.lists, plain.select(*keys, F.col("id").alias("src"), *names), ["src", *keys])
    if ready.slices is not None:
        numbers = F.sequence(F.lit(0), slice_count(F.col("out_degree"), ready.length) - 1)
        busy = gives.filter(F.col("out_degree") > ready.length)
        per_slice = busy.select(*keys, F.col("id").alias("src"), F.explode(numbers).alias("slice"), *names)
        out = out.unionAll(sent(ready.slices, per_slice, ["src", *keys, "slice"]))
    return out
