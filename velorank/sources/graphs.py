"""Graph sources: edge lists, adjacency files, seed lists and random graphs."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorank.functions.columns import md5_number
from velorank.operators.graph import Graph
from velorank.operators.selection import position_cutoffs, top_k
from velorank.session import ensure_checkpoint_dir

NODE_TYPE = T.StructType([
    T.StructField("node_id", T.LongType()),
    T.StructField("out_neighbors", T.ArrayType(T.LongType())),
])

# Characters stripped from both ends of a line or field.
BLANKS = " \t\r\n\f\v"


def read_edge_list(spark: SparkSession, path: str, delimiter: str | None = None) -> Graph:
    """Graph in text files of ``source target`` lines.

    Fields are split on any run of blanks, or on exactly ``delimiter``.
    """
    return Graph(parse_edge_lines(spark.read.text(path), delimiter))


def parse_edge_lines(lines: DataFrame, delimiter: str | None = None) -> DataFrame:
    """Distinct ``(src, dst)`` pairs of the ``value`` column.

    Blank lines, ``#`` comments, lines without two integers and self-loops are
    left out; fields after the second are ignored.
    """
    separator = r"\s+" if delimiter is None else _literal_pattern(delimiter)
    fields = (
        lines.select(F.btrim(F.col("value"), F.lit(BLANKS)).alias("line"))
        .filter(~F.col("line").startswith("#"))
        .select(F.split("line", separator, 3).alias("fields"))
    )
    # Generated columns keep Spark from parsing once for the filter and once more
    # for the result.
    pair = F.struct(_integer(0).alias("src"), _integer(1).alias("dst"))
    return fields.select(F.inline(F.array(pair))).filter("src <> dst").dropDuplicates(["src", "dst"])


def parse_named_edge_lines(lines: DataFrame, delimiter: str | None = None) -> DataFrame:
    """Distinct pairs of integers of any size, as text in normal form, under the rules of :func:`parse_edge_lines`."""
    separator = r"\s+" if delimiter is None else _literal_pattern(delimiter)
    fields = (
        lines.select(F.btrim(F.col("value"), F.lit(BLANKS)).alias("line"))
        .filter(~F.col("line").startswith("#"))
        .select(F.split("line", separator, 3).alias("fields"))
    )
    pair = F.struct(_whole_number(0).alias("src"), _whole_number(1).alias("dst"))
    return fields.select(F.inline(F.array(pair))).filter("src <> dst").dropDuplicates(["src", "dst"])


def _whole_number(place: int) -> Column:
    """Field ``place`` as an integer's shortest text, NULL for other text."""
    text = F.btrim(F.get("fields", F.lit(place)), F.lit(BLANKS))
    digits = F.regexp_extract(text, r"^[+-]?0*([0-9]+)$", 1)
    sign = F.when(text.startswith("-") & (digits != "0"), F.lit("-")).otherwise(F.lit(""))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), F.concat(sign, digits))


def _integer(place: int) -> Column:
    """Field ``place`` as a bigint, NULL for other text.

    The pattern weeds such text out first: a failing cast costs an exception.
    """
    text = F.btrim(F.get("fields", F.lit(place)), F.lit(BLANKS))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def _literal_pattern(text: str) -> str:
    return r"\Q" + text + r"\E"


def read_adjacency(spark: SparkSession, path: str, document: bool = False) -> Graph:
    """Graph in JSON adjacency form.

    By default one node object per line; a node may span several.  ``document=True``
    reads files holding a single ``{"nodes": [...]}`` object, see
    :func:`parse_document_pieces`; Spark splits both forms over tasks.  Text that is
    no such JSON, and nodes without an id, are errors when the graph is used.
    Repeated neighbours and neighbours that are no node themselves are kept.
    """
    if document:
        return parse_document_pieces(spark.read.option("lineSep", "}").text(path))
    return graph_from_adjacency(spark.read.schema(NODE_TYPE).option("mode", "FAILFAST").json(path))


# What may stand before, between and after the nodes of a document.
_HEAD = r'^\s*\{\s*"nodes"\s*:\s*\[\s*'
_NODE = _HEAD + r"\{([^{]*)$" + r"|^\s*,\s*\{([^{]*)$"
_REST = _HEAD + r"\]\s*$" + r"|^\s*\]\s*$|^\s*$"


def parse_document_pieces(pieces: DataFrame) -> Graph:
    """Graph of single-object documents cut at every closing brace, one piece per row of ``value``.

    A node holds a number and a list of numbers, so its own closing brace is the
    first one after its start: wherever a file is cut into byte ranges, the text up
    to the next brace is a whole node.  Pieces of any other form, such as nested
    objects or braces within text, are errors.
    """
    text = F.col("value")
    body = F.coalesce(F.nullif(F.regexp_extract(text, _NODE, 1), F.lit("")), F.regexp_extract(text, _NODE, 2))
    other = F.when(text.rlike(_REST), F.lit(None).cast("string")).otherwise(F.raise_error(F.lit("not a document of nodes")).cast("string"))
    node = F.when(text.rlike(_NODE), F.concat(F.lit("{"), body, F.lit("}"))).otherwise(other)
    nodes = pieces.select(node.alias("node")).filter("node IS NOT NULL")
    return graph_from_adjacency(nodes.select(F.inline(F.array(F.from_json("node", NODE_TYPE, {"mode": "FAILFAST"})))))


def parse_adjacency_lines(lines: DataFrame) -> Graph:
    """Graph of JSON node objects in the ``value`` column, under the rules of :func:`read_adjacency`."""
    node = F.from_json("value", NODE_TYPE, {"mode": "FAILFAST"})
    return graph_from_adjacency(lines.filter(F.btrim("value", F.lit(BLANKS)) != "").select(F.inline(F.array(node))))


def graph_from_adjacency(nodes: DataFrame) -> Graph:
    """Graph of ``(node_id, out_neighbors)`` rows; a node may span several rows, and one without id is an error."""
    known = F.coalesce("node_id", F.raise_error(F.lit("a node has no node_id")).cast("bigint"))
    return Graph(
        edges=nodes.select(known.alias("src"), F.explode("out_neighbors").alias("dst")),
        vertices=nodes.select(known.alias("id")).distinct(),
    )


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Distinct seed ids, one per non-blank line; other text is an error."""
    return parse_seed_lines(spark.read.text(path))


def parse_seed_lines(lines: DataFrame) -> DataFrame:
    """Distinct ids of the ``value`` column, under the rules of :func:`read_seeds`."""
    text = F.btrim(F.col("value"), F.lit(BLANKS))
    return lines.select(text.alias("line")).filter("line <> ''").select(F.col("line").cast("bigint").alias("id")).distinct()


def seed_frame(spark: SparkSession, seeds: str | Iterable[int]) -> DataFrame:
    """Distinct seed ids given inline, as integers or as ``"1,5,10"``."""
    if isinstance(seeds, str):
        seeds = [int(part) for part in seeds.split(",") if part.strip()]
    return spark.createDataFrame([(seed,) for seed in sorted(set(seeds))], "id bigint")


def random_graph(spark: SparkSession, num_nodes: int, num_edges: int, seed: int = 42) -> Graph:
    """Seeded random graph on ids ``0 .. num_nodes - 1``."""
    many = random_graphs(spark, num_nodes, num_edges, [seed])
    return Graph(many.edges.drop("run"), many.vertices.drop("run"))


def random_graphs(spark: SparkSession, num_nodes: int, num_edges: int, seeds: list[int]) -> Graph:
    """One random simple directed graph per seed, told apart by ``run``.

    Attempt ``a`` of a graph draws a uniform pair from the MD5 of ``seed:a``, so
    any task can draw any attempt.  Self-loops and repeats are passed over; the
    first ``num_edges`` new pairs are kept, out of at most ten times as many
    attempts.  Vertices without edges belong to the graph.
    """
    if num_nodes <= 0:
        raise ValueError("empty graph")
    ensure_checkpoint_dir(spark)
    limit = max(10 * num_edges, 1)
    attempts = min(limit, _attempts_needed(num_nodes, num_edges))
    while True:
        drawn = _draw_pairs(spark, num_nodes, attempts, seeds).checkpoint()
        counts = {row["run"]: row["n"] for row in drawn.groupBy("run").agg(F.count("*").alias("n")).collect()}
        fewest = min(counts.get(run, 0) for run in range(len(seeds)))
        if fewest >= num_edges or attempts >= limit:
            break
        attempts = min(limit, 2 * attempts)
    last = position_cutoffs(drawn, ["run"], "attempt", num_edges, attempts)
    # One row per run, so the broadcast size is the number of seeds given.
    edges = drawn.join(F.broadcast(last), "run").filter("attempt <= cutoff").select("run", "src", "dst")
    vertices = spark.range(num_nodes * len(seeds)).select(
        F.expr(f"cast(id div {num_nodes} as int)").alias("run"), F.expr(f"id % {num_nodes}").alias("id")
    )
    return Graph(edges, vertices, ("run",))


def _draw_pairs(spark: SparkSession, num_nodes: int, attempts: int, seeds: list[int]) -> DataFrame:
    seed = F.element_at(F.array(*[F.lit(int(s)) for s in seeds]), F.col("run") + 1)
    text = F.concat_ws(":", seed.cast("string"), F.col("attempt").cast("string"))
    return (
        spark.range(attempts * len(seeds))
        .select(
            F.expr(f"cast(id div {attempts} as int)").alias("run"),
            F.expr(f"id % {attempts}").alias("attempt"),
        )
        .select(
            "run",
            "attempt",
            (md5_number(text, 1) % num_nodes).alias("src"),
            (md5_number(text, 16) % num_nodes).alias("dst"),
        )
        .filter("src <> dst")
        .groupBy("run", "src", "dst")
        .agg(F.min("attempt").alias("attempt"))
    )


def _attempts_needed(num_nodes: int, num_edges: int) -> int:
    """Attempts that very likely give ``num_edges`` distinct pairs."""
    pairs = num_nodes * (num_nodes - 1)
    if num_edges >= pairs:
        return 10 * max(num_edges, 1)
    expected = -(num_nodes**2) * math.log1p(-num_edges / pairs)
    return int(expected + 6 * math.sqrt(expected) + 100)


def sample_vertices(vertices: DataFrame, k: int, seed: int | list[int] = 42, keys: tuple[str, ...] = ()) -> DataFrame:
    """``k`` distinct vertices (all, if fewer) by the order of a seeded MD5.

    With ``keys=("run",)``, ``k`` per run, ``seed`` listing one seed per run.
    """
    if isinstance(seed, int):
        salt = F.lit(seed)
    else:
        salt = F.element_at(F.array(*[F.lit(int(s)) for s in seed]), F.col(keys[0]) + 1)
    text = F.concat_ws(":", F.lit("seed"), salt.cast("string"), F.col("id").cast("string"))
    drawn = vertices.select(*keys, "id", F.md5(text).alias("draw"))
    return top_k(drawn, list(keys), [F.col("draw").asc(), F.col("id").asc()], k).drop("draw")
