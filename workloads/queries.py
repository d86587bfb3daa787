"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.operators import trip_reports as reports
from velorank.operators import weather as impact
from velorank.operators.comparison import Comparison, compare_rankings
from velorank.operators.dictionary import by_number, decode_ids, encode_graph
from velorank.operators.graph import PreparedGraph, adjacency, contributions, dangling_vertices, prepare_graph, vertex_degrees
from velorank.operators.ranking import (
    PERSONALIZED, STANDARD, Ranking, pagerank, personalized_pagerank, rank_variants, top_ranks,
)
from velorank.operators.trips import clean_trips, reject_counts
from velorank.operators.validation import validate_ranks
from velorank.session import scratch_folder
from velorank.sinks.files import read_ranks, write_ranks, write_report_file
from velorank.sources.graphs import (
    parse_adjacency_lines, parse_edge_lines, parse_named_edge_lines, parse_seed_lines, read_adjacency, sample_vertices,
)
from velorank.sources.tables import parse_trip_lines, parse_weather_lines, read_trip_files
from velorank.operators.weather import HOURS_IN_MONTH
from workloads import inputs

Query = Callable[[SparkSession, str], DataFrame]

# Ranks are compared as multiples of the mean rank, to this many digits: the order of adding doubles is not fixed.
DIGITS = 8
TOP = 20
RUNS = 10
# The default threshold of the rank loop.
EPSILON = 1e-3
FIRST_SEED = 42
ROUTE_MIN_RIDES = 20


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the type the tables have."""
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
          for f in df.schema]
    )


def trip_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(clean_trips(inputs.raw_trips(spark, folder)))


def trip_reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reject_counts(inputs.raw_trips(spark, folder))


def trip_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.trips(spark, folder).select(
        "ride_id", "duration_minutes", "hour_in_day", "day_of_week", "weekend_indicator", "round_trip", "ride_type"
    )


def rides_by_hour_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rides_by_hour_and_type(inputs.trips(spark, folder))


def _stations(order_by: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return reports.top_stations(inputs.trips(spark, folder), 10, order_by=order_by)

    return query


def common_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Routes of at least 20 rides: the default of 100 leaves none on tables below sf0.1 to compare."""
    return reports.common_routes(inputs.trips(spark, folder), 10, ROUTE_MIN_RIDES)


def round_trip_overall(spark: SparkSession, folder: str) -> DataFrame:
    return reports.round_trips_overall(inputs.trips(spark, folder))


def round_trip_by_member(spark: SparkSession, folder: str) -> DataFrame:
    return reports.round_trips_by_rider(inputs.trips(spark, folder))


def weather_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(inputs.weather(spark, folder))


def trip_weather_join(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(
        inputs.trips_with_weather(spark, folder).select(
            "ride_id", "hour_timestamp", "rain_indicator", "temp", "temp_band", "is_rainy"
        )
    )


def rain_impact_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    return impact.rain_impact_by_hour(inputs.trips_with_weather(spark, folder))


def rain_impact_by_member(spark: SparkSession, folder: str) -> DataFrame:
    return impact.rain_impact_by_rider(inputs.trips_with_weather(spark, folder))


def temperature_impact(spark: SparkSession, folder: str) -> DataFrame:
    return impact.temperature_impact(inputs.trips_with_weather(spark, folder))


def weather_join_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded, clean and joined trips."""
    return impact.join_counts(inputs.raw_trips(spark, folder), inputs.weather(spark, folder), HOURS_IN_MONTH)


def trip_text_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Clean trips parsed from delimited text, with the rows a malformed time or an empty field loses."""
    return _plain_times(clean_trips(parse_trip_lines(inputs.trip_lines(spark, folder))).drop("start_lat", "start_lng", "end_lat", "end_lng"))


def weather_text_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Weather prepared from delimited text."""
    rows = impact.prepare_weather(parse_weather_lines(inputs.weather_lines(spark, folder)), inputs.YEAR, inputs.MONTH)
    return _plain_times(rows.select("hour_timestamp", "temp", "coco", "rain_indicator", "temp_band"))


def trip_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Clean trips from files of two layouts, written and read back by the names in their headers."""
    path = scratch_folder(spark, "trips")
    inputs.written_trips(spark, folder, path)
    rows = clean_trips(read_trip_files(spark, f"{path}/*/part-*.csv"))
    return _plain_times(rows.drop("start_lng", "end_lat", "end_lng"))


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of reports that were written as single files of their names and read back."""
    path = scratch_folder(spark, "reports")
    rides = inputs.trips(spark, folder)
    written = {
        "1_rides_by_hour_type": reports.rides_by_hour_and_type(rides),
        "4a_roundtrip_overall": reports.round_trips_overall(rides),
        "4b_roundtrip_by_member": reports.round_trips_by_rider(rides),
    }
    parts = []
    for name, report in written.items():
        write_report_file(report, f"{path}/{name}.csv")
        back = spark.read.option("header", True).csv(f"{path}/{name}.csv")
        parts.append(back.select(F.lit(name).alias("report"), F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in back.columns]).alias("line")))
    return reduce(DataFrame.unionAll, parts)


def edge_list_scan(spark: SparkSession, folder: str) -> DataFrame:
    return parse_edge_lines(inputs.edge_lines(spark, folder))


def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.links(spark, folder).edges


def graph_vertices(spark: SparkSession, folder: str) -> DataFrame:
    return vertex_degrees(inputs.links(spark, folder))


def graph_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    rows = adjacency(inputs.links(spark, folder))
    return rows.select("node_id", "slice", F.array_join(F.col("out_neighbors").cast("array<string>"), ",").alias("out_neighbors"))


def adjacency_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Degrees of a graph read from JSON text."""
    return vertex_degrees(parse_adjacency_lines(inputs.adjacency_lines(spark, folder)))


def document_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Degrees of a graph read from a single JSON document."""
    path = scratch_folder(spark, "document")
    inputs.written_document(spark, folder, path)
    return vertex_degrees(read_adjacency(spark, f"{path}/part-*", document=True))


def wide_id_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges between ids beyond 64 bits, with the dense ids they get and the names those stand for."""
    graph, names = encode_graph(parse_named_edge_lines(inputs.wide_edge_lines(spark, folder)), by_number)
    both = graph.edges.selectExpr("src AS src_id", "dst AS dst_id", "src", "dst")
    return decode_ids(both, names, ["src", "dst"])


def rank_files(spark: SparkSession, folder: str) -> DataFrame:
    """Degrees as ranks, written in the order of ids and read back with each line's place over all files."""
    path = scratch_folder(spark, "ranks")
    write_ranks(vertex_degrees(inputs.links(spark, folder)).selectExpr("id", "cast(out_degree AS DOUBLE) AS rank"), path)
    return read_ranks(spark, path)


def seed_scan(spark: SparkSession, folder: str) -> DataFrame:
    return parse_seed_lines(inputs.seed_lines(spark, folder))


def dangling_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return dangling_vertices(inputs.links(spark, folder))


def pagerank_contributions(spark: SparkSession, folder: str) -> DataFrame:
    """What each vertex receives while all ranks are one."""
    graph = prepare_graph(inputs.links(spark, folder))
    ones = graph.vertices.select("id", F.lit(1.0).alias("rank"))
    return contributions(graph, ones).select("id", F.round("contribution", DIGITS).alias("contribution"))


def _standard(spark: SparkSession, folder: str) -> Ranking:
    return pagerank(inputs.links(spark, folder))


def _personalized(spark: SparkSession, folder: str) -> Ranking:
    return personalized_pagerank(inputs.links(spark, folder), inputs.link_seeds(spark, folder))


def _in_means(ranks: DataFrame, num_vertices: int) -> DataFrame:
    """Ranks as multiples of the mean over every vertex; they don't shrink as the graph grows."""
    return ranks.select("id", "out_degree", F.round(F.col("rank") * num_vertices, DIGITS).alias("rank_in_means"))


def pagerank_ranks(spark: SparkSession, folder: str) -> DataFrame:
    found = _standard(spark, folder)
    return _in_means(found.ranks, found.num_vertices)


def pagerank_topk(spark: SparkSession, folder: str) -> DataFrame:
    found = _standard(spark, folder)
    return _in_means(top_ranks(found.ranks, TOP), found.num_vertices)


def ppr_ranks(spark: SparkSession, folder: str) -> DataFrame:
    found = _personalized(spark, folder)
    return _in_means(found.ranks, found.num_vertices)


def ppr_topk(spark: SparkSession, folder: str) -> DataFrame:
    found = _personalized(spark, folder)
    return _in_means(top_ranks(found.ranks, TOP), found.num_vertices)


def _steps(convergence: DataFrame, *keys: str) -> DataFrame:
    return convergence.select(
        *keys, "variant", "iteration", F.round("delta", DIGITS).alias("delta"), F.round("dangling_mass", DIGITS).alias("dangling_mass"), "num_seeds"
    )


def pagerank_convergence(spark: SparkSession, folder: str) -> DataFrame:
    """The rounds until the L1 change is below the threshold, or the last allowed one."""
    return _steps(_standard(spark, folder).convergence())


def keyed_convergence(spark: SparkSession, folder: str) -> DataFrame:
    """The same for ten graphs and both kinds of rank, which stop each for itself."""
    graphs, seeds = inputs.runs(spark, folder, RUNS), inputs.run_seeds(spark, folder, RUNS)
    return _steps(rank_variants(graphs, [STANDARD, PERSONALIZED], seeds, 20, EPSILON, 0.85).convergence(), "run")


def _checked(graph: PreparedGraph, ranks: DataFrame) -> DataFrame:
    checked = validate_ranks(graph, ranks, 1e-6)
    return checked.withColumns({name: F.round(name, DIGITS) for name in ("rank_sum", "min_dangling_rank")})


def rank_validation(spark: SparkSession, folder: str) -> DataFrame:
    graph = prepare_graph(inputs.links(spark, folder))
    return _checked(graph, pagerank(graph).ranks)


def spoiled_validation(spark: SparkSession, folder: str) -> DataFrame:
    """What validation says of ranks spoiled in one way each."""
    graph = prepare_graph(inputs.links(spark, folder))
    total = graph.vertices.count()
    even = graph.vertices.withColumn("rank", F.lit(1.0 / total))
    dangling, smallest = F.col("out_degree") == 0, F.col("id") == even.agg(F.min("id")).first()[0]
    spoiled = {
        "even": even,
        "negative": even.withColumn("rank", F.when(smallest, -F.col("rank")).otherwise(F.col("rank"))),
        "doubled": even.withColumn("rank", F.col("rank") * 2),
        "missing": _renormalised(even.filter(~dangling)),
        "zero_dangling": _renormalised(even.withColumn("rank", F.when(dangling, 0.0).otherwise(F.col("rank")))),
        # As many ranks as vertices, but those of dangling ones are given to ids that are none.
        "strangers": even.withColumn("id", F.when(dangling, -1 - F.col("id")).otherwise(F.col("id"))),
    }
    rows = [_checked(graph, ranks).withColumn("case", F.lit(name)) for name, ranks in spoiled.items()]
    return reduce(DataFrame.unionAll, rows)


def _renormalised(ranks: DataFrame) -> DataFrame:
    return ranks.withColumn("rank", F.col("rank") / F.lit(ranks.agg(F.sum("rank")).first()[0]))


def seed_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample_vertices(vertex_degrees(inputs.links(spark, folder)), TOP, FIRST_SEED)


def _compared(spark: SparkSession, folder: str) -> Comparison:
    """Standard against personalized top ranks on ten graphs, each with the orders of one remainder."""
    return compare_rankings(inputs.runs(spark, folder, RUNS), inputs.run_seeds(spark, folder, RUNS), TOP)


def topk_overlap(spark: SparkSession, folder: str) -> DataFrame:
    def text(name: str) -> F.Column:
        return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)

    return _compared(spark, folder).per_run.select(
        "run", text("seeds"), text("topK_standard"), text("topK_personalized"), "overlap_count", "overlap_ratio"
    )


def topk_average_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).summary.select(F.round("average_overlap_ratio", DIGITS).alias("average_overlap_ratio"))


QUERIES: dict[str, Query] = {
    "trip_clean": trip_clean,
    "trip_reject_counts": trip_reject_counts,
    "trip_enrich": trip_enrich,
    "rides_by_hour_type": rides_by_hour_type,
    "station_member_ratio": _stations("member_ratio"),
    "station_roundtrip_ratio": _stations("round_trip_ratio"),
    "station_total_rides": _stations("total_rides"),
    "common_routes": common_routes,
    "round_trip_overall": round_trip_overall,
    "round_trip_by_member": round_trip_by_member,
    "weather_enrich": weather_enrich,
    "trip_weather_join": trip_weather_join,
    "rain_impact_by_hour": rain_impact_by_hour,
    "rain_impact_by_member": rain_impact_by_member,
    "temperature_impact": temperature_impact,
    "weather_join_counts": weather_join_counts,
    "trip_text_scan": trip_text_scan,
    "weather_text_scan": weather_text_scan,
    "trip_file_scan": trip_file_scan,
    "report_files": report_files,
    "edge_list_scan": edge_list_scan,
    "document_scan": document_scan,
    "wide_id_edges": wide_id_edges,
    "rank_files": rank_files,
    "adjacency_scan": adjacency_scan,
    "seed_scan": seed_scan,
    "graph_edges": graph_edges,
    "graph_vertices": graph_vertices,
    "graph_adjacency": graph_adjacency,
    "dangling_nodes": dangling_nodes,
    "pagerank_contributions": pagerank_contributions,
    "pagerank_ranks": pagerank_ranks,
    "pagerank_topk": pagerank_topk,
    "ppr_ranks": ppr_ranks,
    "ppr_topk": ppr_topk,
    "pagerank_convergence": pagerank_convergence,
    "keyed_convergence": keyed_convergence,
    "rank_validation": rank_validation,
    "spoiled_validation": spoiled_validation,
    "seed_sample": seed_sample,
    "topk_overlap": topk_overlap,
    "topk_average_overlap": topk_average_overlap,
}
