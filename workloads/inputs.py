"""Trips, hourly weather and a link graph derived from the given tables.

Every input covers all rows of its tables.  Trips are derived row by row and
need no shuffle; weather is one pre-aggregated row per hour; the edges of the
graph are a projection of the order and line tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.operators.graph import Graph, distinct_edges
from velorank.operators.trips import clean_trips, enrich_trips
from velorank.operators.weather import HOURS_IN_MONTH, join_weather, month_span, prepare_weather
from velorank.session import use_utc

YEAR, MONTH = 2024, 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """A ride per event: it starts at the event's time and lasts ``value`` squared seconds.

    The station is the number in ``props``.  A view comes back to where it
    started, after an error the end station is unknown.  At some event numbers the
    id, a time or the station is missing, at some the ride ends within its second.
    """
    events = table(spark, folder, "events")
    stand = F.regexp_extract("props", '"k": *([0-9]+)', 1)
    number = F.col("event_id")
    rows = events.select(
        F.when(number % 101 != 1, number.cast("string")).alias("ride_id"),
        F.col("event_type").alias("rideable_type"),
        F.when(number % 103 != 2, F.col("ts").cast("timestamp")).alias("started_at"),
        F.floor(F.col("value") * F.col("value")).cast("bigint").alias("_seconds"),
        F.when(number % 107 != 3, stand).alias("start_station_id"),
        (number % 109 != 4).alias("_returned"),
        (number % 113 == 5).alias("_brief"),
        F.when(F.col("event_type") == "view", stand)
        .when(F.col("event_type") != "error", F.col("user_id").cast("string"))
        .alias("end_station_id"),
        F.when(F.col("value") >= 200, "staff")
        .when(F.col("user_id") % 2 == 0, "member")
        .otherwise("casual")
        .alias("member_casual"),
    )
    return rows.select(
        "ride_id",
        "rideable_type",
        "started_at",
        F.when(F.col("_returned"), F.expr("timestampadd(MICROSECOND, if(_brief, 1, _seconds * 1000000), started_at)")).alias("ended_at"),
        F.concat(F.lit("Stand "), "start_station_id").alias("start_station_name"),
        "start_station_id",
        F.concat(F.lit("Stand "), "end_station_id").alias("end_station_name"),
        "end_station_id",
        "member_casual",
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_trips(clean_trips(raw_trips(spark, folder)))


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """A weather row per hour with events, its measures taken from their sums."""
    events = table(spark, folder, "events")
    stand = F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("bigint")
    hourly = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at")).agg(
        F.count("*").alias("n"), F.sum(stand).alias("s")
    )
    return hourly.select(
        F.year("at").alias("year"),
        F.month("at").alias("month"),
        F.dayofmonth("at").alias("day"),
        F.hour("at").alias("hour"),
        F.when(F.col("s") % 13 != 0, (F.col("s") % 45 - 5).cast("double")).alias("temp"),
        F.when(F.col("n") % 11 != 0, (F.col("s") % 27 + 1).cast("double")).alias("coco"),
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_weather(raw_weather(spark, folder), YEAR, MONTH)


def trips_with_weather(spark: SparkSession, folder: str) -> DataFrame:
    # One weather row per hour of one month, by construction of `raw_weather`.
    span = month_span(YEAR, MONTH)
    return join_weather(trips(spark, folder), weather(spark, folder), HOURS_IN_MONTH, span)


def links(spark: SparkSession, folder: str) -> Graph:
    """Who leads to whom: customer to order, order to part, part to supplier.

    The four kinds of id are interleaved into one; suppliers lead nowhere.
    """
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    placed = orders.selectExpr("o_custkey * 4 AS src", "o_orderkey * 4 + 1 AS dst")
    bought = lines.selectExpr("l_orderkey * 4 + 1 AS src", "l_partkey * 4 + 2 AS dst")
    made = lines.selectExpr("l_partkey * 4 + 2 AS src", "l_suppkey * 4 + 3 AS dst")
    return Graph(distinct_edges(placed.unionAll(bought).unionAll(made), orders.count() + 2 * lines.count()))


def link_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer of one market segment."""
    return table(spark, folder, "customer").filter("c_mktsegment = 'MACHINERY'").selectExpr("c_custkey * 4 AS id")


def runs(spark: SparkSession, folder: str, number: int) -> Graph:
    """Graphs told apart by ``run``: the links of the orders whose number leaves that remainder, each in one run."""
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    placed = orders.selectExpr(f"cast(o_orderkey % {number} as int) AS run", "o_custkey * 4 AS src", "o_orderkey * 4 + 1 AS dst")
    bought = lines.selectExpr(f"cast(l_orderkey % {number} as int) AS run", "l_orderkey * 4 + 1 AS src", "l_partkey * 4 + 2 AS dst")
    made = lines.selectExpr(f"cast(l_orderkey % {number} as int) AS run", "l_partkey * 4 + 2 AS src", "l_suppkey * 4 + 3 AS dst")
    edges = distinct_edges(placed.unionAll(bought).unionAll(made), orders.count() + 2 * lines.count(), ("run",))
    return Graph(edges, None, ("run",))


def run_seeds(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """Every customer, as a seed of the run of its remainder."""
    return table(spark, folder, "customer").selectExpr(f"cast(c_custkey % {number} as int) AS run", "c_custkey * 4 AS id")


def adjacency_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text of the links, a line for each order line and each customer; blank lines for returned lines."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "if(l_returnflag = 'R', ' ', concat('{\"node_id\":', l_orderkey, ', \"out_neighbors\": [', l_partkey, ',', l_suppkey, ']}')) AS value"
    )
    alone = table(spark, folder, "customer").selectExpr("concat('{\"out_neighbors\": [], \"node_id\": ', -c_custkey, '}') AS value")
    return lines.unionAll(alone)


def seed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line per order with its customer, between blanks; blank for open orders."""
    return table(spark, folder, "orders").selectExpr("if(o_orderstatus = 'O', '  ', concat(' ', o_custkey, '\t')) AS value")


def trip_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The trips as delimited text, some fields quoted, with malformed times."""
    def written(name: str) -> str:
        return f"coalesce(date_format({name}, 'yyyy-MM-dd HH:mm:ss'), '')"

    started = f"concat({written('started_at')}, if(event_id % 17 = 0, 'x', ''))"
    return raw_trips(spark, folder).selectExpr("*", "cast(coalesce(ride_id, '0') as bigint) AS event_id").selectExpr(
        f"concat_ws(',', if(event_id % 19 = 0, '', coalesce(ride_id, '')), rideable_type, {started}, {written('ended_at')}, "
        "coalesce(concat('\"', start_station_name, ', \"'), ''), coalesce(start_station_id, ''), coalesce(end_station_name, ''), coalesce(end_station_id, ''), "
        "'1.5', '', '', '', member_casual) AS value"
    )


def weather_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly weather as delimited text; columns nothing needs stay empty."""
    return raw_weather(spark, folder).selectExpr(
        "concat_ws(',', year, month, day, hour, coalesce(cast(temp as string), ''), 'a', '', '', '', '', '', '', '', '', '', '', '', '', '', '', "
        "coalesce(cast(coco as string), ''), 'b') AS value"
    )


def edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines of an edge list: a part and its supplier, a comment where the line was returned."""
    return table(spark, folder, "lineitem").selectExpr(
        "concat(if(l_returnflag = 'R', '# ', ''), l_partkey, '\\t', l_suppkey, '\\t', l_linestatus) AS value"
    )


def written_trips(spark: SparkSession, folder: str, path: str) -> None:
    """The trips as CSV files of two layouts below ``path``: the usual one, and one in reverse order with a further column."""
    rows = raw_trips(spark, folder).selectExpr(
        "ride_id", "rideable_type", "date_format(started_at, 'yyyy-MM-dd HH:mm:ss') AS started_at", "date_format(ended_at, 'yyyy-MM-dd HH:mm:ss') AS ended_at",
        "start_station_name", "start_station_id", "end_station_name", "end_station_id", "1.5D AS start_lat", "cast(NULL AS DOUBLE) AS start_lng",
        "cast(NULL AS DOUBLE) AS end_lat", "cast(NULL AS DOUBLE) AS end_lng", "member_casual",
    )
    odd = "coalesce(cast(start_station_id AS INT) % 2 = 1, false)"
    rows.filter(f"NOT {odd}").write.option("header", True).csv(f"{path}/usual")
    rows.filter(odd).withColumn("Bike", F.lit("b")).select("Bike", *reversed(rows.columns)).write.option("header", True).csv(f"{path}/reversed")


def written_document(spark: SparkSession, folder: str, path: str) -> None:
    """A single JSON document: each customer with their orders, and a vertex 1 without any.

    The nodes are made and written as lines by all tasks; the one that writes the
    document only copies those, and holds none of them.
    """
    customers = table(spark, folder, "customer").selectExpr("-c_custkey AS id")
    orders = table(spark, folder, "orders").groupBy((-F.col("o_custkey")).alias("id")).agg(F.collect_list("o_orderkey").alias("to"))
    nodes = customers.join(orders, "id", "left").selectExpr(
        "concat(', {\"out_neighbors\": [', coalesce(concat_ws(', ', cast(to AS array<string>)), ''), '], \"node_id\": ', id, '}') AS value"
    )
    nodes.write.text(f"{path}-nodes")
    lines = spark.read.text(f"{path}-nodes")
    ends = [spark.sql(f"SELECT '{text}' AS value") for text in ('{"nodes": [{"node_id": 1, "out_neighbors": []}', "]}")]
    ends[0].unionAll(lines).unionAll(ends[1]).coalesce(1).write.text(path)


def wide_edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """An edge list whose ids exceed 64 bits on either side of zero: a part and its supplier."""
    return table(spark, folder, "lineitem").selectExpr(
        "concat(if(l_returnflag = 'R', '# ', ''), '-', l_partkey, '00000000000000000007', '\t', if(l_linenumber = 1, '+000', ''), l_suppkey, '00000000000000000000') AS value"
    )
