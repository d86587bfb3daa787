"""DuckDB SQL giving the results the registered queries must have."""

from __future__ import annotations

from workloads.queries import DIGITS, EPSILON, FIRST_SEED, ROUTE_MIN_RIDES, RUNS, TOP

MIN_RIDES = 100
MAX_ROUNDS = 20


def half_up(value: str) -> str:
    """Two digits, rounded on the printed decimal as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def mean(seconds: str = "seconds") -> str:
    return half_up(f"CAST(sum({seconds}) AS DOUBLE) / (count({seconds}) * 60)")


RAW_TRIPS = """
raw AS (
  SELECT CASE WHEN event_id % 101 <> 1 THEN CAST(event_id AS VARCHAR) END AS ride_id, event_type AS rideable_type,
         CASE WHEN event_id % 103 <> 2 THEN ts END AS started_at,
         CASE WHEN event_id % 109 <> 4 AND event_id % 103 <> 2 THEN
           ts + to_microseconds(CASE WHEN event_id % 113 = 5 THEN 1 ELSE CAST(floor(value * value) AS BIGINT) * 1000000 END) END AS ended_at,
         CASE WHEN event_id % 107 <> 3 THEN 'Stand ' || stand END AS start_station_name,
         CASE WHEN event_id % 107 <> 3 THEN stand END AS start_station_id,
         'Stand ' || back AS end_station_name, back AS end_station_id,
         CASE WHEN value >= 200 THEN 'staff' WHEN user_id % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN stand
                       WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS back
        FROM (SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1) AS stand FROM events))
),
timed AS (
  SELECT *, epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000 AS seconds,
         (epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000) / 60e0 AS duration_minutes
  FROM raw
)"""

TRIPS = RAW_TRIPS + """,
clean AS (
  SELECT * FROM timed
  WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND start_station_id IS NOT NULL AND ended_at IS NOT NULL
    AND ended_at > started_at AND duration_minutes > 0 AND duration_minutes <= 1440
),
trips AS (
  SELECT *, CAST(hour(started_at) AS INTEGER) AS hour_in_day, dayname(started_at) AS day_of_week,
         dayname(started_at) IN ('Saturday', 'Sunday') AS weekend_indicator,
         coalesce(start_station_id = end_station_id, false) AS round_trip,
         CASE WHEN duration_minutes <= 15 THEN 'short' WHEN duration_minutes <= 45 THEN 'medium' ELSE 'long' END
           AS ride_type
  FROM clean
)"""

# In January the local time is a constant five hours behind.
WEATHER = """
hourly AS (
  SELECT date_trunc('hour', ts) AS starts, count(*) AS n,
         CAST(sum(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS s
  FROM events GROUP BY 1
),
weather AS (
  SELECT *, CASE WHEN coco IN (7, 14) THEN 'light_precip' WHEN coco IN (8, 15, 17, 21) THEN 'moderate_precip'
                 WHEN coco IN (9, 16, 18, 22) THEN 'heavy_precip'
                 WHEN coco IN (10, 11, 12, 13, 19, 20) THEN 'hazardous' ELSE 'clear' END AS rain_indicator,
         CASE WHEN temp < 5 THEN 'very_cold' WHEN temp <= 10 THEN 'cold' WHEN temp <= 20 THEN 'mild'
              WHEN temp < 30 THEN 'warm' ELSE 'hot' END AS temp_band
  FROM (
    SELECT CAST(year(starts) AS INTEGER) AS year, CAST(month(starts) AS INTEGER) AS month,
           CAST(day(starts) AS INTEGER) AS day, CAST(hour(starts) AS INTEGER) AS hour,
           CASE WHEN s % 13 <> 0 THEN CAST(s % 45 - 5 AS DOUBLE) END AS temp,
           CASE WHEN n % 11 <> 0 THEN CAST(s % 27 + 1 AS DOUBLE) END AS coco,
           starts AS hour_timestamp_utc, starts - INTERVAL 5 HOUR AS hour_timestamp
    FROM hourly
  )
  WHERE temp IS NOT NULL AND year = 2024 AND month = 1
)"""

JOINED = TRIPS + "," + WEATHER + """,
joined AS (
  SELECT t.*, w.hour_timestamp, w.rain_indicator, w.temp, w.temp_band,
         CASE WHEN w.rain_indicator <> 'clear' THEN 'rainy' ELSE 'non_rainy' END AS is_rainy
  FROM trips t JOIN weather w ON w.hour_timestamp = date_trunc('hour', t.started_at)
)"""

LINKS = """
edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (
    SELECT o_custkey * 4 AS src, o_orderkey * 4 + 1 AS dst FROM orders
    UNION ALL SELECT l_orderkey * 4 + 1, l_partkey * 4 + 2 FROM lineitem
    UNION ALL SELECT l_partkey * 4 + 2, l_suppkey * 4 + 3 FROM lineitem
  ) WHERE src <> dst
),
ids AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
vertices AS MATERIALIZED (
  SELECT id, coalesce(n, 0) AS out_degree
  FROM ids LEFT JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) ON src = id
)"""

LINK_GRAPH = LINKS + """,
graph_edges AS (SELECT 0 AS run, src, dst FROM edges),
graph_vertices AS (SELECT 0 AS run, id, out_degree FROM vertices)"""

LINK_SEEDS = """,
graph_seeds AS (SELECT DISTINCT 0 AS run, c_custkey * 4 AS id FROM customer WHERE c_mktsegment = 'MACHINERY')"""

RUN_GRAPHS = f"""
graph_edges AS MATERIALIZED (
  SELECT DISTINCT run, src, dst FROM (
    SELECT CAST(o_orderkey % {RUNS} AS INTEGER) AS run, o_custkey * 4 AS src, o_orderkey * 4 + 1 AS dst FROM orders
    UNION ALL SELECT l_orderkey % {RUNS}, l_orderkey * 4 + 1, l_partkey * 4 + 2 FROM lineitem
    UNION ALL SELECT l_orderkey % {RUNS}, l_partkey * 4 + 2, l_suppkey * 4 + 3 FROM lineitem
  )
),
graph_vertices AS MATERIALIZED (
  SELECT i.run, i.id, coalesce(n, 0) AS out_degree
  FROM (SELECT run, src AS id FROM graph_edges UNION SELECT run, dst FROM graph_edges) i
  LEFT JOIN (SELECT run, src, count(*) AS n FROM graph_edges GROUP BY run, src) d ON d.run = i.run AND d.src = i.id
),
graph_seeds AS MATERIALIZED (SELECT DISTINCT CAST(c_custkey % {RUNS} AS INTEGER) AS run, c_custkey * 4 AS id FROM customer)"""


def rank_ctes(name: str, rounds: int, personalized: bool = False, epsilon: float = EPSILON) -> str:
    """Chained CTEs ``{name}0 .. {name}{rounds}`` of ranks and ``{name}_steps`` of their changes."""
    if personalized:
        flag = "(v.run, v.id) IN (SELECT (run, id) FROM graph_seeds)"
        size = ", (SELECT count(*) FROM graph_seeds s WHERE s.run = v.run) AS seeds"
        jump = "CASE WHEN is_seed THEN (1e0 - 0.85e0) / seeds ELSE 0e0 END"
    else:
        flag, size, jump = "false", ", 0 AS seeds", "(1e0 - 0.85e0) / n"
    parts = [f"""
{name}_n AS MATERIALIZED (SELECT run, count(*) AS n{size} FROM graph_vertices v GROUP BY run),
{name}0 AS MATERIALIZED (
  SELECT v.run, v.id, v.out_degree, {flag} AS is_seed, 1e0 / n AS rank, NULL::DOUBLE AS before
  FROM graph_vertices v JOIN {name}_n USING (run)
)"""]
    for i in range(1, rounds + 1):
        parts.append(f"""
{name}_mass{i} AS MATERIALIZED (
  SELECT run, sum(CASE WHEN out_degree = 0 THEN rank ELSE 0e0 END) AS mass FROM {name}{i - 1} GROUP BY run
),
{name}_got{i} AS MATERIALIZED (
  SELECT e.run, e.dst AS id, sum(r.rank / r.out_degree) AS got
  FROM graph_edges e JOIN {name}{i - 1} r ON r.run = e.run AND r.id = e.src GROUP BY e.run, e.dst
),
{name}{i} AS MATERIALIZED (
  SELECT r.run, r.id, r.out_degree, r.is_seed, {jump} + 0.85e0 * (coalesce(got, 0e0) + mass / n) AS rank, r.rank AS before
  FROM {name}{i - 1} r JOIN {name}_n USING (run) JOIN {name}_mass{i} USING (run)
  LEFT JOIN {name}_got{i} g ON g.run = r.run AND g.id = r.id
)""")
    steps = " UNION ALL ".join(
        f"SELECT r.run, {i} AS iteration, sum(abs(r.rank - r.before)) AS delta, any_value(mass) AS mass"
        f" FROM {name}{i} r JOIN {name}_mass{i} m ON m.run = r.run GROUP BY r.run"
        for i in range(1, rounds + 1)
    )
    parts.append(f"""
{name}_steps AS MATERIALIZED ({steps}),
{name}_last AS MATERIALIZED (
  SELECT run, coalesce(min(iteration) FILTER (WHERE delta < {epsilon}), {rounds}) AS iteration
  FROM {name}_steps GROUP BY run
)""")
    return ",".join(parts)


def converged_ctes(name: str, rounds: int) -> str:
    """``{name}_final``: the ranks of each run's last round."""
    every = " UNION ALL ".join(
        f"SELECT r.run, r.id, r.rank FROM {name}{i} r JOIN {name}_last l ON l.run = r.run AND l.iteration = {i}"
        for i in range(1, rounds + 1)
    )
    return f"""
{name}_final AS MATERIALIZED ({every}),
{name}_top AS MATERIALIZED (
  SELECT run, id, place FROM (
    SELECT run, id, row_number() OVER (PARTITION BY run ORDER BY rank DESC, id) AS place FROM {name}_final
  ) WHERE place <= {TOP}
)"""


def stations(order_by: str) -> str:
    shares = ", ".join(
        f"{half_up(f'CAST({part} AS DOUBLE) / total_rides')} AS {name}"
        for name, part in (
            ("member_ratio", "member_rides"), ("round_trip_ratio", "round_trip_rides"), ("short_ratio", "short_rides"),
            ("medium_ratio", "medium_rides"), ("long_ratio", "long_rides"),
        )
    )
    return f"""WITH {TRIPS},
totals AS (
  SELECT start_station_name, start_station_id, count(*) AS total_rides,
         count(*) FILTER (WHERE member_casual = 'member') AS member_rides,
         count(*) FILTER (WHERE member_casual = 'casual') AS casual_rides,
         count(*) FILTER (WHERE round_trip) AS round_trip_rides,
         count(*) FILTER (WHERE ride_type = 'short') AS short_rides,
         count(*) FILTER (WHERE ride_type = 'medium') AS medium_rides,
         count(*) FILTER (WHERE ride_type = 'long') AS long_rides,
         {mean()} AS avg_duration
  FROM trips GROUP BY 1, 2 HAVING count(*) >= {MIN_RIDES}
)
SELECT *, {shares} FROM totals
ORDER BY {order_by} DESC, start_station_name, start_station_id LIMIT 10"""


def round_trips(keys: str, more: str = "") -> str:
    return f"""WITH {TRIPS}
SELECT {keys}, count(*) AS num_rides, {half_up('quantile_disc(duration_minutes, 0.5)')} AS median_duration,
       {mean()} AS avg_duration{more}
FROM trips GROUP BY {keys}"""


def ranks(name: str, personalized: bool, top: bool) -> str:
    seeds = LINK_SEEDS if personalized else ""
    cut = f" ORDER BY rank DESC, id LIMIT {TOP}" if top else ""
    return f"""WITH {LINK_GRAPH}{seeds},{rank_ctes(name, MAX_ROUNDS, personalized)},{converged_ctes(name, MAX_ROUNDS)}
SELECT id, out_degree, round(rank * (SELECT count(*) FROM vertices), {DIGITS}) AS rank_in_means
FROM (SELECT f.id, v.out_degree, f.rank FROM {name}_final f JOIN vertices v ON v.id = f.id{cut.replace(' id', ' f.id')})"""


def steps(name: str, variant: str, seeds: str) -> str:
    return f"""SELECT s.run, '{variant}' AS variant, CAST(s.iteration AS INTEGER) AS iteration, round(delta, {DIGITS}) AS delta,
       round(mass, {DIGITS}) AS dangling_mass, {seeds} AS num_seeds
FROM {name}_steps s JOIN {name}_last l ON l.run = s.run AND s.iteration <= l.iteration"""


SEED_COUNT = "(SELECT count(*) FROM graph_seeds g WHERE g.run = s.run)"

TWO_RANKS = f"""{RUN_GRAPHS},
{rank_ctes("r", MAX_ROUNDS)},{converged_ctes("r", MAX_ROUNDS)},
{rank_ctes("p", MAX_ROUNDS, True)},{converged_ctes("p", MAX_ROUNDS)},
both_tops AS (SELECT r.run, count(*) AS n FROM r_top r JOIN p_top p ON p.run = r.run AND p.id = r.id GROUP BY r.run)"""


def validation(cases: dict[str, str]) -> str:
    """The checks in their order over the named rank tables (``id, rank``)."""
    parts = []
    for case, table in cases.items():
        parts.append(f"""
SELECT '{case}' AS "case", t.* FROM (
  SELECT (SELECT count(*) FROM ({table}) WHERE rank < 0) AS negative, (SELECT sum(rank) FROM ({table})) AS total,
         (SELECT count(*) FROM vertices) AS nodes, (SELECT count(*) FROM ({table})) AS ranked,
         (SELECT count(*) FROM vertices WHERE out_degree = 0) AS dangling,
         (SELECT count(*) FROM vertices v WHERE out_degree = 0 AND NOT EXISTS (SELECT 1 FROM ({table}) r WHERE r.id = v.id)) AS missing,
         (SELECT min(rank) FROM ({table}) r JOIN vertices v ON v.id = r.id WHERE out_degree = 0) AS lowest
) t""")
    union = " UNION ALL ".join(parts)
    return f"""checked AS (
  SELECT *, negative > 0 AS f1, abs(total - 1) > 1e-6 AS f2, nodes <> ranked AS f3, missing > 0 AS f4,
         dangling > 0 AND lowest <= 0 AS f5
  FROM ({union})
)
SELECT "case", NOT (f1 OR f2 OR f3 OR f4 OR coalesce(f5, false)) AS valid,
       CASE WHEN f1 THEN 'negative_rank' WHEN f2 THEN 'sum_off' WHEN f3 THEN 'count_differs' WHEN f4 THEN 'dangling_unranked'
            WHEN f5 THEN 'dangling_not_positive' END AS reason,
       CAST(negative AS BIGINT) AS negative_ranks_count, CASE WHEN NOT f1 THEN round(total, {DIGITS}) END AS rank_sum,
       CASE WHEN NOT (f1 OR f2) THEN nodes END AS num_nodes, CASE WHEN NOT (f1 OR f2) THEN ranked END AS num_ranks,
       CASE WHEN NOT (f1 OR f2 OR f3) THEN dangling END AS dangling_nodes_count,
       CASE WHEN NOT (f1 OR f2 OR f3) AND dangling > 0 THEN missing END AS missing_dangling_ranks,
       CASE WHEN NOT (f1 OR f2 OR f3 OR f4) AND dangling > 0 THEN round(lowest, {DIGITS}) END AS min_dangling_rank
FROM checked"""


def _percent(part: str, total: str) -> str:
    return half_up(f"CAST({part} AS DOUBLE) / nullif({total}, 0) * 100")


REJECTS = [
    ("no_ride_id", "ride_id IS NULL"), ("no_start_time", "started_at IS NULL"),
    ("no_start_station", "start_station_id IS NULL"), ("no_end_time", "ended_at IS NULL"),
    ("not_after_start", "ended_at <= started_at"), ("no_duration", "duration_minutes <= 0"),
    ("too_long", "duration_minutes > 1440"),
]


def reject_counts() -> str:
    case = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in REJECTS)
    counts = ", ".join(
        f"count(*) FILTER (WHERE reason = '{name}') AS {name}" for name in ["clean", *[name for name, _ in REJECTS]]
    )
    return f"""WITH {RAW_TRIPS}
SELECT count(*) AS loaded, {counts} FROM (SELECT CASE {case} ELSE 'clean' END AS reason FROM timed)"""


def report_lines(name: str, columns: list[str], sql: str) -> str:
    """A report's lines as the files hold them."""
    line = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"SELECT '{name}' AS report, {line} AS line FROM ({sql})"


def report_files() -> str:
    found = [
        report_lines("1_rides_by_hour_type", ["weekend_indicator", "member_casual", "hour_in_day", "ride_type", "num_of_rides"], f"""WITH {TRIPS}
SELECT weekend_indicator, member_casual, hour_in_day, ride_type, count(*) AS num_of_rides FROM trips GROUP BY 1, 2, 3, 4"""),
        report_lines("4a_roundtrip_overall", ["round_trip", "num_rides", "median_duration", "avg_duration", "percentage"],
                     round_trips("round_trip", ", " + half_up("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100") + " AS percentage")),
        report_lines("4b_roundtrip_by_member", ["member_casual", "round_trip", "num_rides", "median_duration", "avg_duration"],
                     round_trips("member_casual, round_trip")),
    ]
    return " UNION ALL ".join(found)


ORACLE: dict[str, str] = {
    "trip_clean": f"WITH {TRIPS} SELECT * EXCLUDE (seconds) FROM clean",
    "trip_reject_counts": reject_counts(),
    "trip_enrich": f"""WITH {TRIPS}
SELECT ride_id, duration_minutes, hour_in_day, day_of_week, weekend_indicator, round_trip, ride_type FROM trips""",
    "rides_by_hour_type": f"""WITH {TRIPS}
SELECT weekend_indicator, member_casual, hour_in_day, ride_type, count(*) AS num_of_rides
FROM trips GROUP BY 1, 2, 3, 4 ORDER BY 1, 2, 3, 4""",
    "station_member_ratio": stations("member_ratio"),
    "station_roundtrip_ratio": stations("round_trip_ratio"),
    "station_total_rides": stations("total_rides"),
    "common_routes": f"""WITH {TRIPS},
routes AS (
  SELECT start_station_name, end_station_name, count(*) AS total_rides,
         {half_up('quantile_disc(duration_minutes, 0.5)')} AS median_duration, {mean()} AS avg_duration,
         {half_up('stddev_samp(duration_minutes)')} AS stddev_duration
  FROM trips GROUP BY 1, 2 HAVING count(*) >= {ROUTE_MIN_RIDES}
)
SELECT *, {half_up('stddev_duration / avg_duration * 100')} AS coef_variation FROM routes
ORDER BY total_rides DESC, start_station_name NULLS LAST, end_station_name NULLS LAST LIMIT 10""",
    "round_trip_overall": round_trips("round_trip", ", " + half_up("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100") + " AS percentage"),
    "round_trip_by_member": round_trips("member_casual, round_trip"),
    "weather_enrich": f"WITH {WEATHER} SELECT * FROM weather",
    "trip_weather_join": f"""WITH {JOINED}
SELECT ride_id, hour_timestamp, rain_indicator, temp, temp_band, is_rainy FROM joined""",
    "rain_impact_by_hour": f"""WITH {JOINED}
SELECT hour_in_day, is_rainy, count(*) AS num_rides, {mean()} AS avg_duration FROM joined GROUP BY 1, 2 ORDER BY 1, 2""",
    "rain_impact_by_member": f"""WITH {JOINED}
SELECT hour_in_day, member_casual, is_rainy, count(*) AS num_rides, {mean()} AS avg_duration
FROM joined GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "temperature_impact": f"""WITH {JOINED},
bands AS (
  SELECT temp_band, count(*) FILTER (WHERE member_casual = 'member') AS member_rides,
         count(*) FILTER (WHERE member_casual = 'casual') AS casual_rides,
         {mean("CASE WHEN member_casual = 'casual' THEN seconds END")} AS casual_avg_duration
  FROM joined GROUP BY 1
)
SELECT *, member_rides + casual_rides AS total_rides,
       {_percent('member_rides', '(member_rides + casual_rides)')} AS member_percentage,
       {_percent('casual_rides', '(member_rides + casual_rides)')} AS casual_percentage
FROM bands ORDER BY temp_band""",
    "weather_join_counts": f"""WITH {JOINED}
SELECT (SELECT count(*) FROM raw) AS loaded, (SELECT count(*) FROM trips) AS clean, (SELECT count(*) FROM joined) AS joined""",
    "trip_text_scan": f"""WITH {RAW_TRIPS},
written AS (
  SELECT CASE WHEN CAST(ride_id AS BIGINT) % 19 <> 0 THEN ride_id END AS ride_id, rideable_type,
         CASE WHEN CAST(ride_id AS BIGINT) % 17 <> 0 THEN date_trunc('second', started_at) END AS started_at,
         date_trunc('second', ended_at) AS ended_at, start_station_name || ', ' AS start_station_name, start_station_id,
         end_station_name, end_station_id, member_casual
  FROM raw
)
SELECT *, (epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000) / 60e0 AS duration_minutes FROM written
WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND start_station_id IS NOT NULL AND ended_at > started_at
  AND (epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000) <= 86400""",
    "weather_text_scan": f"""WITH {WEATHER}
SELECT hour_timestamp, temp, coco, rain_indicator, temp_band FROM weather""",
    "trip_file_scan": f"""WITH {RAW_TRIPS},
written AS (
  SELECT ride_id, rideable_type, date_trunc('second', started_at) AS started_at, date_trunc('second', ended_at) AS ended_at,
         start_station_name, start_station_id, end_station_name, end_station_id, 1.5e0 AS start_lat, member_casual
  FROM raw
)
SELECT *, (epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000) / 60e0 AS duration_minutes FROM written
WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND start_station_id IS NOT NULL AND ended_at > started_at
  AND (epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000) <= 86400""",
    "report_files": report_files(),
    "document_scan": """SELECT -c_custkey AS id, count(o_orderkey) AS out_degree
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey UNION ALL SELECT 1, 0""",
    "wide_id_edges": """WITH pairs AS (
  SELECT DISTINCT CAST(CAST('-' || l_partkey || '00000000000000000007' AS DECIMAL(38, 0)) AS VARCHAR) AS src,
         CAST(CAST(l_suppkey || '00000000000000000000' AS DECIMAL(38, 0)) AS VARCHAR) AS dst
  FROM lineitem WHERE l_returnflag <> 'R'
), names AS (
  SELECT name, row_number() OVER (ORDER BY CAST(name AS DECIMAL(38, 0))) - 1 AS id
  FROM (SELECT src AS name FROM pairs UNION SELECT dst FROM pairs)
)
SELECT s.id AS src_id, d.id AS dst_id, src, dst FROM pairs JOIN names s ON s.name = src JOIN names d ON d.name = dst""",
    "rank_files": f"""WITH {LINKS}
SELECT id, CAST(out_degree AS DOUBLE) AS rank, row_number() OVER (ORDER BY id) - 1 AS place FROM vertices""",
    "edge_list_scan": """SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem
WHERE l_returnflag <> 'R' AND l_partkey <> l_suppkey""",
    "graph_edges": f"WITH {LINKS} SELECT src, dst FROM edges",
    "graph_vertices": f"WITH {LINKS} SELECT id, out_degree FROM vertices",
    "graph_adjacency": f"""WITH {LINKS}
SELECT id AS node_id, CAST(coalesce(slice, 0) AS INTEGER) AS slice, coalesce(string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst), '') AS out_neighbors
FROM vertices LEFT JOIN (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 100000 AS slice FROM edges) ON src = id
GROUP BY id, slice""",
    "adjacency_scan": """SELECT id, CAST(sum(n) AS BIGINT) AS out_degree FROM (
  SELECT l_orderkey AS id, 2 AS n FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT -c_custkey, 0 FROM customer
) GROUP BY id""",
    "seed_scan": "SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus <> 'O'",
    "dangling_nodes": f"WITH {LINKS} SELECT id FROM vertices WHERE out_degree = 0",
    "pagerank_contributions": f"""WITH {LINKS}
SELECT dst AS id, round(sum(1e0 / out_degree), {DIGITS}) AS contribution
FROM edges JOIN vertices ON id = src GROUP BY dst""",
    "pagerank_ranks": ranks("r", False, False),
    "pagerank_topk": ranks("r", False, True),
    "ppr_ranks": ranks("p", True, False),
    "ppr_topk": ranks("p", True, True),
    "pagerank_convergence": f"""WITH {LINK_GRAPH},{rank_ctes("r", MAX_ROUNDS)}
SELECT * EXCLUDE (run) FROM ({steps("r", "standard", "CAST(0 AS BIGINT)")})""",
    "keyed_convergence": f"""WITH {RUN_GRAPHS},{rank_ctes("r", MAX_ROUNDS)},{rank_ctes("p", MAX_ROUNDS, True)}
{steps("r", "standard", SEED_COUNT)} UNION ALL {steps("p", "personalized", SEED_COUNT)}""",
    "rank_validation": f"""WITH {LINK_GRAPH},{rank_ctes("r", MAX_ROUNDS)},{converged_ctes("r", MAX_ROUNDS)},
{validation({"ranks": "SELECT id, rank FROM r_final"}).replace('SELECT "case", NOT', 'SELECT NOT')}""",
    "spoiled_validation": f"""WITH {LINKS},
even AS MATERIALIZED (SELECT id, out_degree, 1e0 / (SELECT count(*) FROM vertices) AS rank FROM vertices),
{validation({
    "even": "SELECT id, rank FROM even",
    "negative": "SELECT id, CASE WHEN id = (SELECT min(id) FROM even) THEN -rank ELSE rank END AS rank FROM even",
    "doubled": "SELECT id, rank * 2 AS rank FROM even",
    "missing": "SELECT id, rank / (SELECT sum(rank) FROM even WHERE out_degree > 0) AS rank FROM even WHERE out_degree > 0",
    "zero_dangling": "SELECT id, CASE WHEN out_degree > 0 THEN rank / (SELECT sum(rank) FROM even WHERE out_degree > 0) ELSE 0e0 END AS rank FROM even",
    "strangers": "SELECT CASE WHEN out_degree = 0 THEN -1 - id ELSE id END AS id, rank FROM even",
})}""",
    "seed_sample": f"""WITH {LINKS}
SELECT id FROM vertices ORDER BY md5('seed:{FIRST_SEED}:' || CAST(id AS VARCHAR)), id LIMIT {TOP}""",
    "topk_overlap": f"""WITH {TWO_RANKS}
SELECT s.run, s.seeds, a.ids AS "topK_standard", b.ids AS "topK_personalized",
       coalesce(n, 0) AS overlap_count, coalesce(n, 0) / {TOP}e0 AS overlap_ratio
FROM (SELECT run, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS seeds FROM graph_seeds GROUP BY run) s
JOIN (SELECT run, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids FROM r_top GROUP BY run) a USING (run)
JOIN (SELECT run, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids FROM p_top GROUP BY run) b USING (run)
LEFT JOIN both_tops USING (run)""",
    "topk_average_overlap": f"""WITH {TWO_RANKS}
SELECT round(avg(coalesce(n, 0) / {TOP}e0), {DIGITS}) AS average_overlap_ratio
FROM (SELECT DISTINCT run FROM graph_seeds) LEFT JOIN both_tops USING (run)""",
}
