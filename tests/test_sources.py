import json

import pytest

from velorank.sources import graphs, tables

TRIP_HEADER = ",".join(f.name for f in tables.TRIP_SCHEMA)


def test_trip_files(spark, tmp_path):
    line = "r{},classic,2024-10-01 10:00:00,2024-10-01 10:05:00,A,a,B,b,1.5,2.5,3.5,4.5,member"
    for i in (1, 2):
        (tmp_path / f"trips_{i}.csv").write_text(f"{TRIP_HEADER}\n{line.format(i)}\n")
    (tmp_path / "trips_3.csv").write_text(f"{TRIP_HEADER}\n,classic,,,,,,,x,2.5,,,\n")
    rows = tables.read_trips(spark, f"{tmp_path}/trips_*.csv").collect()
    assert len(rows) == 3
    by_id = {r.ride_id: r for r in rows}
    assert by_id["r1"].start_lat == 1.5 and by_id["r2"].started_at == "2024-10-01 10:00:00"
    assert by_id[None].start_lat is None and by_id[None].start_lng == 2.5


def test_a_pruned_read_is_the_same(spark, tmp_path):
    (tmp_path / "t.csv").write_text(f"{TRIP_HEADER}\nr,c,2024-10-01,2024-10-02,A,a,B,b,1,2,3,4,member\n")
    rows = tables.read_trips(spark, str(tmp_path)).select("member_casual", "start_lat").collect()
    assert [tuple(r) for r in rows] == [("member", 1.0)]


def test_reordered_columns_are_an_error(spark, tmp_path):
    names = TRIP_HEADER.split(",")
    names[0], names[1] = names[1], names[0]
    (tmp_path / "t.csv").write_text(",".join(names) + "\nclassic,r" + ",x" * 11 + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_trips(spark, str(tmp_path)).collect()
    row = tables.read_trips(spark, str(tmp_path), check_header=False).first()
    assert (row.ride_id, row.rideable_type) == ("classic", "r")


def test_weather_file(spark, tmp_path):
    header = ",".join(f.name for f in tables.WEATHER_SCHEMA)
    values = ["2024", "10", "1", "7"] + ["1.5", "dwd"] * 8 + ["", ""]
    (tmp_path / "w.csv").write_text(f"{header}\n{','.join(values)}\n")
    row = tables.read_weather(spark, str(tmp_path)).first()
    assert (row.year, row.hour, row.temp, row.temp_source, row.coco) == (2024, 7, 1.5, "dwd", None)
    assert len(row) == 22


EDGE_TEXT = "\n".join([
    "# a comment", "", "   ", "1\t2", "1\t2", " 1\t3\tmore\tfields ", "  # indented comment", "2 3", "4", "x\t1",
    "5\t5", "1.5\t2", "-1\t+2", "3\t 1 ", "7\t\t8", "99999999999999999999\t1",
])


def pairs(frame):
    return sorted((r.src, r.dst) for r in frame.select("src", "dst").collect())


def test_edge_list_with_any_blanks(spark, tmp_path):
    (tmp_path / "edges.txt").write_text(EDGE_TEXT)
    graph = graphs.read_edge_list(spark, str(tmp_path))
    assert pairs(graph.edges) == [(-1, 2), (1, 2), (1, 3), (2, 3), (3, 1), (7, 8)]


def test_edge_list_with_tabs_only(spark, tmp_path):
    (tmp_path / "edges.txt").write_text(EDGE_TEXT)
    graph = graphs.read_edge_list(spark, str(tmp_path), "\t")
    assert pairs(graph.edges) == [(-1, 2), (1, 2), (1, 3), (3, 1)]


def test_edge_list_with_a_special_delimiter(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("1|2\r\n2|3\r\n1 2\r\n")
    assert pairs(graphs.read_edge_list(spark, str(tmp_path), "|").edges) == [(1, 2), (2, 3)]


NODES = [
    {"node_id": 3, "out_neighbors": [1, 1, 9]},
    {"node_id": 1, "out_neighbors": [3]},
    {"node_id": 2},
    {"node_id": 4, "out_neighbors": []},
]


@pytest.mark.parametrize("document", [True, False])
def test_adjacency_files(spark, tmp_path, document):
    text = json.dumps({"nodes": NODES}, indent=2) if document else "\n".join(json.dumps(n) for n in NODES)
    (tmp_path / "g.json").write_text(text)
    graph = graphs.read_adjacency(spark, str(tmp_path), document)
    assert pairs(graph.edges) == [(1, 3), (3, 1), (3, 1), (3, 9)]
    assert sorted(r.id for r in graph.vertices.collect()) == [1, 2, 3, 4]


def test_damaged_adjacency_is_an_error(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"node_id": 1, "out_neighbors": [2]}\n{"node_id": 2, "out_neigh\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        graphs.read_adjacency(spark, str(tmp_path)).edges.collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        graphs.parse_adjacency_lines(spark.read.text(str(tmp_path))).edges.collect()


def test_nodes_without_id_are_an_error(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"node_id": 1, "out_neighbors": [2]}\n{"out_neighbors": [3]}\n')
    graph = graphs.read_adjacency(spark, str(tmp_path))
    for frame in (graph.edges, graph.vertices):
        with pytest.raises(Exception, match="no node_id"):
            frame.collect()


def test_text_lines_are_parsed_as_files_are(spark, tmp_path):
    from velorank.sources import tables

    names = ",".join(f.name for f in tables.TRIP_SCHEMA)
    rows = ['1,classic,2024-10-01 10:00:00,x,"A, B",a,,b,1.5,,,,member', "2,e,,,,,,,,,,,casual"]
    (tmp_path / "t.csv").write_text("\n".join([names, *rows]) + "\n")
    lines = spark.createDataFrame([(r,) for r in rows], "value string")
    assert sorted(tables.parse_trip_lines(lines).collect()) == sorted(tables.read_trips(spark, str(tmp_path)).collect())


def test_seed_file(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("5\n\n 7 \n5\n")
    assert sorted(r.id for r in graphs.read_seeds(spark, str(tmp_path)).collect()) == [5, 7]
    (tmp_path / "seeds.txt").write_text("5\nfive\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        graphs.read_seeds(spark, str(tmp_path)).collect()


def test_inline_seeds(spark):
    assert sorted(r.id for r in graphs.seed_frame(spark, "1, 5,,5").collect()) == [1, 5]
    assert graphs.seed_frame(spark, "").count() == 0
    with pytest.raises(ValueError):
        graphs.seed_frame(spark, "1,x")


def test_files_of_different_layouts(spark, tmp_path):
    """Columns go by name: other orders, further columns, names in other case; files of one layout are read together."""
    line = "r{},classic,2024-10-01 10:00:00,2024-10-01 10:05:00,A,a,\"B, b\",b,1.5,2.5,3.5,4.5,member"
    for i in (1, 2):
        (tmp_path / f"trips {i}.csv").write_text(f"{TRIP_HEADER}\n{line.format(i)}\n")
    names = [*reversed(TRIP_HEADER.split(",")), "bike"]
    values = dict(zip(TRIP_HEADER.split(","), ["r3", "electric", "2024-10-02 10:00:00", "x", "C", "c", "", "", "7.5", "", "", "", "casual"]))
    (tmp_path / "trips_3.csv").write_text("﻿" + ",".join(f'" {n.upper()}"' for n in names) + "\n" + ",".join([*(values[n] for n in names[:-1]), "b"]) + "\n")
    (tmp_path / "trips_4.csv").write_text("")
    assert sorted(len(files) for files in tables.file_layouts(spark, f"{tmp_path}/trips*").values()) == [1, 2]
    rows = {r.ride_id: r for r in tables.read_trip_files(spark, f"{tmp_path}/trips*").collect()}
    assert sorted(rows) == ["r1", "r2", "r3"]
    assert rows["r1"].end_station_name == "B, b" and rows["r2"].end_lng == 4.5
    assert (rows["r3"].member_casual, rows["r3"].start_lat, rows["r3"].end_station_id, rows["r3"].rideable_type) == ("casual", 7.5, None, "electric")


def test_lost_and_repeated_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ride_id,rideable_type\nr,c\n")
    with pytest.raises(ValueError, match="no column started_at"):
        tables.read_trip_files(spark, str(tmp_path))
    (row,) = tables.read_trip_files(spark, str(tmp_path), missing_ok=True).collect()
    assert (row.ride_id, row.started_at, row.start_lat) == ("r", None, None) and len(row) == 13
    (tmp_path / "u.csv").write_text(f"{TRIP_HEADER},Ride_ID\n")
    with pytest.raises(ValueError, match="twice"):
        tables.read_trip_files(spark, str(tmp_path), missing_ok=True)


def degrees(graph):
    return sorted((r.src, r.dst) for r in graph.edges.collect()), sorted(r.id for r in graph.vertices.collect())


@pytest.mark.parametrize("text, edges, vertices", [
    ('{"nodes": [{"node_id": 1, "out_neighbors": [2, 3, 3]}, {"out_neighbors": [], "node_id": -2}]}', [(1, 2), (1, 3), (1, 3)], [-2, 1]),
    ('\n{ "nodes" :\n[\n{\n"node_id": 1}\n,{"node_id":2,"out_neighbors":[1]}\n]\n}\n', [(2, 1)], [1, 2]),
    ('{"nodes": []}', [], []),
])
def test_documents(spark, tmp_path, text, edges, vertices):
    (tmp_path / "d.json").write_text(text)
    assert degrees(graphs.read_adjacency(spark, str(tmp_path), document=True)) == (edges, vertices)


@pytest.mark.parametrize("text", [
    '{"nodes": [{"node_id": 1, "more": {"a": 1}}]}', '{"edges": [{"node_id": 1}]}', '{"nodes": [{"node_id": 1} {"node_id": 2}]}',
    '{"nodes": [{"node_id": "a"}]}', '{"nodes": [{"out_neighbors": [1]}]}', "no document", '{"nodes": [{"node_id": 1]}',
])
def test_other_text_is_no_document(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="(?i)document|malformed|node_id|parse"):
        degrees(graphs.read_adjacency(spark, str(tmp_path), document=True))


def test_a_document_is_read_by_several_tasks(spark, tmp_path):
    nodes = ", ".join(f'{{"node_id": {i}, "out_neighbors": [{i + 1}, {i + 2}]}}' for i in range(20_000))
    (tmp_path / "d.json").write_text(f'{{"nodes": [{nodes}]}}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        graph = graphs.read_adjacency(spark, str(tmp_path), document=True)
        edges = graph.edges.selectExpr("src", "dst", "spark_partition_id() AS task").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.src, r.dst) for r in edges) == sorted((i, i + k) for i in range(20_000) for k in (1, 2))
    assert len({r.task for r in edges}) > 5
