import csv
import datetime as dt
import glob
import json
import random

import pytest

from velorank.sources.tables import TRIP_SCHEMA, WEATHER_SCHEMA


def read(path):
    rows = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name) as file:
            rows += list(csv.DictReader(file))
    return rows


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    draw = random.Random(1)
    for part in (1, 2):
        with open(folder / f"trips_{part}.csv", "w", newline="") as file:
            out = csv.writer(file)
            out.writerow([f.name for f in TRIP_SCHEMA])
            for i in range(400):
                start = dt.datetime(2024, 10, draw.randrange(2, 30), draw.randrange(24), draw.randrange(60))
                end = start + dt.timedelta(seconds=draw.randrange(60, 6000))
                a, b = draw.choice("XYZ"), draw.choice("XYZ")
                out.writerow([
                    f"{part}-{i}", "classic", f"{start}.123", f"{end}.456", a, a.lower(), b, b.lower(), 1, 2, 3, 4,
                    draw.choice(["member", "casual"]),
                ])
    with open(folder / "hourly.csv", "w", newline="") as file:
        out = csv.writer(file)
        out.writerow([f.name for f in WEATHER_SCHEMA])
        for day in range(1, 32):
            for hour in range(24):
                values = {"temp": day - 3, "coco": hour}
                row = [2024, 10, day, hour]
                for name in ("temp", "rhum", "prcp", "wdir", "wspd", "wpgt", "pres", "cldc", "coco"):
                    row += [values.get(name, ""), "s"]
                out.writerow(row)
    return folder


@pytest.mark.parametrize("staged", [False, True])
def test_trip_job(spark, data, tmp_path, staged, capsys):
    import trip_report

    extra = ["--staging", f"{tmp_path}/staged"] if staged else []
    trip_report.main(["--trips", f"{data}/trips_*.csv", "--output", f"{tmp_path}/out", "--top", "4", *extra])
    reports = {path.split("/")[-1]: read(path) for path in glob.glob(f"{tmp_path}/out/*")}
    assert sorted(reports) == [
        "1_rides_by_hour_type", "2a_stations_by_member_ratio", "2b_stations_by_roundtrip_ratio",
        "2c_stations_by_total_rides", "3_most_common_routes", "4a_roundtrip_overall", "4b_roundtrip_by_member",
    ]
    assert sum(int(r["num_of_rides"]) for r in reports["1_rides_by_hour_type"]) == 800
    assert sum(int(r["total_rides"]) for r in reports["2c_stations_by_total_rides"]) == 800
    ratios = [float(r["member_ratio"]) for r in reports["2a_stations_by_member_ratio"]]
    assert ratios == sorted(ratios, reverse=True) and len(ratios) == 3
    assert all(int(r["total_rides"]) >= 100 for r in reports["3_most_common_routes"])
    assert sum(float(r["percentage"]) for r in reports["4a_roundtrip_overall"]) == pytest.approx(100, abs=0.02)
    assert len(reports["4b_roundtrip_by_member"]) == 4
    assert "{'loaded': 800, 'clean': 800, 'rejected': 0}" in capsys.readouterr().out
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_weather_job(spark, data, tmp_path, capsys):
    import weather_report

    weather_report.main([
        "--trips", f"{data}/trips_*.csv", "--weather", f"{data}/hourly.csv", "--output", f"{tmp_path}/out",
    ])
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    reports = {path.split("/")[-1]: read(path) for path in glob.glob(f"{tmp_path}/out/*")}
    assert "{'loaded': 800, 'clean': 800, 'joined': 800, 'rejected': 0}" in capsys.readouterr().out
    assert sorted(reports) == ["1_rain_impact_by_hour", "2_rain_impact_by_member", "3_temp_impact_comparison"]
    assert sum(int(r["num_rides"]) for r in reports["1_rain_impact_by_hour"]) == 800
    # 07:00 UTC, code 7, is 03:00 in New York.
    assert {r["is_rainy"] for r in reports["1_rain_impact_by_hour"] if r["hour_in_day"] == "3"} == {"rainy"}
    assert {r["is_rainy"] for r in reports["1_rain_impact_by_hour"] if r["hour_in_day"] == "0"} == {"non_rainy"}
    assert [r["temp_band"] for r in reports["3_temp_impact_comparison"]] == ["cold", "mild", "very_cold", "warm"]


def test_rank_job(spark, tmp_path, capsys):
    import rank_graph

    (tmp_path / "edges.txt").write_text("# links\n1 2\n1 3\n2 3\n3 1\n4 3\n")
    (tmp_path / "seeds.txt").write_text("4\n")
    rank_graph.main([
        "--edge-list", f"{tmp_path}/edges.txt", "--K", "2", "--validate", "--output-ranks", f"{tmp_path}/ranks",
        "--output-convergence", f"{tmp_path}/rounds",
    ])
    assert "valid                  | true" in capsys.readouterr().out
    assert sum(len(open(p).readlines()) for p in glob.glob(f"{tmp_path}/ranks/part-*")) == 4
    assert {r["iteration"] for r in read(f"{tmp_path}/rounds")} >= {"1", "2"}
    rank_graph.main([
        "--edge-list", f"{tmp_path}/edges.txt", "--personalized", "--seeds", "1", "--seeds-file", f"{tmp_path}/seeds.txt",
        "--K", "1", "--max-iter", "1", "--output-ranks", f"{tmp_path}/own",
    ])
    lines = [line.split("\t") for p in glob.glob(f"{tmp_path}/own/part-*") for line in open(p)]
    # Nothing leads to 4, so it has what its seed is given: the file won over --seeds.
    assert {int(i): float(r) for i, r in lines}[4] == pytest.approx(0.15)
    with pytest.raises(ValueError):
        rank_graph.main(["--edge-list", f"{tmp_path}/edges.txt", "--personalized"])


def test_rank_job_on_a_random_graph(spark, tmp_path):
    import rank_graph

    rank_graph.main([
        "--generate", "--num-nodes", "60", "--num-edges", "150", "--output-graph", f"{tmp_path}/g", "--output-ranks",
        f"{tmp_path}/first", "--num-partitions", "2",
    ])
    nodes = [json.loads(line) for p in glob.glob(f"{tmp_path}/g/part-*") for line in open(p)]
    assert len(nodes) == 60 and sum(len(n["out_neighbors"]) for n in nodes) == 150
    rank_graph.main(["--adjacency", f"{tmp_path}/g", "--output-ranks", f"{tmp_path}/second"])

    def ranks(name):
        lines = [line.split("\t") for p in glob.glob(f"{tmp_path}/{name}/part-*") for line in open(p)]
        return {int(i): float(r) for i, r in lines}

    assert ranks("first") == pytest.approx(ranks("second"))


def test_comparison_job(spark, tmp_path):
    import compare_ranks

    compare_ranks.main([
        "--runs", "2", "--seeds-per-run", "2", "--num-nodes", "50", "--num-edges", "120", "--K", "5", "--max-iter", "3",
        "--output-json", f"{tmp_path}/c",
    ])
    (line,) = [line for p in glob.glob(f"{tmp_path}/c/part-*") for line in open(p)]
    assert len(json.loads(line)["per_run"]) == 2
