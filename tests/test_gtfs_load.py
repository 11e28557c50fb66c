"""GTFS files as they come: columns by name, quoted line breaks across splits, rejects, times past midnight."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from stopwise.sources import gtfs as gl

BASE = {"agency": "agency_id,agency_name\nA1,Acme\n", "routes": "route_id,agency_id\nR1,A1\n",
        "calendar": "service_id,start_date\nC1,20240101\n", "trips": "route_id,service_id,trip_id\nR1,C1,T1\n",
        "stops": "stop_id,stop_name,stop_lat,stop_lon\nS1,One,59.5,18.25\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,08:00:00,08:01:00,S1,1\n"}


def feed(path, **files):
    for t, text in {**BASE, **files}.items():
        if text is not None:
            (path / f"{t}.txt").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_columns_by_header_name(spark, tmp_path):
    f = gl.read_feed(spark, feed(
        tmp_path, agency="agency_name,agency_id\nAcme,A1\n",
        stops=b"\xef\xbb\xbfstop_lat,platform_height,stop_lon,stop_id,stop_name\r\n59.1,3,18.5,S1,Central\r\n\r\n59.2,,18.6,S2,\"A, \"\"B\"\"\"\r\n"))
    assert f.tables["agency"].select("agency_id", "agency_name", "agency_url").collect() == [("A1", "Acme", None)]
    s = f.tables["stops"].orderBy("stop_id")
    assert s.columns == [c for c, _ in gl.SCHEMAS["stops"]]
    assert [tuple(r) for r in s.select("stop_id", "stop_name", "stop_lat", "stop_lon", "zone_id").collect()] == [
        ("S1", "Central", 59.1, 18.5, None), ("S2", 'A, "B"', 59.2, 18.6, None)]
    assert {r.stop_id: r.extra for r in f.extras["stops"].collect()} == {"S1": {"platform_height": "3"}, "S2": {"platform_height": None}}
    assert set(f.extras) == {"stops"} and f.rejects.count() == 0


def test_files_of_one_table_with_different_headers(spark, tmp_path):
    folder = feed(tmp_path, stops=None)
    d = tmp_path / "stops.txt"
    d.mkdir()
    (d / "part 1.csv").write_text("stop_id,stop_lat,stop_lon\nS1,1,2\n")
    (d / "part-2.csv").write_text('Stop_Lon, stop_id ,stop_lat,note\n4,S2,3,"x\ny"\n')
    (d / "part-3.csv").write_text("")
    (d / "part-4.csv").write_text("stop_id,stop_lat,stop_lon\n")
    f = gl.read_feed(spark, folder)
    assert {(r.stop_id, r.stop_lat, r.stop_lon) for r in f.tables["stops"].collect()} == {("S1", 1.0, 2.0), ("S2", 3.0, 4.0)}
    assert {r.stop_id: r.extra for r in f.extras["stops"].collect()} == {"S1": None, "S2": {"note": "x\ny"}}


def test_rejects_and_times(spark, tmp_path):
    f = gl.read_feed(spark, feed(
        tmp_path, stop_times="stop_sequence,trip_id,arrival_time,departure_time,stop_id\n1,T1,25:10:30,,S1\nx,T1,08:00:00,08:00:00,S1\n"
        "2,T1,8:00:00,08:61:00,S1\n3,T1\n4,T1,,,S1,more,values\n5,,08:00:00,08:00:00,S1\n6,T1, 9:05:01,100:00:00,S1\n",
        stops="stop_id,stop_lat,stop_lon\nS1,NaN,1\nS2,1,two\nS3,1e1, 2.5 \n", calendar="service_id,start_date\nC1,2024-01-01\nC2,20240101\n"))
    got = f.tables["stop_times"].select("stop_sequence", "arrival_seconds", "departure_seconds").orderBy("stop_sequence").collect()
    assert [tuple(r) for r in got] == [(1, 90630, None), (6, 32701, 360000)]
    assert [tuple(r) for r in f.tables["stops"].select("stop_id", "stop_lat", "stop_lon").collect()] == [("S3", 10.0, 2.5)]
    report = {(r.table_name, r.column): r.rows for r in f.reject_report().collect()}
    assert report == {("stop_times", "stop_sequence"): 1, ("stop_times", "departure_time"): 1, ("stop_times", "*"): 2, ("stop_times", "trip_id"): 1,
                      ("stops", "stop_lat"): 1, ("stops", "stop_lon"): 1, ("calendar", "start_date"): 1}
    texts = {r._corrupt_record for r in f.rejects.where("table_name = 'stop_times'").collect()}
    assert "4,T1,,,S1,more,values" in texts and "x,T1,08:00:00,08:00:00,S1" in texts and len(texts) == 5
    assert all(r.file.endswith(f"{r.table_name}.txt") for r in f.rejects.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_line_breaks_across_splits(spark, tmp_path, seed):
    """Random records with breaks, quotes and commas, read in tiny splits, equal the csv module's."""
    rng = random.Random(seed)
    rows = [[f"S{i}", "".join(rng.choice(['a', ' ', ',', '"', '\n', '\r\n', 'é', '\n\n']) for _ in range(rng.randint(0, 12))) or None, str(i % 90), "1"] for i in range(400)]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    w.writerow(["stop_id", "stop_name", "stop_lat", "stop_lon"])
    w.writerows(rows)
    folder = feed(tmp_path, stops=out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        f = gl.read_feed(spark, folder)
        got = {r.stop_id: r.stop_name for r in f.tables["stops"].collect()}
        assert gl._lines(spark, f"{folder}/stops.txt").select("block").distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def plain(x):
        # A line break inside a value: the carriage return of a line end is not kept.
        return None if x is None else x.replace("\r\n", "\n")
    assert got == {r[0]: plain(r[1]) for r in rows}
    assert f.rejects.count() == 0


def test_unbalanced_quote_is_rejected_line_by_line(spark, tmp_path):
    lines = ["stop_id,stop_name,stop_lat,stop_lon"] + [f"S{i},n{i},1,2" for i in range(3000)]
    lines[1500] = 'S1499,"open,1,2'
    f = gl.read_feed(spark, feed(tmp_path, stops="\n".join(lines) + "\n"))
    got = {r.stop_id for r in f.tables["stops"].collect()}
    bad = f.rejects.collect()
    assert {f"S{i}" for i in range(3000)} - got == {"S1499"} and len(bad) == 1 and bad[0]._corrupt_record == lines[1500]


def test_round_trip_and_empty(spark, tmp_path):
    t = {"stops": spark.createDataFrame([("S1", 'q"uote,\nbreak', 1.5, 2.5, None), ("S2", None, None, None, "")], "stop_id string, stop_name string, stop_lat double, stop_lon double, zone_id string")}
    gl.write_gtfs(t, str(tmp_path))
    back = gl.load_gtfs(spark, str(tmp_path), require_dependencies=False)["stops"].select("stop_id", "stop_name", "stop_lat", "stop_lon", "zone_id")
    assert sorted(map(tuple, back.collect())) == [("S1", 'q"uote,\nbreak', 1.5, 2.5, None), ("S2", None, None, None, None)]
    (tmp_path / "e").mkdir()
    f = gl.read_feed(spark, feed(tmp_path / "e", agency="", routes="route_id\n"), require_dependencies=False)
    assert f.tables["agency"].count() == 0 and f.tables["routes"].count() == 0
    assert gl.read_feed(spark, str(tmp_path / "none"), require_dependencies=False).rejects.count() == 0
    assert f.tables["stops"].where(F.col("stop_id") == "S1").count() == 1


def test_a_record_is_parsed_once(spark, tmp_path):
    """No filter parses the text again for each of its conditions."""
    f = gl.read_feed(spark, feed(tmp_path, stop_times="trip_id,arrival_time,stop_id,stop_sequence\r\nT1,08:00:00,S1,1\r\nT1,8 am,S1,2\r\nT1,08:00:15\r,S1,x\r\n"))
    for df in (f.tables["stop_times"], f.rejects.where("table_name = 'stop_times'")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv") == 1
    assert [(r.trip_id, r.arrival_seconds, r.stop_sequence) for r in f.tables["stop_times"].collect()] == [("T1", 28800, 1)]
    assert sorted(tuple(r.bad_columns) for r in f.rejects.collect()) == [("arrival_time",), ("stop_sequence",)]


def _orphan_tables(spark):
    trips = spark.createDataFrame([(f"T{i % 900}" if i % 50 else None, "C1") for i in range(1000)], "trip_id string, service_id string")
    times = spark.createDataFrame([(f"T{i % 1100}" if i % 7 else None,) for i in range(3000)], "trip_id string")
    calendar = spark.createDataFrame([("C1",), ("C1",), (None,)], "service_id string")
    return {"trips": trips, "stop_times": times, "calendar": calendar}


def test_many_keys_are_joined_in_tasks_of_bounded_size(spark, monkeypatch):
    known = {f"T{i % 900}" for i in range(1000) if i % 50}
    want = {"trips.service_id->calendar.service_id": 0, "stop_times.trip_id->trips.trip_id": sum(1 for i in range(3000) if i % 7 and f"T{i % 1100}" not in known)}
    monkeypatch.setattr(gl, "BROADCAST_KEYS", 100)
    monkeypatch.setattr(gl, "ROWS_PER_TASK", 400)
    got = gl.orphan_report(_orphan_tables(spark))
    rows = 980 + sum(1 for i in range(3000) if i % 7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {-(-rows // 400)}), ") == 2 and "REPARTITION_BY_NUM" in plan and "BroadcastHashJoin" in plan
    assert {r.relation: r.orphan_rows for r in got.collect()} == want
    monkeypatch.undo()
    assert {r.relation: r.orphan_rows for r in gl.orphan_report(_orphan_tables(spark)).collect()} == want
