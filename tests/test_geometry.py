"""Geodesic kernel values, projection by the line tree against walking every piece."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise import fixtures as fx
from stopwise.functions import geodesic as geo
from stopwise.operators import trips as tp
from stopwise.operators.lines import METRICS, Line

from .conftest import SF_SMALL


@pytest.mark.parametrize("p,expect", [
    ((0.0, 0.0, 1.0, 0.0), 110574.3886),      # one degree of latitude at the equator
    ((0.0, 0.0, 0.0, 1.0), 111319.4908),      # one degree of longitude at the equator
    ((59.0, 18.0, 60.0, 18.0), 111403.7343),  # one degree of latitude at 59 N
    ((59.3, 18.1, 59.3, 18.1), 0.0),          # zero distance
    ((-33.9, 151.2, -33.9, 151.2001), 9.2497),  # southern hemisphere, ~10 m
])
def test_inverse_known_values(p, expect):
    s, _ = geo.inverse([p[0]], [p[1]], [p[2]], [p[3]])
    assert abs(s[0] - expect) < 1e-3


def test_direct_inverse_round_trip():
    rng = np.random.default_rng(3)
    lat, lon = rng.uniform(-60, 60, 500), rng.uniform(-170, 170, 500)
    az, d = rng.uniform(-180, 180, 500), rng.uniform(0, 50000, 500)
    la, lo = geo.direct(lat, lon, az, d)
    s, a = geo.inverse(lat, lon, la, lo)
    assert np.max(np.abs(s - d)) < 1e-6


def pieces(lat, lon, step):
    """The densified line's pieces one by one: what the reference walks along."""
    d, _ = geo.inverse(lat[:-1], lon[:-1], lat[1:], lon[1:])
    p = [(lat[0], lon[0])]
    for i in range(len(d)):
        if d[i] > step > 0:
            t = np.arange(1, int(np.floor(d[i] / step)) + 1) * step / d[i]
            p += [(lat[i] + (lat[i + 1] - lat[i]) * x, lon[i] + (lon[i + 1] - lon[i]) * x) for x in t if x < 1]
        p.append((lat[i + 1], lon[i + 1]))
    p = np.array(p)
    s, az = geo.inverse(p[:-1, 0], p[:-1, 1], p[1:, 0], p[1:, 1])
    keep = s != 0
    return p[:-1][keep], p[1:][keep], s[keep], az[keep], (np.cumsum(s) - s)[keep]


def walk(lat, lon, line_lat, line_lon, step):
    """Every point against every piece; of scores within a micrometre the first wins."""
    a, b, length, az, before = pieces(line_lat, line_lon, step)
    out = []
    for y, x in zip(lat, lon, strict=True):
        py, px = np.full(len(a), y), np.full(len(a), x)
        along = length * np.clip(geo.inverse(a[:, 0], a[:, 1], py, px)[0] / length, 0.0, 1.0)
        score = geo.inverse(*geo.direct(a[:, 0], a[:, 1], az, along), py, px)[0]
        lost = np.isnan(score)
        score[lost] = geo.inverse(b[lost, 0], b[lost, 1], py[lost], px[lost])[0]
        k = int(np.argmax(score <= score.min() + 1e-6))
        out.append(before[k] + along[k])
    return np.array(out)


@pytest.mark.parametrize("seed", range(12))
def test_line_tree_equals_walking_every_piece(seed):
    rng = np.random.default_rng(seed)
    for step in (10.0, 25.0, 400.0, 0.0):
        m, scale, base = int(rng.integers(2, 30)), [0.0005, 0.005, 0.05][seed % 3], [59.3, 0.0, -45.0, 80.0][seed % 4]
        la, lo = base + np.cumsum(rng.normal(0, scale, m)), 18 + np.cumsum(rng.normal(0, scale * 2, m))
        if seed % 3 == 0:      # the line passes the same place twice: first piece wins
            la[-2:], lo[-2:] = la[:2], lo[:2]
        if seed % 2 == 0:
            la[1], lo[1] = la[0], lo[0]                                    # a segment of no length
        n = 25
        pla, plo = rng.choice(la, n) + rng.normal(0, 1, n) * scale * rng.choice([0.0, 0.01, 0.3, 3.0], n), rng.choice(lo, n) + rng.normal(0, 1, n) * scale * rng.choice([0.0, 0.01, 0.3, 3.0], n)
        got = Line(la, lo, step).project(pla, plo)
        assert np.abs(got - walk(pla, plo, la, lo, step)).max() < 1e-3


def test_piece_lengths_add_up_to_the_densified_line(spark):
    """Totals and starts of segments equal those of densify, then segments."""
    pts = fx.shapes(spark, SF_SMALL).select(F.col("shape_id").alias("line_id"),
                                            F.col("shape_pt_sequence").cast("long").alias("pt_order"), "lat", "lon")
    extra = spark.createDataFrame([("dup", 0, 59.0, 18.0), ("dup", 1, 59.0, 18.0), ("dup", 2, 59.001, 18.0), ("far", 0, 10.0, 10.0), ("far", 1, 11.0, 11.0),
                                   ("one", 0, 59.0, 18.0)], "line_id string, pt_order long, lat double, lon double")
    pts = pts.unionByName(extra)
    rows = tp.shape_segments(tp.densify_polyline(pts, 10.0)).groupBy("line_id").agg(F.sum("seg_len").alias("n"), F.count(F.lit(1)).alias("k")).collect()
    lines = {r.line_id: Line(r.line_lat, r.line_lon, 10.0).lines for r in tp.line_table(pts).collect()}
    assert lines["one"].n == 0 and {r.line_id for r in rows} == set(lines) - {"one"}
    for r in rows:
        assert abs(lines[r.line_id].total.sum() - r.n) < 1e-4 and lines[r.line_id].pieces.sum() == r.k


def test_empty_and_single_point_lines_and_missing_coordinates():
    assert Line([], [], 10.0).project([59.0], [18.0]).tolist() == [0.0]
    assert Line([59.0], [18.0], 10.0).project([59.0], [18.0]).tolist() == [0.0]
    assert Line([59.0, 59.1], [18.0, 18.0], 10.0).project([np.nan, 59.0], [18.0, 18.0]).tolist() == [0.0, 0.0]
    assert Line([59.0, 59.1], [18.0, 18.0], 10.0).project([], []).tolist() == []


@pytest.mark.parametrize("metric", ["wgs84", "planar"])
def test_lines_prepared_together_equal_lines_alone(metric):
    rng = np.random.default_rng(5)
    size = np.array([0, 1, 7, 2, 1, 40, 3, 2, 0, 16])
    la, lo = 59 + rng.normal(0, 0.01, size.sum()), 18 + rng.normal(0, 0.01, size.sum())
    first = np.concatenate([[0], np.cumsum(size)])
    which = rng.integers(-1, len(size), 500)
    y, x = 59 + rng.normal(0, 0.02, 500), 18 + rng.normal(0, 0.02, 500)
    got = METRICS[metric](la, lo, first, 10.0).project(y, x, which)
    for k in range(-1, len(size)):
        alone = Line(la[first[k]: first[k + 1]], lo[first[k]: first[k + 1]], 10.0, metric).project(y[which == k], x[which == k]) if k >= 0 else 0.0
        assert (got[which == k] == alone).all()


def test_projection_across_batches(spark):
    """Lines and points cut anywhere by Arrow batches; points on unknown and null lines get 0.0; extra columns stay."""
    rng = np.random.default_rng(2)
    lines = [(f"L{k}", i, 59 + k / 10 + i / 100, 18 + float(rng.normal(0, 0.01))) for k in range(9) for i in range(k)]
    pts = [(f"L{rng.integers(0, 11)}" if i % 13 else None, i, 59 + float(rng.uniform(0, 1)), 18 + float(rng.normal(0, 0.01)), "x") for i in range(600)]
    lt = tp.line_table(spark.createDataFrame(lines, "line_id string, pt_order long, lat double, lon double"))
    df = spark.createDataFrame(pts, "line_id string, seq long, lat double, lon double, line_lat string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.seq: r.s_now for r in tp.project_along(df.drop("line_lat"), lt, block_on="seq", block_size=20).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 600
    for name, seq, y, x, _ in pts:
        mine = [(a, b) for n, _, a, b in lines if n == name]
        assert got[seq] == (Line([a for a, _ in mine], [b for _, b in mine], 10.0).project([y], [x])[0] if len(mine) > 1 else 0.0)


def test_long_lines_are_not_walked():
    """A line of 600 km has 60,000 pieces; a thousand points look at a few of them each."""
    la, lo = np.linspace(55, 60, 40), 12 + np.sin(np.arange(40)) * 0.3
    line = Line(la, lo, 10.0)
    assert line.lines.pieces.sum() > 60_000
    rng = np.random.default_rng(1)
    y, x = rng.uniform(55, 60, 1000), rng.uniform(11, 13, 1000)
    began = time.perf_counter()
    got = line.project(y, x)
    assert time.perf_counter() - began < 2.0
    assert np.abs(got[:15] - walk(y[:15], x[:15], la, lo, 10.0)).max() < 1e-3


def test_trips_without_stops_keep_their_schedule(spark):
    trips = spark.createDataFrame([("T1", None), ("T2", None)], "trip_id string, shape_id string")
    none = spark.createDataFrame([], "shape_id string, shape_pt_sequence int, lat double, lon double")
    st = spark.createDataFrame([("T1", "S1", 1)], "trip_id string, stop_id string, stop_sequence int")
    sp = spark.createDataFrame([("S1", 59.0, 18.0)], "stop_id string, stop_lat double, stop_lon double")
    sched = spark.createDataFrame([("T2", 5000)], "trip_id string, sched_start_ms long")
    rt, _, _ = tp.trip_runtime(trips, none, st, sp, sched)
    got = {r.trip_id: (r.stop_ids, r.sched_start_ms) for r in rt.collect()}
    assert got == {"T1": (["S1"], -1), "T2": ([], 5000)}


def test_samples_are_made_once(spark):
    """The detector's scans read stored samples, not the events and their projection again and again."""
    from stopwise.plans import geo_queries as gq

    from .conftest import SF_SMALL
    found = gq.events_from_positions(spark, SF_SMALL, "planar")
    assert not [f for f in found.inputFiles() if "events" in f]
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0
