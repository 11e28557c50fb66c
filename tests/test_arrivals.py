"""Batch and streaming arrival detection against a plain one-sample-at-a-time fold."""

import math
import random

import numpy as np
import pytest

from stopwise.operators import arrivals as ar
from stopwise.streaming.arrivals_stream import fold_key


def sequential(samples, stops, sched, tol, max_gap):
    """The detector loop, one sample at a time, state (progress, next index, last ts)."""
    progress, k, last = 0.0, 0, -1
    out = []
    for seq, s_now, t2 in samples:
        if not stops:
            progress, last = max(progress, s_now), t2
            continue
        if last >= 0:
            s_prev, t1 = progress, last
        elif 0 <= sched <= t2 and t2 - sched <= max_gap:
            s_prev, t1 = 0.0, sched
        else:
            s_prev, t1 = s_now, t2
        lo_s, hi_s = min(s_prev, s_now), max(s_prev, s_now)
        while k < len(stops):
            sid, sq, lp = stops[k]
            if lp + tol < lo_s:
                k += 1
                continue
            if lp <= hi_s + tol:
                ds = s_now - s_prev
                if abs(ds) < 1e-6:
                    at = t2
                else:
                    frac = min(max((lp - s_prev) / ds, 0.0), 1.0)
                    at = t1 + math.floor(frac * (t2 - t1) + 0.5)
                out.append((seq, sid, sq, at))
                k += 1
            else:
                break
        progress, last = max(progress, s_now), t2
    return out


def _case(rng, n_stops, n_samples):
    stops = [(f"S{i}", i + 1, float(rng.choice([rng.uniform(0, 3000), i * 250.0]))) for i in range(n_stops)]
    s, t, out = 0.0, 1_700_000_000_000, []
    for j in range(n_samples):
        s = max(0.0, s + rng.uniform(-150, 500))
        t += int(rng.uniform(-3000, 20000))
        out.append((j * 3 + 1, float(rng.choice([s, round(s), s]) ), t))
    return stops, out


@pytest.mark.parametrize("tol,sched_mode", [(0.0, "none"), (25.0, "none"), (0.0, "anchor"), (10.0, "anchor")])
def test_batch_equals_sequential(spark, tol, sched_mode):
    rng = random.Random(11 + int(tol) + len(sched_mode))
    rows, stop_rows, expect = [], [], []
    for trip in range(40):
        stops, samples = _case(rng, rng.randint(0, 9), rng.randint(1, 15))
        sched = -1
        if sched_mode == "anchor":
            sched = samples[0][2] - rng.choice([0, 1_800_000, 1_800_001, 5000, -10])
        tid = f"T{trip}"
        for sid, sq, st in stops:
            stop_rows.append((tid, sid, sq, st, sched))
        for seq, s_now, ts in samples:
            rows.append(("V", tid, seq, s_now, ts))
        for seq, sid, sq, at in sequential(samples, sorted(stops, key=lambda x: x[1]), sched, tol, 1_800_000):
            expect.append(("V", tid, seq, sid, sq, at))
    samples_df = spark.createDataFrame(rows, "vehicle_id string, trip_id string, seq long, s_now double, ts_ms long")
    stops_df = spark.createDataFrame(stop_rows, "trip_id string, stop_id string, stop_sequence int, stop_s double, "
                                                "sched long")
    rt = ar.stop_runtime(stops_df, ["trip_id"], schedule_start="sched")
    got = ar.detect_arrivals(samples_df, rt, ["vehicle_id", "trip_id"], on=["trip_id"], tolerance_m=tol,
                             block_size=4)
    got = sorted(tuple(r) for r in got.select("vehicle_id", "trip_id", "seq", "stop_id", "stop_sequence",
                                              "arrival_time_millis").collect())
    assert got == sorted(expect)


def test_fold_key_resumes_from_state():
    rng = random.Random(5)
    for _ in range(200):
        stops, samples = _case(rng, rng.randint(1, 8), rng.randint(2, 12))
        stops = sorted(stops, key=lambda x: x[1])
        ss = np.array([x[2] for x in stops])
        sm = np.maximum.accumulate(ss)
        s = np.array([x[1] for x in samples]); t = np.array([x[2] for x in samples]); q = np.array([x[0] for x in samples])
        cut = rng.randint(1, len(samples) - 1)
        r1, st1 = fold_key(None, s[:cut], t[:cut], q[:cut], ss, sm, -1)
        r2, _ = fold_key(st1, s[cut:], t[cut:], q[cut:], ss, sm, -1)
        got = [(int(q[:cut][i]), int(k), int(a)) for i, k, e, a in zip(r1["i"], r1["k"], r1["emitted"], r1["arrival"]) if e]
        got += [(int(q[cut:][i]), int(k), int(a)) for i, k, e, a in zip(r2["i"], r2["k"], r2["emitted"], r2["arrival"]) if e]
        want = [(seq, int(sid[1:]), at) for seq, sid, sq, at in sequential(samples, stops, -1, 0.0, 1_800_000)]
        assert got == want


def test_first_sample_past_stops_emits_nothing(spark):
    samples = spark.createDataFrame([("V", "T", 1, 900.0, 1000)], "vehicle_id string, trip_id string, seq long, "
                                                                  "s_now double, ts_ms long")
    stops = spark.createDataFrame([("T", "A", 1, 100.0), ("T", "B", 2, 500.0), ("T", "C", 3, 900.0)],
                                  "trip_id string, stop_id string, stop_sequence int, stop_s double")
    rt = ar.stop_runtime(stops, ["trip_id"])
    got = ar.detect_arrivals(samples, rt, ["vehicle_id", "trip_id"], on=["trip_id"]).collect()
    assert [(r.stop_id, r.arrival_time_millis) for r in got] == [("C", 1000)]


def test_demo_case_runs(spark):
    """The reference's demo (five stops, no shape, schedule start 0): pseudo shape from stops."""
    from stopwise.operators import trips as tp
    stops = [("S1", 55.0000, 37.0000, 1), ("S2", 55.0006, 37.0008, 2), ("S3", 55.0012, 37.0016, 3),
             ("S4", 55.0018, 37.0024, 4), ("S5", 55.0024, 37.0032, 5)]
    samples = [(55.00002, 37.00001, 0), (55.00040, 37.00055, 8000), (55.00145, 37.00190, 15000),
               (55.00188, 37.00245, 20000), (55.00295, 37.00395, 28000), (55.00340, 37.00455, 35000),
               (55.00410, 37.00545, 42000), (55.00535, 37.00705, 55000), (55.00580, 37.00770, 65000)]
    st = spark.createDataFrame([("T1", s[0], s[3]) for s in stops], "trip_id string, stop_id string, stop_sequence int")
    sp = spark.createDataFrame([(s[0], s[1], s[2]) for s in stops], "stop_id string, stop_lat double, stop_lon double")
    trips = spark.createDataFrame([("T1", None)], "trip_id string, shape_id string")
    shapes = spark.createDataFrame([], "shape_id string, shape_pt_sequence int, lat double, lon double")
    sched = spark.createDataFrame([("T1", 0)], "trip_id string, sched_start_ms long")
    rt, lines, segs = tp.trip_runtime(trips, shapes, st, sp, sched, 10.0)
    pos = spark.createDataFrame([("V1", "T1", i, la, lo, ms) for i, (la, lo, ms) in enumerate(samples)],
                                "vehicle_id string, trip_id string, seq long, lat double, lon double, ts_ms long")
    pos = tp.project_along(pos.join(lines, "trip_id"), segs, block_on="seq")
    got = ar.detect_arrivals(pos, rt.drop("line_id"), ["vehicle_id", "trip_id"], on=["trip_id"])
    got = [(r.stop_id, r.arrival_time_millis) for r in got.orderBy("arrival_time_millis", "stop_pos").collect()]
    # Same detector as a scalar fold over the projected distances.
    proj = sorted((r.seq, r.s_now, r.ts_ms) for r in pos.collect())
    r = rt.collect()[0]
    want = sequential(proj, list(zip(r.stop_ids, r.stop_seqs, r.stop_s)), 0, 0.0, 1_800_000)
    assert got == [(w[1], w[3]) for w in want]
    assert [g[0] for g in got] == ["S1", "S2", "S3", "S4", "S5"]
