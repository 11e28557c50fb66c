"""Keyed state by the bucket: few state calls, results of the fold key by key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from stopwise.streaming.arrivals_stream import ArrivalProcessor, Projection, fold_key
from stopwise.streaming.dedup_stream import VehicleTsDedup
from stopwise.streaming.latest_stream import LatestInEventTime

STATIC = T.StructType([T.StructField("stop_ids", T.ArrayType(T.StringType())), T.StructField("stop_seqs", T.ArrayType(T.IntegerType())),
                       T.StructField("stop_s", T.ArrayType(T.DoubleType())), T.StructField("stop_m", T.ArrayType(T.DoubleType())),
                       T.StructField("sched_start_ms", T.LongType()), T.StructField("line_lat", T.ArrayType(T.DoubleType())),
                       T.StructField("line_lon", T.ArrayType(T.DoubleType()))])


class Held:
    """Handle, value and list state of one grouping key; counts its calls."""

    def __init__(self):
        self.value, self.values, self.calls, self.timers = None, [], 0, set()

    def getValueState(self, name, schema):
        return self

    def getListState(self, name, schema):
        out = Held()
        out.get = lambda: iter(out.values)
        return out

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def appendValue(self, value):
        self.values.append(value)

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("projection", [None, Projection(10.0, "planar"), Projection(10.0, "wgs84", 3)])
def test_a_bucket_folds_its_keys(projection, monkeypatch):
    from stopwise.operators.lines import Line
    from stopwise.operators.trips import to_digits
    from stopwise.streaming import arrivals_stream
    monkeypatch.setattr(arrivals_stream, "LINE_POINTS", 9)      # several runs of lines
    rng = np.random.default_rng(3)
    keys = [(None if i == 0 else f"V{i}", f"T{i % 7}") for i in range(40)]
    proc, handle = ArrivalProcessor(["vehicle_id", "trip_id"], STATIC, projection=projection), Held()
    proc.init(handle)
    scale = 1000.0 if projection is None or projection.metric == "wgs84" else 0.01
    told = [None if i % 5 == 4 else (["A", "B"], [1, 2], [0.2 * scale, 0.6 * scale], [0.2 * scale, 0.6 * scale], None if i % 2 else 0,
                                     None if i % 11 == 3 else [59.0, 59.0 + 0.005 + i / 1e4, 59.01], None if i % 11 == 3 else [18.0, 18.005, 18.01]) for i in range(40)]
    state, want, got = {}, [], []
    for batch in range(3):
        n = 300
        which = rng.integers(0, 40, n)
        rows = pd.DataFrame({"vehicle_id": pd.Series([keys[w][0] for w in which], dtype=object), "trip_id": [keys[w][1] for w in which], "from_timetable": False,
                             "seq": rng.permutation(n) + batch * n, "ts_ms": rng.integers(0, 10**6, n), "s_now": rng.uniform(0, 1000, n),
                             "lat": 59.0 + rng.uniform(0, 0.01, n), "lon": 18.0 + rng.uniform(0, 0.01, n)})
        frames = [rows.iloc[:111], rows.iloc[111:]]
        if batch == 0:
            known = [(k, t) for k, t in zip(keys, told) if t is not None]
            more = pd.DataFrame([[*k, True, *t] for k, t in known], columns=["vehicle_id", "trip_id", "from_timetable", *STATIC.names])
            frames.append(pd.concat([rows.iloc[:0], more]).assign(from_timetable=True))
        before = handle.calls
        for out in proc.handleInputRows((0,), iter(frames), None):
            got += [tuple(r) for r in out[["vehicle_id", "trip_id", "seq", "stop_pos", "stop_id", "stop_sequence", "arrival_time_millis"]].itertuples(index=False)]
        assert handle.calls - before == 2                        # not one per key
        for w in np.unique(which):
            mine = rows[which == w].sort_values("seq")
            t = told[w] or (None,) * 7
            s = mine["s_now"].to_numpy()
            if projection:
                s = np.zeros(len(mine)) if t[5] is None else to_digits(
                    Line(np.array(t[5]), np.array(t[6]), projection.step_m, projection.metric).project(mine["lat"].to_numpy(), mine["lon"].to_numpy()), projection.digits)
            res, state[w] = fold_key(state.get(w), s, mine["ts_ms"].to_numpy(), mine["seq"].to_numpy(), np.array(t[2] or []), np.array(t[3] or []), -1 if t[4] is None else t[4])
            e = res["emitted"]
            want += [(*keys[w], mine["seq"].to_numpy()[i], k, t[0][k], t[1][k], a) for i, k, a in zip(res["i"][e], res["k"][e], res["arrival"][e])]
    assert want and sorted(map(str, map(_plain, got))) == sorted(map(str, map(_plain, want)))


def _plain(row):
    return tuple(x.item() if isinstance(x, np.generic) else x for x in row)


def test_vehicle_times_are_compared_within_their_vehicle():
    proc, handle = VehicleTsDedup(), Held()
    proc.init(handle)

    def run(rows):
        pdf = pd.DataFrame(rows, columns=["feed", "snapshot_no", "entity_idx", "vehicle_id", "entity_ts"])
        return sorted((r.vehicle_id, r.snapshot_no, r.entity_ts) for out in proc.handleInputRows((0,), iter([pdf]), None) for r in out.itertuples())
    assert run([("f", 2, 0, "a", 5), ("f", 1, 0, "a", 5), ("f", 1, 1, "b", 5), (None, 1, 2, "a", 5), ("f", 3, 0, "a", 6)]) == [("a", 1, 5), ("a", 1, 5), ("a", 3, 6), ("b", 1, 5)]
    assert run([("f", 4, 0, "a", 6), ("f", 4, 1, "b", 7), ("f", 5, 0, "a", 5)]) == [("a", 5, 5), ("b", 4, 7)]
    assert handle.calls == 4


def test_a_bucket_expires_each_entry_at_its_own_time():
    proc, handle = LatestInEventTime(100), Held()
    proc.init(handle)

    def run(rows):
        return sorted(tuple(r) for out in proc.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["cache_key", "ts_ms"])]), None) for r in out.itertuples(index=False))
    assert run([("a", 10), ("b", 50), ("a", 300), (None, 20)]) == [("a", 10, 110)]
    assert handle.timers == {120}
    assert run([("b", 40), ("b", 150)]) == [] and handle.timers == {120}       # 40 is older than what is there
    gone = [tuple(r) for out in proc.handleExpiredTimer((0,), Clock(250), None) for r in out.itertuples(index=False)]
    assert sorted(gone, key=str) == [("b", 150, 250), (None, 20, 120)] and 400 in handle.timers
    gone = [tuple(r) for out in proc.handleExpiredTimer((0,), Clock(400), None) for r in out.itertuples(index=False)]
    assert gone == [("a", 300, 400)] and proc._held() == {}
