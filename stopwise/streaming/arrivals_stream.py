"""Continuous stop-arrival detection with keyed state (Structured Streaming).

``transformWithStateInPandas`` over buckets of keys (:mod:`.buckets`): per (agency, vehicle, trip) key two things
survive micro-batches and restarts (RocksDB state store + checkpoint): the vehicle's
(progress, next stop index, last ts), and what the timetable says of its trip (stop arrays, scheduled
start, the line's points). The timetable part travels once per key: the first row of a key passes a keyed
de-dup, meets the static table in a stream-static join and goes to the key's state; the samples
themselves stay narrow. A new ``version`` of the timetable sends each key's part again.

Inside a micro-batch a key's rows are sorted by ``seq`` and the
closed form of :mod:`stopwise.operators.arrivals` is applied starting from the stored
state, so the stream emits exactly what the batch detector emits, provided ``seq``
does not go backwards between micro-batches of one key. ``initial`` starts a stream from
the batch's ``vehicle_state``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.arrivals import MAX_SCHEDULE_ANCHOR_GAP_MS, SAME_POSITION_EPS, TOLERANCE_M, attach_runtime
from ..operators.lines import METRICS
from ..operators.trips import to_digits
from .buckets import BUCKET, PACKED, ListColumns, groups, key_tuples, pack, unpack, with_text_keys

STATE_SCHEMA = T.StructType([T.StructField("progress", T.DoubleType()), T.StructField("next_idx", T.IntegerType()),
                             T.StructField("last_ts", T.LongType())])


def fold_key(state: tuple | None, s: np.ndarray, t: np.ndarray, seq: np.ndarray, stop_s: np.ndarray,
             stop_m: np.ndarray, sched: int, tol: float = TOLERANCE_M,
             max_gap: int = MAX_SCHEDULE_ANCHOR_GAP_MS) -> tuple[dict, tuple]:
    """Arrivals of one key's samples (already in seq order) from ``state``.

    Returns (columns of the consumed stops: sample index ``i``, stop index ``k``, ``emitted``,
    ``arrival``) and the new state (progress, next_idx, last_ts).
    """
    n = len(s)
    p0, k0, t0 = state if state is not None else (0.0, 0, -1)
    has = t0 >= 0
    P = np.maximum(p0, np.maximum.accumulate(s))
    prevP = np.concatenate([[p0], P[:-1]])
    has_prev = np.concatenate([[has], np.ones(n - 1, dtype=bool)])
    prev_t = np.concatenate([[t0], t[:-1]]).astype(np.int64)
    anchor = (~has_prev) & (sched >= 0) & (sched <= t) & ((t - sched) <= max_gap)
    s_prev = np.where(has_prev, prevP, np.where(anchor, 0.0, s))
    t1 = np.where(has_prev, prev_t, np.where(anchor, sched, t)).astype(np.int64)
    if len(stop_m):
        hi = np.maximum(np.searchsorted(stop_m, P + tol, side="right"), k0)
    else:
        hi = np.full(n, k0, dtype=np.int64)
    lo = np.concatenate([[k0], hi[:-1]])
    cnt = np.maximum(hi - lo, 0)
    i = np.repeat(np.arange(n), cnt)
    starts = np.cumsum(cnt) - cnt
    k = (np.arange(cnt.sum()) - np.repeat(starts, cnt) + np.repeat(lo, cnt)).astype(np.int64)
    st = stop_s[k] if len(k) else np.zeros(0)
    sp, sn, tt, tt1 = s_prev[i], s[i], t[i], t1[i]
    emitted = ~((st + tol) < np.minimum(sp, sn))
    ds = sn - sp
    with np.errstate(divide="ignore", invalid="ignore"):
        frac = np.clip((st - sp) / ds, 0.0, 1.0)
        interp = tt1 + np.floor(frac * (tt - tt1).astype(np.float64) + 0.5).astype(np.int64)
    arrival = np.where(np.abs(ds) < SAME_POSITION_EPS, tt, interp)
    new_state = (float(P[-1]), int(hi[-1]), int(t[-1]))
    return {"i": i, "k": k, "emitted": emitted, "arrival": arrival}, new_state


#: What the timetable says of a trip, as far as the static table has it.
STATIC = ("stop_ids", "stop_seqs", "stop_s", "stop_m", "sched_start_ms", "line_lat", "line_lon")
#: Lines are prepared together up to so many points.
LINE_POINTS = 20_000


@dataclass(frozen=True)
class Projection:
    """How raw positions (``lat``, ``lon``) become distances along the key's line."""
    step_m: float = 10.0
    metric: str = "wgs84"
    digits: int | None = None


def _along(p: Projection, trips: Sequence[dict], at: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Distances along their trips' lines of consecutive groups of points (``at``: where each group begins, and the end); 0.0 without a line."""
    codes: dict[tuple, int] = {}
    lines, of = [], np.full(len(trips), -1, np.int64)
    for j, trip in enumerate(trips):
        if trip["line_lat"] is not None and trip["line_lon"] is not None and len(trip["line_lat"]) >= 2:
            line = tuple(np.asarray(trip[c], np.float64) for c in ("line_lat", "line_lon"))
            of[j] = codes.setdefault(tuple(x.tobytes() for x in line), len(codes))
            if of[j] == len(lines):
                lines.append(line)
    line = np.repeat(of, np.diff(at))
    order = np.argsort(line, kind="stable")
    out = np.zeros(len(lat))
    ends = np.cumsum([0] + [len(x[0]) for x in lines])
    i = 0
    while i < len(lines):                             # a run of lines, and the points on them
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + LINE_POINTS, side="right")) - 1)
        mine = order[np.searchsorted(line[order], i): np.searchsorted(line[order], j)]
        some = METRICS[p.metric](*(np.concatenate(c) for c in zip(*lines[i:j], strict=True)), ends[i:j + 1] - ends[i], p.step_m)
        out[mine] = to_digits(some.project(lat[mine], lon[mine], line[mine] - i), p.digits)
        i = j
    return out


class ArrivalProcessor(StatefulProcessor):
    """State handler of a bucket of keys; the key columns come first in the output, as strings."""

    def __init__(self, keys: Sequence[str], static: T.StructType, seq: str = "seq", s_col: str = "s_now", ts_col: str = "ts_ms",
                 tolerance_m: float = TOLERANCE_M, max_anchor_gap_ms: int = MAX_SCHEDULE_ANCHOR_GAP_MS, projection: Projection | None = None):
        self.keys, self.static, self.seq, self.s_col, self.ts_col = list(keys), static, seq, s_col, ts_col
        self.tol, self.max_gap, self.projection = tolerance_m, max_anchor_gap_ms, projection

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.vehicles = handle.getValueState("vehicles", PACKED)
        self.trips = handle.getListState("trips", PACKED)      # one table per micro-batch that told of trips

    def _schema(self, fields: T.StructType) -> pa.Schema:
        return to_arrow_schema(T.StructType([T.StructField(k, T.StringType()) for k in self.keys] + fields.fields))

    def _held(self) -> dict[tuple, tuple]:
        held = self.vehicles.get()
        if held is None:
            return {}
        table = unpack(bytes(held[0]))
        return dict(zip(key_tuples(table[k] for k in self.keys), key_tuples(table[c] for c in STATE_SCHEMA.names), strict=True))

    def _keep(self, held: dict[tuple, tuple]) -> None:
        columns = [*zip(*held)] + [*zip(*held.values())]
        schema = self._schema(STATE_SCHEMA)
        self.vehicles.update((pack(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)),))

    def _timetable(self) -> dict[tuple, tuple[ListColumns, int]]:
        found = {}
        for (rows,) in self.trips.get():
            table = unpack(bytes(rows))
            columns = ListColumns(table, self.static.names)
            found.update({k: (columns, i) for i, k in enumerate(key_tuples(table[k] for k in self.keys))})
        return found

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self._held()
        values = zip(*(initialState[c].tolist() for c in ("progress", "next_stop_idx", "last_ts_ms")), strict=True)
        held.update({k: (float(p), int(i), int(t)) for k, (p, i, t) in zip(key_tuples(initialState[k] for k in self.keys), values, strict=True)})
        self._keep(held)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wanted = ["lat", "lon"] if self.projection else [self.s_col]
        parts, told = [], []
        for pdf in rows:
            known = pdf["from_timetable"].to_numpy(dtype=bool)
            if known.any():
                told.append(pdf.loc[known, [*self.keys, *self.static.names]])
            if not known.all():
                parts.append(pdf.loc[~known, [*self.keys, self.seq, self.ts_col, *wanted]])
        if told:
            schema = self._schema(self.static)
            once = pd.concat(told, ignore_index=True).drop_duplicates(self.keys)
            self.trips.appendValue((pack(pa.Table.from_pandas(once, schema=schema, preserve_index=False)),))
        if not parts:
            return
        seq, ts = (np.concatenate([p[c].to_numpy(np.int64) for p in parts]) for c in (self.seq, self.ts_col))
        values = [np.concatenate([p[c].to_numpy(np.float64) for p in parts]) for c in wanted]
        names, order, at = groups([k for p in parts for k in key_tuples(p[c] for c in self.keys)], seq)
        seq, ts, values = seq[order], ts[order], [v[order] for v in values]
        held, timetable, out = self._held(), self._timetable(), []
        nothing = dict.fromkeys(self.static.names)
        trips = [columns.row(i) if columns else nothing for columns, i in (timetable.get(name, (None, 0)) for name in names)]
        s = _along(self.projection, trips, at, *values) if self.projection else values[0]
        for j, (name, trip) in enumerate(zip(names, trips, strict=True)):
            mine = slice(at[j], at[j + 1])
            out += self._fold(name, held, trip, seq[mine], ts[mine], s[mine])
        self._keep(held)
        if out:
            yield self._arrivals(out)

    def _fold(self, name: tuple, held: dict[tuple, tuple], trip: dict, seq: np.ndarray, ts: np.ndarray, s: np.ndarray) -> list[tuple]:
        """One key's samples: its new state goes to ``held``; (key, order, stop position, id, sequence, arrival) of its arrivals."""
        stop_s, stop_m = (np.asarray(trip[c] if trip[c] is not None else [], dtype=np.float64) for c in ("stop_s", "stop_m"))
        sched = trip["sched_start_ms"]
        res, held[name] = fold_key(held.get(name), s, ts, seq, stop_s, stop_m, -1 if sched is None else int(sched), self.tol, self.max_gap)
        keep = res["emitted"]
        if not keep.any():
            return []
        i, k = res["i"][keep], res["k"][keep]
        return [(name, seq[i], k, trip["stop_ids"][k], np.asarray(trip["stop_seqs"], dtype=np.int64)[k], res["arrival"][keep])]

    def _arrivals(self, found: list[tuple]) -> pd.DataFrame:
        names, seq, k, ids, seqs, arrival = zip(*found, strict=True)
        counts = [len(x) for x in seq]
        out = {}
        for c, column in zip(self.keys, zip(*names), strict=True):
            whole = np.empty(len(column), object)
            whole[:] = column
            out[c] = np.repeat(whole, counts)
        out[self.seq] = np.concatenate(seq)
        out["stop_pos"] = np.concatenate(k).astype(np.int32)
        out["stop_id"] = np.concatenate(ids).astype(object)
        out["stop_sequence"] = np.concatenate(seqs).astype(np.int32)
        out["arrival_time_millis"] = np.concatenate(arrival).astype(np.int64)
        return pd.DataFrame(out)

    def close(self) -> None:
        pass


def output_schema(samples: DataFrame, keys: Sequence[str], seq: str = "seq") -> T.StructType:
    f = {x.name: x for x in samples.schema.fields}
    return T.StructType([T.StructField(k, f[k].dataType) for k in keys] + [
        T.StructField(seq, T.LongType()), T.StructField("stop_pos", T.IntegerType()),
        T.StructField("stop_id", T.StringType()), T.StructField("stop_sequence", T.IntegerType()),
        T.StructField("arrival_time_millis", T.LongType())])


def stream_arrivals(samples: DataFrame, runtime: DataFrame, keys: Sequence[str], *, on: Sequence[str] = (),
                    seq: str = "seq", s_col: str = "s_now", ts_col: str = "ts_ms",
                    tolerance_m: float = TOLERANCE_M,
                    max_anchor_gap_ms: int = MAX_SCHEDULE_ANCHOR_GAP_MS, projection: Projection | None = None,
                    version: str = "1", initial: DataFrame | None = None) -> DataFrame:
    """Streaming arrivals. ``runtime``: the static table, one row per trip (``on``), with the columns of ``STATIC``
    that the stream needs (the line's only with a ``projection``).

    ``initial`` (the columns of the batch ``vehicle_state``) is the state of its keys before the first micro-batch."""
    samples = samples.withColumn("from_timetable", F.lit(False))
    seen = samples.select(*keys, F.lit(version).alias("_version")).dropDuplicates([*keys, "_version"])
    have = {f.name: f.dataType for f in runtime.schema.fields}
    static = T.StructType([T.StructField(c, have[c]) for c in STATIC if c in have])
    told = attach_runtime(seen, runtime, on).select(*keys, F.lit(True).alias("from_timetable"), *static.names)
    values = ["lat", "lon"] if projection else [s_col]
    d = samples.select(*keys, "from_timetable", seq, ts_col, *values).unionByName(told, allowMissingColumns=True)
    proc = ArrivalProcessor(keys, static, seq, s_col, ts_col, tolerance_m, max_anchor_gap_ms, projection)
    schema = output_schema(samples, keys, seq)
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in keys else f.dataType) for f in schema.fields])
    found = with_text_keys(d, keys).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=text, outputMode="Append", timeMode="None",
        initialState=with_text_keys(initial, keys).groupBy(BUCKET) if initial is not None else None)
    return found.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})
