"""Arrival-detection queries over fx:sample_progress, fx:stop_progress and fx:sample_schedule.

Every key (vehicle_id, trip_no, trip_id) runs along its own trip's stops; every third trip has
a schedule, and stops count as passed within a tolerance.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.timecols import local_time_sql
from ..operators import arrivals as ar
from ..operators import trips as tp
from .oracle import with_fx
from .registry import register

KEYS = ["vehicle_id", "trip_no", "trip_id"]
ON = ["trip_id"]
TOLERANCE = 25.0
# Fixed value: agency of the position feed, used as the event's agency.
FEED_AGENCY = "SL"


def _inputs(spark, sf_dir):
    samples = fx.sample_progress(spark, sf_dir)
    wanted = samples.select("trip_id").distinct()
    st = fx.stop_progress(spark, sf_dir).join(wanted, "trip_id", "left_semi")
    return samples, tp.runtime_of_trips(wanted, st, fx.sample_schedule(spark, sf_dir))


# --- oracle building blocks -------------------------------------------------------------
_W = "PARTITION BY vehicle_id, trip_no, trip_id ORDER BY seq"
_ANCHOR = "sched >= 0 AND sched <= ts_ms AND ts_ms - sched <= 1800000"
_T = f"CAST({TOLERANCE} AS DOUBLE)"
_CTE = {
    "stops": ("SELECT trip_id, stop_id, stop_sequence, stop_s, "
              "max(stop_s) OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m, "
              "row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id) - 1 AS stop_pos FROM fx_stop_progress"),
    "s": (f"SELECT x.*, row_number() OVER ({_W}) AS row_no, coalesce(sched_start_ms, -1) AS sched, "
          f"greatest(0.0, max(s_now) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS progress, "
          f"CASE WHEN row_number() OVER ({_W}) = 1 THEN NULL ELSE greatest(0.0, max(s_now) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END AS progress_prev, "
          f"lag(ts_ms) OVER ({_W}) AS ts_prev FROM fx_sample_progress x LEFT JOIN fx_sample_schedule USING (trip_id)"),
    "a": (f"SELECT *, CASE WHEN row_no > 1 THEN progress_prev WHEN {_ANCHOR} THEN 0.0 ELSE s_now END AS s_prev, "
          f"CASE WHEN row_no > 1 THEN ts_prev WHEN {_ANCHOR} THEN sched ELSE ts_ms END AS t1 FROM s"),
    "p": ("SELECT a.*, stops.stop_id, stops.stop_sequence, stops.stop_s, stops.stop_pos, "
          f"NOT (stops.stop_s + {_T} < least(a.s_prev, a.s_now)) AS emitted, "
          "CASE WHEN abs(a.s_now - a.s_prev) < 1e-6 THEN a.ts_ms ELSE a.t1 + CAST(floor(least(greatest((stops.stop_s - a.s_prev) / (a.s_now - a.s_prev), 0.0), 1.0) * (a.ts_ms - a.t1) + 0.5) AS BIGINT) END AS arrival_time_millis "
          f"FROM a JOIN stops ON stops.trip_id = a.trip_id AND stops.m <= a.progress + {_T} AND NOT (a.row_no > 1 AND stops.m <= a.progress_prev + {_T})"),
}


_FX = ("fx_stop_times", "fx_sample_progress", "fx_stop_progress", "fx_sample_schedule")


def _sql(body: str, upto: str) -> str:
    order = ["stops", "s", "a", "p"]
    extra = {k: _CTE[k] for k in order[: order.index(upto) + 1]}
    return with_fx(body, *_FX, extra=extra)


@register("vehicle_progress", _sql("SELECT vehicle_id, trip_no, trip_id, seq, progress FROM s", "s"))
def q_vehicle_progress(spark, sf_dir):
    samples, _ = _inputs(spark, sf_dir)
    return ar.vehicle_progress(samples, KEYS).select(*KEYS, "seq", "progress")


@register("previous_anchor", _sql("SELECT vehicle_id, trip_no, trip_id, seq, s_prev, t1 FROM a", "a"))
def q_previous_anchor(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    d = ar.attach_runtime(ar.vehicle_progress(samples, KEYS), rt, ON)
    return ar.previous_anchor(d).select(*KEYS, "seq", "s_prev", "t1")


@register("next_stop_index", _sql(
    f"SELECT vehicle_id, trip_no, s.trip_id, seq, CAST(count(stops.m) AS INTEGER) AS next_stop_idx FROM s LEFT JOIN stops "
    f"ON stops.trip_id = s.trip_id AND stops.m <= s.progress + {_T} GROUP BY vehicle_id, trip_no, s.trip_id, seq", "s"))
def q_next_stop_index(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    d = ar.consumed_range(ar.attach_runtime(ar.vehicle_progress(samples, KEYS), rt, ON), TOLERANCE)
    return d.select(*KEYS, "seq", "next_stop_idx")


@register("stop_passages", _sql(
    "SELECT vehicle_id, trip_no, trip_id, seq, CAST(stop_pos AS INTEGER) AS stop_pos, stop_id, emitted FROM p", "p"))
def q_stop_passages(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    return ar.stop_passages(samples, rt, KEYS, on=ON, tolerance_m=TOLERANCE).select(*KEYS, "seq", "stop_pos", "stop_id", "emitted")


@register("arrival_time", _sql(
    "SELECT vehicle_id, trip_no, trip_id, seq, stop_id, arrival_time_millis FROM p WHERE emitted", "p"))
def q_arrival_time(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    p = ar.stop_passages(samples, rt, KEYS, on=ON, tolerance_m=TOLERANCE).where("emitted")
    return p.select(*KEYS, "seq", "stop_id", "arrival_time_millis")


DETECT_SQL = _sql("SELECT vehicle_id, trip_no, trip_id, seq, stop_id, stop_sequence, arrival_time_millis FROM p WHERE emitted", "p")


@register("detect_arrivals", DETECT_SQL)
def q_detect_arrivals(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    return ar.detect_arrivals(samples, rt, KEYS, on=ON, tolerance_m=TOLERANCE).select(
        *KEYS, "seq", "stop_id", "stop_sequence", "arrival_time_millis")


@register("vehicle_state", with_fx(
    "SELECT vehicle_id, trip_no, g.trip_id, progress, CAST(count(stops.m) AS INTEGER) AS next_stop_idx, last_ts_ms "
    "FROM (SELECT vehicle_id, trip_no, trip_id, greatest(0.0, max(s_now)) AS progress, arg_max(ts_ms, seq) AS last_ts_ms "
    "FROM fx_sample_progress GROUP BY vehicle_id, trip_no, trip_id) g LEFT JOIN stops ON stops.trip_id = g.trip_id "
    f"AND stops.m <= g.progress + {_T} GROUP BY vehicle_id, trip_no, g.trip_id, progress, last_ts_ms",
    *_FX, extra={"stops": _CTE["stops"]}))
def q_vehicle_state(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    return ar.vehicle_state(samples, rt, KEYS, on=ON, tolerance_m=TOLERANCE)


@register("arrival_events", _sql(
    f"SELECT '{FEED_AGENCY}' AS agency, vehicle_id, trip_id, stop_id, stop_sequence, "
    f"arrival_time_millis, {local_time_sql('arrival_time_millis', 'arrival_time_local', 'arrival_date', 'arrival_prev_date')} "
    "FROM p WHERE emitted", "p"))
def q_arrival_events(spark, sf_dir):
    samples, rt = _inputs(spark, sf_dir)
    a = ar.detect_arrivals(samples, rt, KEYS, on=ON, tolerance_m=TOLERANCE)
    return ar.arrival_events(a, agency=F.lit(FEED_AGENCY))
