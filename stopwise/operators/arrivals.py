"""Batch stop-arrival detection as windows plus an array lookup, no per-row Python.

For one vehicle key, in arrival order (``seq``), let ``s_i`` be the distance along the
trip line, ``P_i = max(0, s_0..s_i)`` the progress, ``stop_k`` the stop distances in stop
order and ``M_k = max(stop_0..stop_k)``. The one-sample-at-a-time loop of the
detector is equivalent to:

* stop k is consumed by the first sample i with ``M_k <= P_i + tol``; as M is
  non-decreasing the stops consumed by sample i are the index range
  ``[count(M <= P_{i-1} + tol), count(M <= P_i + tol))`` (lower bound 0 for i = 0);
* it is emitted unless ``stop_k + tol < min(sPrev_i, s_i)``;
* its time is interpolated between the previous anchor ``(sPrev, t1)`` and ``(s_i, t2)``.

Precondition: ``s_i >= 0`` (distances along a line are) and one trip per key.

The running maxima come from :func:`stopwise.functions.scan.ordered_prefix`, which keeps a
hot key spread over many tasks. Each sample is joined once to its trip's stop arrays
(one row per trip), so the work per sample is the stop count of its trip and no
candidate pairs are materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import with_scalars
from ..functions.scan import BLOCK, DEFAULT_BLOCK, KEY, ordered_prefix
from ..functions.timecols import BUSINESS_ZONE, local_time_columns

# Detector defaults.
DENSIFY_STEP_M = 10.0
TOLERANCE_M = 0.0
MAX_SCHEDULE_ANCHOR_GAP_MS = 1_800_000
SAME_POSITION_EPS = 1e-6


def validate_config(densify_step_m: float = DENSIFY_STEP_M, tolerance_m: float = TOLERANCE_M,
                    max_anchor_gap_ms: int = MAX_SCHEDULE_ANCHOR_GAP_MS) -> None:
    if not densify_step_m > 0:
        raise ValueError("densify_step_m must be > 0")
    if not tolerance_m >= 0:
        raise ValueError("tolerance_m must be >= 0")
    if not max_anchor_gap_ms > 0:
        raise ValueError("max_anchor_gap_ms must be > 0")


def stop_runtime(stops: DataFrame, by: Sequence[str], *, stop_id: str = "stop_id",
                 stop_sequence: str = "stop_sequence", stop_s: str = "stop_s",
                 schedule_start: str | None = None) -> DataFrame:
    """One row per trip (``by``) with its stops as arrays sorted by (sequence, id).

    Columns: ``by``, ``stop_ids``, ``stop_seqs``, ``stop_s``, ``stop_m`` (running max of
    stop_s) and ``sched_start_ms`` (-1 when unknown). A trip's stop list is bounded by
    its timetable, so the per-trip collect is small.
    """
    entry = F.struct(F.col(stop_sequence).alias("q"), F.col(stop_id).cast("string").alias("id"),
                     F.col(stop_s).cast("double").alias("s"))
    aggs = [F.sort_array(F.collect_list(entry)).alias("_st")]
    if schedule_start:
        aggs.append(F.max(schedule_start).alias("_sched"))
    grouped = stops.groupBy(*by).agg(*aggs) if by else stops.agg(*aggs)
    s_arr = F.transform("_st", lambda e: e["s"])
    out = grouped.select(
        *by,
        F.transform("_st", lambda e: e["id"]).alias("stop_ids"),
        F.transform("_st", lambda e: e["q"]).alias("stop_seqs"),
        s_arr.alias("stop_s"),
        F.transform(s_arr, lambda x, i: F.array_max(F.slice(s_arr, 1, i + 1))).alias("stop_m"),
        (F.coalesce(F.col("_sched"), F.lit(-1)) if schedule_start else F.lit(-1)).cast("long").alias("sched_start_ms"),
    )
    return out


def vehicle_progress(samples: DataFrame, keys: Sequence[str], *, seq: str = "seq", s_col: str = "s_now",
                     ts_col: str = "ts_ms", block_size: int = DEFAULT_BLOCK, with_blocks: bool = False):
    """Add ``progress`` (P_i), ``progress_prev`` (P_{i-1}, null for the first sample),
    ``ts_prev`` (previous sample's ts) and ``row_no``. ``seq`` is the broker offset (dense). ``with_blocks`` keeps the (key, block)
    columns and also returns the blocks (see :func:`ordered_prefix`)."""
    res = ordered_prefix(samples, keys, seq, max_of=[s_col], lag_of=[ts_col], block_size=block_size,
                         keep_key=with_blocks, with_blocks=with_blocks, dense=True)
    d, blocks = res if with_blocks else (res, None)
    first = F.col("row_no") == 1
    d = (d.withColumn("progress", F.greatest(F.lit(0.0), F.col(f"{s_col}_run_max")))
          .withColumn("progress_prev", F.when(first, F.lit(None).cast("double"))
                      .otherwise(F.greatest(F.lit(0.0), F.col(f"{s_col}_prev_max"))))
          .withColumnRenamed(f"{ts_col}_prev", "ts_prev")
          .drop(f"{s_col}_run_max", f"{s_col}_prev_max"))
    return (d, blocks) if with_blocks else d


def previous_anchor(df: DataFrame, *, s_col: str = "s_now", ts_col: str = "ts_ms",
                    sched_col: str = "sched_start_ms",
                    max_anchor_gap_ms: int = MAX_SCHEDULE_ANCHOR_GAP_MS) -> DataFrame:
    """``s_prev``/``t1``: previous progress and previous sample ts; for a first sample the
    scheduled start when it lies in [0, t2] within the gap limit (distance 0), else itself."""
    t2 = F.col(ts_col)
    sched = F.coalesce(F.col(sched_col), F.lit(-1)) if sched_col in df.columns else F.lit(-1)
    has_prev = F.col("row_no") > 1
    anchor = (sched >= 0) & (sched <= t2) & ((t2 - sched) <= F.lit(max_anchor_gap_ms))
    return (df.withColumn("s_prev", F.when(has_prev, F.col("progress_prev"))
                          .when(anchor, F.lit(0.0)).otherwise(F.col(s_col).cast("double")))
              .withColumn("t1", F.when(has_prev, F.col("ts_prev")).when(anchor, sched).otherwise(t2).cast("long")))


def attach_runtime(samples: DataFrame, runtime: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join each sample to its trip's stop arrays (left join: unknown trip = no stops).

    With ``on`` empty the runtime must be a single row (a global aggregate, so the bound
    is proven); it is attached as a scalar subquery, evaluated once, with no join.
    """
    if on:
        return samples.join(runtime, list(on), "left")
    return with_scalars(samples, runtime)


def attach_runtime_by_block(d: DataFrame, blocks: DataFrame, runtime: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join samples to their trip's stop arrays along the (key, block) partitioning they
    already have: the runtime is first expanded to the few (key, block) groups that need
    it (one row per block, from the scan's summary), so only that small side is shuffled.
    ``on`` must be part of the key."""
    kb = blocks.select(KEY, BLOCK, *[F.col(f"{KEY}.{c}").alias(c) for c in on])
    rt = kb.join(runtime, list(on), "inner").drop(*on)
    return d.join(rt, [KEY, BLOCK], "left").drop(KEY, BLOCK)


def _count_le(arr: str, bound: Column) -> Column:
    return F.coalesce(F.size(F.filter(arr, lambda m: m <= bound)), F.lit(0))


def consumed_range(df: DataFrame, tolerance_m: float = TOLERANCE_M) -> DataFrame:
    """``lo``/``next_stop_idx``: the stop index range consumed by each sample."""
    tol = F.lit(float(tolerance_m))
    hi = F.when(F.col("stop_m").isNull(), F.lit(0)).otherwise(_count_le("stop_m", F.col("progress") + tol))
    lo = F.when(F.col("row_no") == 1, F.lit(0)).otherwise(_count_le("stop_m", F.col("progress_prev") + tol))
    return df.withColumn("lo", lo.cast("int")).withColumn("next_stop_idx", hi.cast("int"))


def arrival_time(stop_s: Column, s_now: Column, s_prev: Column, t1: Column, t2: Column) -> Column:
    """Interpolated arrival ms; rounding is half-up (floor(x + 0.5)), as Java's Math.round."""
    ds = s_now - s_prev
    frac = F.least(F.greatest((stop_s - s_prev) / ds, F.lit(0.0)), F.lit(1.0))
    return F.when(F.abs(ds) < F.lit(SAME_POSITION_EPS), t2).otherwise(
        t1 + F.floor(frac * (t2 - t1) + F.lit(0.5))).cast("long")


def stop_passages(samples: DataFrame, runtime: DataFrame, keys: Sequence[str], *, on: Sequence[str] = (),
                  seq: str = "seq", s_col: str = "s_now", ts_col: str = "ts_ms",
                  tolerance_m: float = TOLERANCE_M, max_anchor_gap_ms: int = MAX_SCHEDULE_ANCHOR_GAP_MS,
                  block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Every consumed stop, one row per (sample, stop): ``stop_pos`` (0-based index),
    ``stop_id``, ``stop_sequence``, ``stop_s``, ``emitted`` and ``arrival_time_millis``."""
    validate_config(tolerance_m=tolerance_m, max_anchor_gap_ms=max_anchor_gap_ms)
    if on and set(on) <= set(keys):
        # the trip is part of the key: join along the (key, block) partitioning, no reshuffle
        d, blocks = vehicle_progress(samples, keys, seq=seq, s_col=s_col, ts_col=ts_col, block_size=block_size,
                                     with_blocks=True)
        d = attach_runtime_by_block(d, blocks, runtime, on)
    else:
        d = vehicle_progress(samples, keys, seq=seq, s_col=s_col, ts_col=ts_col, block_size=block_size)
        d = attach_runtime(d, runtime, on)
    d = previous_anchor(d, s_col=s_col, ts_col=ts_col, max_anchor_gap_ms=max_anchor_gap_ms)
    d = consumed_range(d, tolerance_m)
    d = d.where(F.col("next_stop_idx") > F.col("lo"))
    d = d.withColumn("stop_pos", F.explode(F.sequence(F.col("lo"), F.col("next_stop_idx") - 1)))
    k = F.col("stop_pos")
    stop_s = F.col("stop_s")[k]
    s_now = F.col(s_col).cast("double")
    emitted = ~((stop_s + F.lit(float(tolerance_m))) < F.least(F.col("s_prev"), s_now))
    return d.select(
        *keys, *[c for c in on if c not in keys], seq, ts_col, "stop_pos",
        F.col("stop_ids")[k].alias("stop_id"),
        F.col("stop_seqs")[k].alias("stop_sequence"),
        stop_s.alias("stop_s"),
        emitted.alias("emitted"),
        arrival_time(stop_s, s_now, F.col("s_prev"), F.col("t1"), F.col(ts_col)).alias("arrival_time_millis"),
    )


def detect_arrivals(samples: DataFrame, runtime: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """Emitted arrivals: keys, stop id/sequence, arrival millis (plus the sample ``seq``)."""
    seq = kw.get("seq", "seq")
    p = stop_passages(samples, runtime, keys, **kw).where(F.col("emitted"))
    on = [c for c in kw.get("on", ()) if c not in keys]
    return p.select(*keys, *on, seq, "stop_pos", "stop_id", "stop_sequence", "arrival_time_millis")


def vehicle_state(samples: DataFrame, runtime: DataFrame, keys: Sequence[str], *, on: Sequence[str] = (),
                  seq: str = "seq", s_col: str = "s_now", ts_col: str = "ts_ms",
                  tolerance_m: float = TOLERANCE_M) -> DataFrame:
    """Latest (progress, next stop index, last ts) per key; last means last in ``seq`` order.

    A plain aggregate (map-side partial, so a hot key costs nothing extra), then one
    lookup of the trip's stop arrays per key.
    """
    agg_on = [c for c in on if c not in keys]
    st = samples.groupBy(*keys, *agg_on).agg(
        F.greatest(F.lit(0.0), F.max(F.col(s_col).cast("double"))).alias("progress"),
        F.max_by(ts_col, seq).alias("last_ts_ms"),
        F.count(F.lit(1)).alias("samples"))
    st = attach_runtime(st, runtime, on)
    nxt = F.when(F.col("stop_m").isNull(), F.lit(0)).otherwise(
        _count_le("stop_m", F.col("progress") + F.lit(float(tolerance_m))))
    return st.select(*keys, *agg_on, "progress", nxt.cast("int").alias("next_stop_idx"), "last_ts_ms")


def arrival_events(arrivals: DataFrame, *, agency: Column | None = None, vehicle_id: str = "vehicle_id",
                   trip_id: str = "trip_id", zone: str = BUSINESS_ZONE) -> DataFrame:
    """The 12-column stop-arrival event."""
    ms = F.col("arrival_time_millis")
    return arrivals.select(
        (agency if agency is not None else F.col("agency")).alias("agency"),
        F.col(vehicle_id).cast("string").alias("vehicle_id"),
        F.col(trip_id).cast("string").alias("trip_id"),
        F.col("stop_id").cast("string").alias("stop_id"),
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        ms.cast("long").alias("arrival_time_millis"),
        *local_time_columns(ms, zone, prefix="arrival_time_local", date_name="arrival_date",
                            prev_date_name="arrival_prev_date"),
    )
