"""Streaming queries, run to completion over landing folders derived from the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import arrivals as ar
from ..operators import ingest as ing
from ..session import cut_lineage
from ..sources import feed as fd
from ..streaming import runner
from ..streaming.arrivals_stream import Projection, stream_arrivals
from ..streaming.dedup_stream import dedup_snapshots_stream, dedup_vehicle_ts_stream
from ..streaming.ingest_job import ingest_stream
from ..streaming.positions_stream import stream_arrivals_from_positions, trip_table
from . import geo_queries as gq
from .arrival_queries import DETECT_SQL, KEYS, ON, TOLERANCE, _inputs
from .ingest_queries import _ENT, _KEPT, _KEY, _RECORD, NOW_S
from .ingest_queries import _sql as _ing_sql
from .oracle import with_fx
from .registry import register

BATCHES = 4


@register("stream_arrivals", DETECT_SQL)
def q_stream_arrivals(spark, sf_dir):
    """fx:sample_progress as four ordered micro-batches, with a restart after each;
    must equal ``detect_arrivals`` row for row. The runtime is stored once for all starts."""
    samples, rt = _inputs(spark, sf_dir)
    rt = cut_lineage(rt)
    root = runner.run_dir(spark, "stream_arrivals")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    samples = runner.staged(samples, root)
    for p in range(BATCHES):
        runner.append_in_order(samples, src, "seq", BATCHES, range(p, p + 1))
        stream = runner.read_files(spark, src, samples.schema)
        runner.run_available_now(stream_arrivals(stream, rt, KEYS, on=ON, tolerance_m=TOLERANCE), out, ckpt)
    return spark.read.parquet(out).select(*KEYS, "seq", "stop_id", "stop_sequence", "arrival_time_millis")


# --- streaming de-duplication: must equal the batch operators -----------------------------------------


@register("stream_dedup_snapshots", _ing_sql("SELECT feed, snapshot_no, header_ts FROM kept", "snaps", "nz", "kept"))
def q_stream_dedup_snapshots(spark, sf_dir):
    root = runner.run_dir(spark, "stream_snapshots")
    snaps = runner.staged(ing.snapshots_of(fx.feed_entities(spark, sf_dir)), root)
    for p in range(BATCHES):  # a restart from the checkpoint after each range
        runner.append_in_order(snaps, f"{root}/in", "snapshot_no", BATCHES, range(p, p + 1))
        runner.run_available_now(dedup_snapshots_stream(runner.read_files(spark, f"{root}/in", snaps.schema)),
                                 f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("stream_dedup_vehicle_ts", _ing_sql(f"SELECT {_ENT} FROM d", "snaps", "nz", "kept", "f", "el", "d"))
def q_stream_dedup_vehicle_ts(spark, sf_dir):
    e = fx.feed_entities(spark, sf_dir)
    f = ing.filter_vehicle_entities(ing.keep_snapshots(e, ing.dedup_snapshots(ing.snapshots_of(e)))).drop("has_vehicle")
    root = runner.run_dir(spark, "stream_vehicle_ts")
    f = runner.staged(f, root)
    for p in range(BATCHES):  # a restart from the checkpoint after each range
        runner.append_in_order(f, f"{root}/in", "snapshot_no", BATCHES, range(p, p + 1))
        runner.run_available_now(dedup_vehicle_ts_stream(runner.read_files(spark, f"{root}/in", f.schema)),
                                 f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


# --- the whole ingest as one streaming query ------------------------------------------------------------


@register("stream_ingest_positions", with_fx(f"SELECT snapshot_no, entity_idx, {_KEY}, {_RECORD} FROM d",
                                             "fx_feed_entities", extra=_KEPT))
def q_stream_ingest_positions(spark, sf_dir):
    """Encoded snapshots (derived from fx:feed_entities) streamed in four ordered micro-batches,
    with a restart after each, through the whole ingest; must equal the batch
    ``ingest_positions``."""
    root = runner.run_dir(spark, "stream_ingest")
    snaps = runner.staged(fd.encode_snapshots(fx.feed_entities(spark, sf_dir)), root)
    for p in range(BATCHES):  # a restart from the checkpoint after each range
        runner.append_in_order(snaps, f"{root}/in", "snapshot_no", BATCHES, range(p, p + 1))
        stream = runner.read_files(spark, f"{root}/in", snaps.schema)
        runner.run_available_now(ingest_stream(stream, NOW_S), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


# --- raw positions to arrivals, streaming ------------------------------------------------------------


def _stream_positions(spark, sf_dir, metric="wgs84"):
    rt, _, lines = gq.runtime(spark, sf_dir, metric)
    trips = cut_lineage(trip_table(rt, lines))
    how = Projection(gq.STEP_M, metric, gq.DIGITS if metric == "wgs84" else None)
    root = runner.run_dir(spark, "stream_positions")
    samples = runner.staged(gq._samples(spark, sf_dir), root)
    for p in range(BATCHES):  # a restart from the checkpoint after each range
        runner.append_in_order(samples, f"{root}/in", "seq", BATCHES, range(p, p + 1))
        stream = runner.read_files(spark, f"{root}/in", samples.schema)
        runner.run_available_now(stream_arrivals_from_positions(stream, trips, projection=how), f"{root}/out", f"{root}/ckpt")
    return ar.arrival_events(spark.read.parquet(f"{root}/out"))


@register("stream_arrivals_from_positions", gq.EVENTS_SQL)
def q_stream_arrivals_from_positions(spark, sf_dir):
    """fx:positions as ordered micro-batches through projection and the keyed-state detector;
    equals the batch ``arrivals_from_positions``."""
    return _stream_positions(spark, sf_dir)


@register("stream_arrivals_from_positions_planar", gq.PLANAR_EVENTS_SQL)
def q_stream_arrivals_from_positions_planar(spark, sf_dir):
    """The planar variant of the streaming raw-positions path."""
    return _stream_positions(spark, sf_dir, "planar")


@register("stream_arrivals_seeded", gq.EVENTS_SQL)
def q_stream_arrivals_seeded(spark, sf_dir):
    """The first half of fx:positions by the batch detector, the second by a stream that starts from the batch's
    ``vehicle_state``; together they are the arrivals of the whole."""
    built = gq.runtime(spark, sf_dir)
    rt, _, lines = built
    root = runner.run_dir(spark, "stream_seeded")
    samples = runner.staged(gq._samples(spark, sf_dir), root)
    middle = samples.agg(F.floor(F.avg("seq"))).scalar()
    keys = ["agency", "vehicle_id", "trip_id"]
    along = gq.samples_on_lines(spark, sf_dir, built).select(*keys, "s_now", "ts_ms", "seq").where(F.col("seq") <= middle)
    early = cut_lineage(along)
    state = ar.vehicle_state(early, rt.drop("line_id"), keys, on=["trip_id"])
    late = samples.where(F.col("seq") > middle)
    trips = cut_lineage(trip_table(rt, lines))
    for p in range(2):
        runner.append_in_order(late, f"{root}/in", "seq", 2, range(p, p + 1))
        stream = runner.read_files(spark, f"{root}/in", late.schema)
        a = stream_arrivals_from_positions(stream, trips, projection=Projection(gq.STEP_M, "wgs84", gq.DIGITS), initial=state)
        runner.run_available_now(a, f"{root}/out", f"{root}/ckpt")
    first = ar.detect_arrivals(early, rt.drop("line_id"), keys, on=["trip_id"])
    return ar.arrival_events(first.unionByName(spark.read.parquet(f"{root}/out").select(*first.columns)))
