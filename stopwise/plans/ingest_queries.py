"""Ingest queries over fx:feed_entities and fx:positions (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.timecols import local_time_columns, local_time_sql
from ..operators import ingest as ing
from .oracle import with_fx
from .registry import register

# Fixed value for repeatable runs: the "now" used when neither entity nor header has a ts
# (2025-01-01T00:00:00Z, in seconds).
NOW_S = 1735689600

_KEPT = {
    "snaps": "SELECT DISTINCT feed, snapshot_no, header_ts FROM fx_feed_entities",
    "nz": ("SELECT feed, snapshot_no, header_ts, lag(header_ts) OVER (PARTITION BY feed ORDER BY snapshot_no) AS prev "
           "FROM snaps WHERE header_ts > 0"),
    "kept": ("SELECT s.* FROM snaps s WHERE NOT EXISTS (SELECT 1 FROM nz WHERE nz.feed = s.feed "
             "AND nz.snapshot_no = s.snapshot_no AND nz.prev = nz.header_ts)"),
    "f": ("SELECT e.* FROM fx_feed_entities e JOIN kept k ON e.feed = k.feed AND e.snapshot_no = k.snapshot_no "
          "WHERE e.has_vehicle AND e.lat IS NOT NULL AND e.lon IS NOT NULL"),
    "el": ("SELECT *, lag(entity_ts) OVER (PARTITION BY feed, vehicle_id ORDER BY snapshot_no, entity_idx) AS prev_ts "
           "FROM f WHERE vehicle_id IS NOT NULL AND entity_ts IS NOT NULL"),
    "d": ("SELECT feed, snapshot_no, header_ts, entity_idx, entity_id, vehicle_id, entity_ts, lat, lon, trip_id FROM el "
          "WHERE prev_ts IS NULL OR prev_ts <> entity_ts UNION ALL "
          "SELECT feed, snapshot_no, header_ts, entity_idx, entity_id, vehicle_id, entity_ts, lat, lon, trip_id FROM f "
          "WHERE vehicle_id IS NULL OR entity_ts IS NULL"),
}


def _sql(body, *ctes):
    return with_fx(body, "fx_feed_entities", extra={k: _KEPT[k] for k in ctes})


_ENT = "feed, snapshot_no, header_ts, entity_idx, entity_id, vehicle_id, entity_ts, lat, lon, trip_id"
_TS = f"COALESCE(CASE WHEN entity_ts > 0 THEN entity_ts END, CASE WHEN header_ts > 0 THEN header_ts END, {NOW_S})"
_RECORD = (f"'{ing.FEED_AGENCY}' AS agency, COALESCE(vehicle_id, '') AS vehicle_id, COALESCE(trip_id, '') AS trip_id, "
           "CAST(CAST(lat AS FLOAT) AS DOUBLE) AS latitude, CAST(CAST(lon AS FLOAT) AS DOUBLE) AS longitude, "
           f"CAST({_TS} * 1000 AS BIGINT) AS ts_ms, {local_time_sql(f'{_TS} * 1000')}")
_KEY = f"feed || '|' || COALESCE(vehicle_id, entity_id, 'unknown') || '|' || CAST({_TS} AS VARCHAR) AS record_key"


def _entities(spark, sf_dir):
    return fx.feed_entities(spark, sf_dir)


@register("filter_vehicle_entities", with_fx(
    f"SELECT {_ENT} FROM fx_feed_entities WHERE has_vehicle AND lat IS NOT NULL AND lon IS NOT NULL", "fx_feed_entities"))
def q_filter_vehicle_entities(spark, sf_dir):
    return ing.filter_vehicle_entities(_entities(spark, sf_dir)).drop("has_vehicle")


@register("dedup_snapshots", _sql("SELECT feed, snapshot_no, header_ts FROM kept", "snaps", "nz", "kept"))
def q_dedup_snapshots(spark, sf_dir):
    return ing.dedup_snapshots(ing.snapshots_of(_entities(spark, sf_dir)))


@register("dedup_vehicle_ts", _sql(f"SELECT {_ENT} FROM d", "snaps", "nz", "kept", "f", "el", "d"))
def q_dedup_vehicle_ts(spark, sf_dir):
    e = _entities(spark, sf_dir)
    kept = ing.dedup_snapshots(ing.snapshots_of(e))
    f = ing.filter_vehicle_entities(ing.keep_snapshots(e, kept))
    return ing.dedup_vehicle_ts(f).drop("has_vehicle")


@register("effective_ts", with_fx(f"SELECT entity_id, CAST({_TS} AS BIGINT) AS ts_s FROM fx_feed_entities",
                                  "fx_feed_entities"))
def q_effective_ts(spark, sf_dir):
    e = _entities(spark, sf_dir)
    return e.select("entity_id", ing.effective_ts(F.col("entity_ts"), F.col("header_ts"), F.lit(NOW_S)).alias("ts_s"))


@register("record_key", with_fx(f"SELECT entity_id, {_KEY} FROM fx_feed_entities", "fx_feed_entities"))
def q_record_key(spark, sf_dir):
    e = _entities(spark, sf_dir)
    ts = ing.effective_ts(F.col("entity_ts"), F.col("header_ts"), F.lit(NOW_S))
    return e.select("entity_id", ing.record_key(F.col("feed"), F.col("vehicle_id"), F.col("entity_id"), ts)
                    .alias("record_key"))


@register("local_time_columns", with_fx(f"SELECT seq, ts_ms, {local_time_sql('ts_ms')} FROM fx_positions",
                                        "fx_positions"))
def q_local_time_columns(spark, sf_dir):
    p = fx.positions(spark, sf_dir)
    return p.select("seq", "ts_ms", *local_time_columns(F.col("ts_ms")))


@register("position_record", with_fx(f"SELECT entity_id, {_KEY}, {_RECORD} FROM fx_feed_entities "
                                     "WHERE lat IS NOT NULL", "fx_feed_entities"))
def q_position_record(spark, sf_dir):
    e = _entities(spark, sf_dir).where(F.col("lat").isNotNull())
    return ing.position_record(e, now_s=NOW_S, keep=("entity_id",))


@register("ingest_positions", _sql(f"SELECT snapshot_no, entity_idx, {_KEY}, {_RECORD} FROM d",
                                   "snaps", "nz", "kept", "f", "el", "d"))
def q_ingest_positions(spark, sf_dir):
    return ing.ingest_positions(_entities(spark, sf_dir), now_s=NOW_S)


_POS = "agency, NULLIF(vehicle_id, '') AS vehicle_id, NULLIF(trip_id, '') AS trip_id, latitude, longitude, ts_ms, seq"


@register("blank_to_null", with_fx(f"SELECT {_POS} FROM fx_positions", "fx_positions"))
def q_blank_to_null(spark, sf_dir):
    return ing.blank_to_null(fx.positions(spark, sf_dir))


@register("vehicle_key", with_fx(
    "SELECT agency, vehicle_id, trip_id, count(*) AS samples, min(seq) AS first_seq, max(seq) AS last_seq "
    f"FROM (SELECT {_POS} FROM fx_positions) p GROUP BY agency, vehicle_id, trip_id", "fx_positions"))
def q_vehicle_key(spark, sf_dir):
    return ing.vehicle_key(ing.blank_to_null(fx.positions(spark, sf_dir)))


@register("require_trip", with_fx(f"SELECT {_POS} FROM fx_positions WHERE trip_id IS NOT NULL AND trip_id <> ''",
                                  "fx_positions"))
def q_require_trip(spark, sf_dir):
    return ing.blank_to_null(ing.require_trip(fx.positions(spark, sf_dir)))
