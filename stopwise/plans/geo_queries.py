"""Geometry and trip-preparation queries (fx:stops, fx:shapes, fx:trips, fx:stop_times)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..session import cut_lineage
from ..functions import geodesic as geo
from ..operators import arrivals as ar
from ..operators import ingest as ing
from ..operators import trips as tp
from ..functions.timecols import local_time_sql
from .oracle import with_fx
from .registry import register

STEP_M = 10.0
SCHED = ("SELECT trip_id, 1704063600000 + min(arrival_seconds) * 1000 AS sched_start_ms FROM fx_stop_times "
         "WHERE CAST(substr(trip_id, 2) AS BIGINT) % 3 = 0 GROUP BY trip_id")


def _sql(body: str, *names: str, extra: dict | None = None, recursive: bool = False) -> str:
    return with_fx(body, *names, extra=extra, recursive=recursive)


# --- geodesic kernel --------------------------------------------------------------------------------

_PAIRS = ("SELECT s.stop_id, s.parent_station, s.stop_lat AS lat1, s.stop_lon AS lon1, p.stop_lat AS lat2, "
          "p.stop_lon AS lon2 FROM fx_stops s JOIN fx_stops p ON p.stop_id = s.parent_station")


@register("geodesic_distance", _sql(
    "SELECT stop_id, parent_station, round(g_s12, 3) AS distance_m, round(g_azi1, 6) AS azimuth_deg FROM g_out",
    "fx_stops", extra={"pairs": _PAIRS, **geo.inverse_sql("pairs", "lat1", "lon1", "lat2", "lon2",
                                                          "stop_id, parent_station")}))
def q_geodesic_distance(spark, sf_dir):
    s = fx.stops(spark, sf_dir)
    p = s.select(F.col("stop_id").alias("parent_station"), F.col("stop_lat").alias("lat2"), F.col("stop_lon").alias("lon2"))
    j = s.join(p, "parent_station").withColumn(
        "g", geo.geodesic_inverse(F.col("stop_lat"), F.col("stop_lon"), F.col("lat2"), F.col("lon2")))
    return j.select("stop_id", "parent_station", F.round("g.s12", 3).alias("distance_m"),
                    F.round("g.azi1", 6).alias("azimuth_deg"))


_DIRECT_SRC = ("SELECT stop_id, stop_lat, stop_lon, CAST(CAST(substr(stop_id, 2) AS BIGINT) * 37 % 360 AS DOUBLE) AS az, "
               "CAST(100 + CAST(substr(stop_id, 2) AS BIGINT) % 50 * 10 AS DOUBLE) AS dist FROM fx_stops")


@register("geodesic_direct", _sql(
    "SELECT stop_id, round(d_lat2, 8) AS lat2, round(d_lon2, 8) AS lon2 FROM d_out", "fx_stops",
    extra={"src": _DIRECT_SRC, **geo.direct_sql("src", "stop_lat", "stop_lon", "az", "dist", "stop_id")}))
def q_geodesic_direct(spark, sf_dir):
    s = fx.stops(spark, sf_dir)
    k = F.substring("stop_id", 2, 20).cast("long")
    d = s.select("stop_id", "stop_lat", "stop_lon", (k * 37 % 360).cast("double").alias("az"),
                 (F.lit(100) + k % 50 * 10).cast("double").alias("dist"))
    d = d.withColumn("g", geo.geodesic_direct(F.col("stop_lat"), F.col("stop_lon"), F.col("az"), F.col("dist")))
    return d.select("stop_id", F.round("g.lat2", 8).alias("lat2"), F.round("g.lon2", 8).alias("lon2"))


# --- densify and segments over fx:shapes ----------------------------------------------------------------

_SEG = ("SELECT shape_id AS line_id, shape_pt_sequence AS a, lat, lon, lead(lat) OVER w AS blat, lead(lon) OVER w AS blon "
        "FROM fx_shapes WINDOW w AS (PARTITION BY shape_id ORDER BY shape_pt_sequence)")
_SEG_G = geo.inverse_sql("seg_src", "lat", "lon", "blat", "blon", "line_id, a, lat, lon, blat, blon")


@register("densify_polyline", _sql(
    "SELECT line_id, CAST(row_number() OVER (PARTITION BY line_id ORDER BY a, kk) - 1 AS BIGINT) AS pt_idx, "
    "round(lat, 9) AS lat, round(lon, 9) AS lon FROM ("
    "SELECT line_id, -1 AS a, 0 AS kk, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY shape_id ORDER BY "
    "shape_pt_sequence) AS rn, shape_id AS line_id FROM fx_shapes) WHERE rn = 1 "
    "UNION ALL SELECT line_id, a, n + 1 AS kk, blat AS lat, blon AS lon FROM segn "
    f"UNION ALL SELECT line_id, a, k AS kk, lat + (blat - lat) * (k * {STEP_M} / g_s12) AS lat, "
    f"lon + (blon - lon) * (k * {STEP_M} / g_s12) AS lon FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM segn "
    f"WHERE n > 0) WHERE k * {STEP_M} / g_s12 < 1.0) x",
    "fx_shapes", extra={"seg_all": _SEG, "seg_src": "SELECT * FROM seg_all WHERE blat IS NOT NULL", **_SEG_G,
                        "segn": (f"SELECT *, CASE WHEN isnan(g_s12) OR g_s12 IS NULL OR g_s12 <= {STEP_M} THEN 0 "
                                 f"ELSE CAST(floor(g_s12 / {STEP_M}) AS INTEGER) END AS n FROM g_out")}))
def q_densify(spark, sf_dir):
    sh = fx.shapes(spark, sf_dir).select(F.col("shape_id").alias("line_id"),
                                         F.col("shape_pt_sequence").cast("long").alias("pt_order"), "lat", "lon")
    d = tp.densify_polyline(sh, STEP_M)
    return d.select("line_id", "pt_idx", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@register("shape_segments", _sql(
    "SELECT line_id, CAST(a AS BIGINT) AS seg_idx, round(g_s12, 3) AS seg_len, round(g_azi1, 6) AS seg_az, "
    "round(COALESCE(sum(g_s12) OVER (PARTITION BY line_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
    "0.0), 3) AS cum_start FROM g_out WHERE g_s12 <> 0.0",
    "fx_shapes", extra={"seg_all": _SEG, "seg_src": "SELECT * FROM seg_all WHERE blat IS NOT NULL", **_SEG_G}))
def q_shape_segments(spark, sf_dir):
    sh = fx.shapes(spark, sf_dir).select(F.col("shape_id").alias("line_id"),
                                         F.col("shape_pt_sequence").cast("long").alias("pt_idx"), "lat", "lon")
    s = tp.shape_segments(sh)
    return s.select("line_id", F.col("seg_idx").cast("long").alias("seg_idx"), F.round("seg_len", 3).alias("seg_len"),
                    F.round("seg_az", 6).alias("seg_az"), F.round("cum_start", 3).alias("cum_start"))


# --- trip lists ---------------------------------------------------------------------------------------

_TS = ("SELECT st.trip_id, CAST(row_number() OVER (PARTITION BY st.trip_id ORDER BY st.stop_sequence, st.stop_id) - 1 "
       "AS INTEGER) AS stop_pos, st.stop_id, st.stop_sequence, s.stop_lat, s.stop_lon FROM fx_stop_times st "
       "JOIN fx_stops s ON s.stop_id = st.stop_id")


@register("trip_stops", _sql("SELECT * FROM ts", "fx_stops", "fx_stop_times", extra={"ts": _TS}))
def q_trip_stops(spark, sf_dir):
    return tp.trip_stops(fx.stop_times(spark, sf_dir), fx.stops(spark, sf_dir))


@register("trip_shape", _sql(
    "SELECT t.trip_id, t.shape_id, CAST(row_number() OVER (PARTITION BY t.trip_id ORDER BY sh.shape_pt_sequence) - 1 "
    "AS INTEGER) AS pt_pos, sh.shape_pt_sequence, sh.lat, sh.lon FROM fx_trips t JOIN fx_shapes sh "
    "ON sh.shape_id = t.shape_id", "fx_trips", "fx_shapes"))
def q_trip_shape(spark, sf_dir):
    return tp.trip_shape(fx.trips(spark, sf_dir), fx.shapes(spark, sf_dir))


@register("pseudo_shape", _sql(
    "SELECT 'trip:' || ts.trip_id AS line_id, ts.trip_id, ts.stop_pos AS pt_pos, ts.stop_lat AS lat, ts.stop_lon AS lon "
    "FROM ts JOIN fx_trips t ON t.trip_id = ts.trip_id WHERE t.shape_id IS NULL OR t.shape_id NOT IN "
    "(SELECT shape_id FROM fx_shapes)", "fx_stops", "fx_stop_times", "fx_trips", "fx_shapes", extra={"ts": _TS}))
def q_pseudo_shape(spark, sf_dir):
    ts = tp.trip_stops(fx.stop_times(spark, sf_dir), fx.stops(spark, sf_dir))
    return tp.pseudo_shape(fx.trips(spark, sf_dir), fx.shapes(spark, sf_dir), ts)


@register("trip_schedule_start", _sql(
    "SELECT t.trip_id, CAST(COALESCE(s.sched_start_ms, -1) AS BIGINT) AS sched_start_ms FROM fx_trips t "
    "LEFT JOIN sched s ON s.trip_id = t.trip_id", "fx_trips", "fx_stop_times", extra={"sched": SCHED}))
def q_trip_schedule_start(spark, sf_dir):
    return tp.trip_schedule_start(fx.trips(spark, sf_dir), fx.schedule(spark, sf_dir))


def _samples(spark, sf_dir):
    return ing.require_trip(ing.blank_to_null(fx.positions(spark, sf_dir)))


DIGITS = 3      # distances along a line in whole millimetres


def runtime(spark, sf_dir, metric="wgs84", samples=None):
    """Trip runtime for the trips that fx:positions (or ``samples``, the same rows stored) ask for, stored (checkpointed to the
    shared folder) as the reference keeps it in memory: computed once, read many times."""
    return tp.trip_runtime(fx.trips(spark, sf_dir), fx.shapes(spark, sf_dir), fx.stop_times(spark, sf_dir),
                           fx.stops(spark, sf_dir), fx.schedule(spark, sf_dir), densify_step_m=STEP_M,
                           for_trips=samples if samples is not None else _samples(spark, sf_dir), materialize=cut_lineage, metric=metric,
                           digits=DIGITS if metric == "wgs84" else None)


# Distances on the ellipsoid as SQL. Pieces are made for every tenth of a kilometre first and, near a point, one by
# one; the pieces before a place are added up by Gauss-Legendre quadrature of the curve's length.
_A2, _E2 = geo.WGS84_A, geo.WGS84_F * (2 - geo.WGS84_F)
_NODES = ", ".join(f"({float(x)!r}, {float(w)!r})" for x, w in zip(*np.polynomial.legendre.leggauss(8), strict=True))
KNOT = 64


def _xyz(lat: str, lon: str) -> str:
    n = f"({_A2!r} / sqrt(1 - {_E2!r} * power(sin(radians({lat})), 2)))"
    return (f"{n} * cos(radians({lat})) * cos(radians({lon})) AS x, {n} * cos(radians({lat})) * sin(radians({lon})) AS y, "
            f"{n} * (1 - {_E2!r}) * sin(radians({lat})) AS z")


def _speed(t: str) -> str:
    phi = f"(radians(a_lat) + ({t}) * radians(b_lat - a_lat))"
    w = f"(1 - {_E2!r} * power(sin({phi}), 2))"
    return (f"sqrt(power({_A2!r} * (1 - {_E2!r}) / ({w} * sqrt({w})) * radians(b_lat - a_lat), 2) "
            f"+ power({_A2!r} / sqrt({w}) * cos({phi}) * radians(b_lon - a_lon), 2))")


def _place(j: str) -> str:
    """Coordinates of the beginning of piece ``j`` (the segment's end for j = n)."""
    t = f"({j}) * {STEP_M} / d"
    return ", ".join(f"CASE WHEN {j} = 0 THEN a_{c} WHEN {j} >= n THEN b_{c} ELSE a_{c} + (b_{c} - a_{c}) * ({t}) END" for c in ("lat", "lon"))


_LINES_SQL = {
    "ts": _TS,
    "samples": ("SELECT agency, NULLIF(vehicle_id, '') AS vehicle_id, trip_id, latitude AS lat, longitude AS lon, "
                "ts_ms, seq FROM fx_positions WHERE trip_id IS NOT NULL AND trip_id <> ''"),
    "lines": ("SELECT t.trip_id, CASE WHEN t.shape_id IN (SELECT shape_id FROM fx_shapes) THEN t.shape_id "
              "ELSE 'trip:' || t.trip_id END AS line_id FROM fx_trips t "
              "WHERE t.trip_id IN (SELECT trip_id FROM samples)"),
    "pts": ("SELECT shape_id AS line_id, CAST(shape_pt_sequence AS BIGINT) AS pt_order, lat, lon FROM fx_shapes "
            "WHERE shape_id IN (SELECT line_id FROM lines) UNION ALL "
            "SELECT l.line_id, CAST(ts.stop_pos AS BIGINT) AS pt_order, ts.stop_lat AS lat, ts.stop_lon AS lon "
            "FROM ts JOIN lines l ON l.trip_id = ts.trip_id WHERE l.line_id LIKE 'trip:%'"),
    "raw": ("SELECT line_id, pt_order AS seg_idx, lat AS a_lat, lon AS a_lon, lead(lat) OVER w AS b_lat, "
            "lead(lon) OVER w AS b_lon FROM pts WINDOW w AS (PARTITION BY line_id ORDER BY pt_order)"),
    "raw2": "SELECT * FROM raw WHERE b_lat IS NOT NULL",
    **geo.inverse_sql("raw2", "a_lat", "a_lon", "b_lat", "b_lon", "line_id, seg_idx, a_lat, a_lon, b_lat, b_lon", "s"),
    "segs": (f"SELECT line_id, seg_idx, a_lat, a_lon, b_lat, b_lon, s_s12 AS d, CASE WHEN s_s12 <= {STEP_M} THEN 1 ELSE CAST(floor(s_s12 / {STEP_M}) AS BIGINT) "
             f"- CASE WHEN floor(s_s12 / {STEP_M}) * {STEP_M} / s_s12 >= 1.0 THEN 1 ELSE 0 END + 1 END AS n FROM s_out WHERE s_s12 > 0"),
    "arcs": (f"SELECT line_id, seg_idx, sum({_speed('(1 + gx) / 2')} * gw) / 2 AS arc FROM segs, (VALUES {_NODES}) g(gx, gw) GROUP BY line_id, seg_idx"),
    "line_segs": ("SELECT segs.*, COALESCE(sum(CASE WHEN n = 1 THEN d ELSE arc END) OVER (PARTITION BY line_id ORDER BY seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cum "
                  "FROM segs JOIN arcs USING (line_id, seg_idx)"),
    "knots": f"SELECT *, {_xyz('k_lat', 'k_lon')} FROM (SELECT line_id, seg_idx, k, {_place('k').replace(' END, ', ' END AS k_lat, ', 1)} AS k_lon "
             f"FROM (SELECT *, unnest(range(0, n, {KNOT})) AS k FROM line_segs) q) q2",
}


def _on_lines(src: str, key: str) -> dict[str, str]:
    """CTEs that project the points of ``src`` (line_id, lat, lon, ``key``) on their lines; the last, ``{src}_best``, has ``s``."""
    p = src
    chord = "sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2) + power(a.z - b.z, 2))"
    return {
        f"{p}_at": f"SELECT DISTINCT line_id, {key}, lat, lon, {_xyz('lat', 'lon')} FROM {src}",
        # Knots that may begin a run of pieces with the nearest one; then its pieces; then those that may score least.
        f"{p}_k": f"SELECT a.line_id, {key}, a.lat AS p_lat, a.lon AS p_lon, a.x AS px, a.y AS py, a.z AS pz, b.seg_idx, b.k, {chord} AS far FROM {p}_at a JOIN knots b ON a.line_id = b.line_id".replace(key, ", ".join(f"a.{c.strip()}" for c in key.split(","))),
        f"{p}_near": f"SELECT * FROM (SELECT *, min(far) OVER (PARTITION BY line_id, {key}) AS least FROM {p}_k) q WHERE far <= least * 1.001 + {KNOT * STEP_M * 1.1 + 40}",
        f"{p}_run": (f"SELECT q.line_id, {key}, p_lat, p_lon, px, py, pz, q.seg_idx, unnest(range(q.k, least(q.k + {KNOT}, n))) AS j, a_lat, a_lon, b_lat, b_lon, d, n, cum "
                     f"FROM {p}_near q JOIN line_segs USING (line_id, seg_idx)"),
        f"{p}_ab": f"SELECT * EXCLUDE (a_lat, a_lon, b_lat, b_lon), a_lat AS s_lat, a_lon AS s_lon, b_lat AS e_lat, b_lon AS e_lon, {_place('j').replace(' END, ', ' END AS a_lat, ', 1)} AS a_lon, "
                   f"{_place('(j + 1)').replace(' END, ', ' END AS b_lat, ', 1)} AS b_lon FROM {p}_run",
        f"{p}_end": f"SELECT * EXCLUDE (x, y, z), sqrt(power(x - px, 2) + power(y - py, 2) + power(z - pz, 2)) AS far FROM (SELECT *, {_xyz('b_lat', 'b_lon')} FROM {p}_ab) q",
        f"{p}_few": (f"SELECT * FROM (SELECT *, min(12660000 * asin(far / 12660000) + CASE WHEN far < 50 THEN 12 ELSE 0.001 END) OVER (PARTITION BY line_id, {key}) AS most FROM {p}_end) q "
                     "WHERE far < 50 OR 13000000 * asin(far / 13000000) <= most + 0.001"),
        **geo.inverse_sql(f"{p}_few", "a_lat", "a_lon", "b_lat", "b_lon", f"line_id, {key}, p_lat, p_lon, seg_idx, j, s_lat, s_lon, e_lat, e_lon, a_lat, a_lon, d, n, cum", f"{p}_i"),
        f"{p}_len": f"SELECT * FROM {p}_i_out WHERE {p}_i_s12 > 0",
        **geo.inverse_sql(f"{p}_len", "a_lat", "a_lon", "p_lat", "p_lon", f"line_id, {key}, p_lat, p_lon, seg_idx, j, s_lat, s_lon, e_lat, e_lon, a_lat, a_lon, d, n, cum, {p}_i_s12, {p}_i_azi1", f"{p}_r"),
        f"{p}_t": f"SELECT *, {p}_i_s12 * least(greatest({p}_r_s12 / {p}_i_s12, 0.0), 1.0) AS along FROM {p}_r_out",
        **geo.direct_sql(f"{p}_t", "a_lat", "a_lon", f"{p}_i_azi1", "along", f"line_id, {key}, p_lat, p_lon, seg_idx, j, s_lat, s_lon, e_lat, e_lon, d, n, cum, along", f"{p}_d"),
        **geo.inverse_sql(f"{p}_d_out", f"{p}_d_lat2", f"{p}_d_lon2", "p_lat", "p_lon", f"line_id, {key}, seg_idx, j, s_lat, s_lon, e_lat, e_lon, d, n, cum, along", f"{p}_c"),
        f"{p}_win": (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id, {key} ORDER BY seg_idx, j) AS rn FROM (SELECT *, min({p}_c_s12) OVER (PARTITION BY line_id, {key}) AS least "
                     f"FROM {p}_c_out) q WHERE {p}_c_s12 <= least + 1e-6) q2 WHERE rn = 1"),
        f"{p}_before": (f"SELECT line_id, {key}, sum({_speed('t * (1 + gx) / 2')} * gw) * any_value(t) / 2 AS arc FROM "
                        f"(SELECT line_id, {key}, s_lat AS a_lat, s_lon AS a_lon, e_lat AS b_lat, e_lon AS b_lon, j * {STEP_M} / d AS t FROM {p}_win) q, (VALUES {_NODES}) g(gx, gw) GROUP BY line_id, {key}"),
        f"{p}_best": f"SELECT line_id, {key}, floor((cum + arc + along) * 1000 + 0.5) / 1000 AS s FROM {p}_win JOIN {p}_before USING (line_id, {key})",
    }


_WGS = dict(_LINES_SQL)
_WGS["sl"] = ("SELECT s.agency, s.vehicle_id, s.trip_id, s.ts_ms, s.seq, COALESCE(l.line_id, '') AS line_id, s.lat, "
              "s.lon FROM samples s LEFT JOIN lines l ON l.trip_id = s.trip_id")
_WGS["stop_pts"] = ("SELECT DISTINCT l.line_id, ts.stop_lat AS lat, ts.stop_lon AS lon, ts.stop_lat AS k_lat, ts.stop_lon AS k_lon FROM ts JOIN lines l "
                    "ON l.trip_id = ts.trip_id")
_ON_SAMPLES, _ON_STOPS = _on_lines("sl", "seq"), _on_lines("stop_pts", "k_lat, k_lon")
_GEO_FX = ("fx_positions", "fx_trips", "fx_shapes", "fx_stop_times", "fx_stops")
_STOPS_S = ("SELECT ts.trip_id, ts.stop_pos, ts.stop_id, ts.stop_sequence, COALESCE(b.s, 0.0) AS stop_s "
            "FROM ts JOIN lines l ON l.trip_id = ts.trip_id LEFT JOIN stop_pts_best b ON b.line_id = l.line_id "
            "AND b.k_lat = ts.stop_lat AND b.k_lon = ts.stop_lon")


@register("trip_runtime", _sql(
    "SELECT s.trip_id, l.line_id, CAST(s.stop_pos AS INTEGER) AS stop_pos, s.stop_id, s.stop_s, "
    "CAST(COALESCE(sc.sched_start_ms, -1) AS BIGINT) AS sched_start_ms FROM lines l "
    "LEFT JOIN stops_s s ON l.trip_id = s.trip_id LEFT JOIN sched sc ON sc.trip_id = s.trip_id".replace("SELECT s.trip_id", "SELECT l.trip_id").replace("sc.trip_id = s.trip_id", "sc.trip_id = l.trip_id"),
    *_GEO_FX, extra={**_WGS, **_ON_STOPS, "stops_s": _STOPS_S, "sched": SCHED}))
def q_trip_runtime(spark, sf_dir):
    """Every sampled trip's stops with their distance along its line; a trip without stops has one row without a stop."""
    rt, _, _ = runtime(spark, sf_dir)
    z = rt.select("trip_id", "line_id", "sched_start_ms",
                  F.posexplode_outer(F.arrays_zip("stop_ids", "stop_s")).alias("stop_pos", "z"))
    return z.select("trip_id", "line_id", "stop_pos", F.col("z.stop_ids").alias("stop_id"), F.col("z.stop_s").alias("stop_s"), "sched_start_ms")


def samples_on_lines(spark, sf_dir, built=None, metric="wgs84", samples=None):
    """fx:positions (or ``samples``, the same rows stored) with ids blanked to null, trip required, projected on their trip's line."""
    _, of_trip, lines = built or runtime(spark, sf_dir, metric, samples)
    p = samples if samples is not None else _samples(spark, sf_dir)
    p = p.join(of_trip, "trip_id", "left").withColumn("line_id", F.coalesce("line_id", F.lit("")))
    p = p.withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lon")
    return tp.project_along(p, lines, step_m=STEP_M, block_on="seq", metric=metric, digits=DIGITS if metric == "wgs84" else None)


@register("project_along", _sql(
    "SELECT sl.seq, sl.trip_id, sl.line_id, COALESCE(b.s, 0.0) AS s_now FROM sl LEFT JOIN sl_best b ON b.seq = sl.seq",
    *_GEO_FX, extra={**{k: v for k, v in _WGS.items() if k != "stop_pts"}, **_ON_SAMPLES}))
def q_project_along(spark, sf_dir):
    """Every sample's distance along its trip's densified line; only the lines are prepared, no stop is projected."""
    samples = _samples(spark, sf_dir)
    wanted = samples.select("trip_id").distinct()
    trips = fx.trips(spark, sf_dir).join(wanted, "trip_id", "left_semi")
    shapes = fx.shapes(spark, sf_dir).join(trips.select("shape_id").where(F.col("shape_id").isNotNull()).distinct(), "shape_id", "left_semi")
    ts = tp.trip_stops(fx.stop_times(spark, sf_dir).join(wanted, "trip_id", "left_semi"), fx.stops(spark, sf_dir))
    built = None, tp.line_of_trip(trips, shapes), tp.line_table(tp.line_points(trips, shapes, ts))
    return samples_on_lines(spark, sf_dir, built).select("seq", "trip_id", "line_id", "s_now")


# --- the projection rule with a planar metric: checkable by SQL ------------------------------------

_PLANAR = {
    "ts": _TS,
    "samples": ("SELECT seq, trip_id, latitude AS lat, longitude AS lon FROM fx_positions "
                "WHERE trip_id IS NOT NULL AND trip_id <> ''"),
    "lines": ("SELECT t.trip_id, CASE WHEN t.shape_id IN (SELECT shape_id FROM fx_shapes) THEN t.shape_id "
              "ELSE 'trip:' || t.trip_id END AS line_id FROM fx_trips t "
              "WHERE t.trip_id IN (SELECT trip_id FROM samples)"),
    "pts": ("SELECT shape_id AS line_id, CAST(shape_pt_sequence AS BIGINT) AS pt_order, lat, lon FROM fx_shapes "
            "WHERE shape_id IN (SELECT line_id FROM lines) UNION ALL "
            "SELECT l.line_id, CAST(ts.stop_pos AS BIGINT) AS pt_order, ts.stop_lat AS lat, ts.stop_lon AS lon "
            "FROM ts JOIN lines l ON l.trip_id = ts.trip_id WHERE l.line_id LIKE 'trip:%'"),
    "seg": ("SELECT line_id, pt_order AS seg_idx, lat AS a_lat, lon AS a_lon, lead(lat) OVER w AS b_lat, "
            "lead(lon) OVER w AS b_lon FROM pts WINDOW w AS (PARTITION BY line_id ORDER BY pt_order)"),
    "seg2": ("SELECT *, sqrt((b_lat - a_lat) * (b_lat - a_lat) + (b_lon - a_lon) * (b_lon - a_lon)) AS dab "
             "FROM seg WHERE b_lat IS NOT NULL"),
    "seg3": ("SELECT *, COALESCE(sum(dab) OVER (PARTITION BY line_id ORDER BY seg_idx ROWS BETWEEN UNBOUNDED "
             "PRECEDING AND 1 PRECEDING), 0.0) AS cum FROM seg2 WHERE dab <> 0.0"),
    "sl": ("SELECT s.seq, s.trip_id, COALESCE(l.line_id, '') AS line_id, s.lat, s.lon FROM samples s "
           "LEFT JOIN lines l ON l.trip_id = s.trip_id"),
    "pairs": ("SELECT sl.seq, g.seg_idx, g.cum, g.dab, g.a_lat, g.a_lon, g.b_lat, g.b_lon, sl.lat AS plat, "
              "sl.lon AS plon, least(greatest(sqrt((sl.lat - g.a_lat) * (sl.lat - g.a_lat) + (sl.lon - g.a_lon) * "
              "(sl.lon - g.a_lon)) / g.dab, 0.0), 1.0) AS t FROM sl JOIN seg3 g ON g.line_id = sl.line_id"),
    "scored": ("SELECT seq, seg_idx, cum + dab * t AS s, sqrt((a_lat + t * (b_lat - a_lat) - plat) * "
               "(a_lat + t * (b_lat - a_lat) - plat) + (a_lon + t * (b_lon - a_lon) - plon) * "
               "(a_lon + t * (b_lon - a_lon) - plon)) AS score FROM pairs"),
    "best": ("SELECT seq, s FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY score, seg_idx) AS rn "
             "FROM scored) x WHERE rn = 1"),
}


@register("project_along_planar", _sql(
    "SELECT sl.seq, sl.trip_id, sl.line_id, round(COALESCE(b.s, 0.0), 6) AS s_now FROM sl LEFT JOIN best b "
    "ON b.seq = sl.seq", "fx_positions", "fx_trips", "fx_shapes", "fx_stop_times", "fx_stops", extra=_PLANAR))
def q_project_along_planar(spark, sf_dir):
    """The projection rule (radial t, first segment wins ties, cumulative start) with planar
    distances on the raw lines of the trips the samples ask for, checked by SQL."""
    samples = _samples(spark, sf_dir)
    wanted = samples.select("trip_id").distinct()
    trips = fx.trips(spark, sf_dir).join(wanted, "trip_id", "left_semi")
    shapes = fx.shapes(spark, sf_dir).join(trips.select("shape_id").where(F.col("shape_id").isNotNull()).distinct(),
                                           "shape_id", "left_semi")
    ts = tp.trip_stops(fx.stop_times(spark, sf_dir).join(wanted, "trip_id", "left_semi"), fx.stops(spark, sf_dir))
    built = None, tp.line_of_trip(trips, shapes), tp.line_table(tp.line_points(trips, shapes, ts))
    out = samples_on_lines(spark, sf_dir, built, "planar")
    return out.select("seq", "trip_id", "line_id", F.round("s_now", 6).alias("s_now"))


# --- raw positions to arrival events: the whole composition, checked by SQL in both metrics -----

_PL2 = {k: _PLANAR[k] for k in ("ts", "samples", "lines", "pts", "seg", "seg2")}
_PL2["samples"] = ("SELECT agency, NULLIF(vehicle_id, '') AS vehicle_id, trip_id, latitude AS lat, longitude AS lon, "
                   "ts_ms, seq FROM fx_positions WHERE trip_id IS NOT NULL AND trip_id <> ''")
_PL2["segn"] = ("SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY seg_idx) AS k FROM seg2 WHERE dab <> 0.0")
# cumulative start as a sequential fold, the order of Spark's running window sum
_PL2["cumr"] = ("SELECT line_id, k, dab, CAST(0.0 AS DOUBLE) AS cum FROM segn WHERE k = 1 UNION ALL "
                "SELECT n.line_id, n.k, n.dab, c.cum + c.dab FROM cumr c JOIN segn n ON n.line_id = c.line_id "
                "AND n.k = c.k + 1")
_PL2["seg3"] = ("SELECT n.line_id, n.seg_idx, n.a_lat, n.a_lon, n.b_lat, n.b_lon, n.dab, c.cum FROM segn n "
                "JOIN cumr c ON c.line_id = n.line_id AND c.k = n.k")
_PL2["sl"] = ("SELECT s.agency, s.vehicle_id, s.trip_id, s.ts_ms, s.seq, COALESCE(l.line_id, '') AS line_id, s.lat, "
              "s.lon FROM samples s LEFT JOIN lines l ON l.trip_id = s.trip_id")
_PL2["stop_pts"] = ("SELECT DISTINCT l.line_id, ts.stop_lat AS lat, ts.stop_lon AS lon FROM ts JOIN lines l "
                    "ON l.trip_id = ts.trip_id")


def _proj(src: str, key: str) -> dict[str, str]:
    """Planar projection CTEs for the points of ``src`` identified by the columns ``key``."""
    return {
        f"{src}_pairs": (f"SELECT {key}, g.seg_idx, g.cum, g.dab, g.a_lat, g.a_lon, g.b_lat, g.b_lon, x.lat AS plat, "
                         "x.lon AS plon, least(greatest(sqrt((x.lat - g.a_lat) * (x.lat - g.a_lat) + (x.lon - g.a_lon) "
                         f"* (x.lon - g.a_lon)) / g.dab, 0.0), 1.0) AS t FROM {src} x JOIN seg3 g "
                         "ON g.line_id = x.line_id"),
        f"{src}_scored": (f"SELECT {key.replace('x.', '')}, seg_idx, cum + dab * t AS s, sqrt((a_lat + t * (b_lat - a_lat) "
                          "- plat) * (a_lat + t * (b_lat - a_lat) - plat) + (a_lon + t * (b_lon - a_lon) - plon) * "
                          f"(a_lon + t * (b_lon - a_lon) - plon)) AS score FROM {src}_pairs"),
        f"{src}_best": (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key.replace('x.', '')} ORDER BY "
                        f"score, seg_idx) AS rn FROM {src}_scored) y WHERE rn = 1"),
    }


_PL2.update(_proj("sl", "x.seq"))
_PL2.update(_proj("stop_pts", "x.line_id, x.lat, x.lon"))
_PL2["stops_s"] = ("SELECT ts.trip_id, ts.stop_pos, ts.stop_id, ts.stop_sequence, COALESCE(b.s, 0.0) AS stop_s "
                   "FROM ts JOIN lines l ON l.trip_id = ts.trip_id LEFT JOIN stop_pts_best b ON b.line_id = l.line_id "
                   "AND b.lat = ts.stop_lat AND b.lon = ts.stop_lon")
_PL2["stops_m"] = ("SELECT *, max(stop_s) OVER (PARTITION BY trip_id ORDER BY stop_pos ROWS BETWEEN UNBOUNDED "
                   "PRECEDING AND CURRENT ROW) AS m FROM stops_s")
_PL2["sched"] = SCHED
_W2 = "PARTITION BY agency, vehicle_id, trip_id ORDER BY seq"
_PL2["smp"] = ("SELECT sl.agency, sl.vehicle_id, sl.trip_id, sl.ts_ms, sl.seq, COALESCE(b.s, 0.0) AS s_now, "
               "COALESCE(sc.sched_start_ms, -1) AS sched FROM sl LEFT JOIN sl_best b ON b.seq = sl.seq "
               "LEFT JOIN sched sc ON sc.trip_id = sl.trip_id")
_PL2["prog"] = (f"SELECT *, row_number() OVER ({_W2}) AS row_no, "
                f"greatest(0.0, max(s_now) OVER ({_W2} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS progress, "
                f"CASE WHEN row_number() OVER ({_W2}) = 1 THEN NULL ELSE greatest(0.0, max(s_now) OVER ({_W2} ROWS "
                f"BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END AS progress_prev, lag(ts_ms) OVER ({_W2}) AS ts_prev "
                "FROM smp")
_ANCHOR = "sched >= 0 AND sched <= ts_ms AND ts_ms - sched <= 1800000"
_PL2["anc"] = (f"SELECT *, CASE WHEN row_no > 1 THEN progress_prev WHEN {_ANCHOR} THEN 0.0 ELSE s_now END AS s_prev, "
               f"CASE WHEN row_no > 1 THEN ts_prev WHEN {_ANCHOR} THEN sched ELSE ts_ms END AS t1 FROM prog")
_PL2["pas"] = ("SELECT a.*, st.stop_id, st.stop_sequence, st.stop_s, "
               "NOT (st.stop_s + 0.0 < least(a.s_prev, a.s_now)) AS emitted, "
               "CASE WHEN abs(a.s_now - a.s_prev) < 1e-6 THEN a.ts_ms ELSE a.t1 + CAST(floor(least(greatest("
               "(st.stop_s - a.s_prev) / (a.s_now - a.s_prev), 0.0), 1.0) * (a.ts_ms - a.t1) + 0.5) AS BIGINT) END "
               "AS arrival_time_millis FROM anc a JOIN stops_m st ON st.trip_id = a.trip_id "
               "AND st.m <= a.progress + 0.0 AND NOT (a.row_no > 1 AND st.m <= a.progress_prev + 0.0)")


_EVENTS = ("SELECT agency, vehicle_id, trip_id, stop_id, CAST(stop_sequence AS INTEGER) AS stop_sequence, arrival_time_millis, "
           + local_time_sql("arrival_time_millis", "arrival_time_local", "arrival_date", "arrival_prev_date") + " FROM pas WHERE emitted")
PLANAR_EVENTS_SQL = _sql(_EVENTS, *_GEO_FX, extra=_PL2, recursive=True)
EVENTS_SQL = _sql(_EVENTS, *_GEO_FX, extra={**_WGS, **_ON_SAMPLES, **_ON_STOPS, "stops_s": _STOPS_S,
                                            **{k: _PL2[k] for k in ("stops_m", "sched", "smp", "prog", "anc", "pas")}})


def events_from_positions(spark, sf_dir, metric="wgs84"):
    """Stops projected on each trip's line, per-trip stop arrays, samples projected, then the batch detector.

    Samples are stored before and after their projection: the trips, the lines and the detector's scans read them several times."""
    samples = cut_lineage(_samples(spark, sf_dir))
    built = runtime(spark, sf_dir, metric, samples)
    s = cut_lineage(samples_on_lines(spark, sf_dir, built, metric, samples).select("agency", "vehicle_id", "trip_id", "s_now", "ts_ms", "seq"))
    return ar.arrival_events(ar.detect_arrivals(s, built[0].drop("line_id"), ["agency", "vehicle_id", "trip_id"], on=["trip_id"]))


@register("arrivals_from_positions", EVENTS_SQL)
def q_arrivals_from_positions(spark, sf_dir):
    """Raw coordinates to arrival events: project, then the batch detector per (agency, vehicle, trip)."""
    return events_from_positions(spark, sf_dir)


@register("arrivals_from_positions_planar", PLANAR_EVENTS_SQL)
def q_arrivals_from_positions_planar(spark, sf_dir):
    """The same with planar distances on the raw lines."""
    return events_from_positions(spark, sf_dir, "planar")


_RT_PL = {k: v for k, v in _PL2.items() if k in ("ts", "samples", "lines", "pts", "seg", "seg2", "segn", "cumr",
                                                  "seg3", "stop_pts")}
_RT_PL.update(_proj("stop_pts", "x.line_id, x.lat, x.lon"))
_RT_PL["stops_s"] = _PL2["stops_s"]
_RT_PL["sched"] = SCHED


@register("trip_runtime_planar", _sql(
    "SELECT s.trip_id, l.line_id, CAST(s.stop_pos AS INTEGER) AS stop_pos, s.stop_id, s.stop_s, "
    "CAST(COALESCE(sc.sched_start_ms, -1) AS BIGINT) AS sched_start_ms FROM stops_s s "
    "JOIN lines l ON l.trip_id = s.trip_id LEFT JOIN sched sc ON sc.trip_id = s.trip_id",
    "fx_positions", "fx_trips", "fx_shapes", "fx_stop_times", "fx_stops", extra=_RT_PL, recursive=True))
def q_trip_runtime_planar(spark, sf_dir):
    """Per trip: stops in order with their planar distance along the trip's raw line, and
    the scheduled start, for the trips the samples ask for."""
    rt, _, _ = runtime(spark, sf_dir, "planar")
    z = rt.select("trip_id", "line_id", "sched_start_ms",
                  F.posexplode(F.arrays_zip("stop_ids", "stop_s")).alias("stop_pos", "z"))
    return z.select("trip_id", "line_id", F.col("stop_pos").cast("int").alias("stop_pos"),
                    F.col("z.stop_ids").alias("stop_id"), F.col("z.stop_s").alias("stop_s"), "sched_start_ms")
