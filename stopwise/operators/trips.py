"""Trip geometry: stop lists, shapes, densified lines, segments and projection.

A *line* is what a trip's samples are projected on: its shape's points, or, when the
trip has no shape points, its stops in sequence (``pseudo_shape``). Lines are keyed by
``line_id`` (``shape_id`` or ``trip:<trip_id>``) so trips that share a shape share its
stop projections.

Geodesics run in numpy inside Arrow batches (``functions.geodesic``). The projection
of many points on a line deals both by (line_id, block): a block holds at most so many
points plus the line's row, so one busy trip is spread over many tasks. Points are
projected by ``operators.lines``: a bounding tree over the line's original segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geodesic as geo
from .arrivals import stop_runtime
from .lines import METRICS

PSEUDO_PREFIX = "trip:"
# Points of one line per projection group at most.
PROJECT_BLOCK = 1 << 16


# --- stop and shape lists ---------------------------------------------------------------------------

def trip_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stops of each trip in sequence order, one row per stop with ``stop_pos`` (0-based).

    Ties in sequence keep stop id order. Columns: trip_id, stop_pos, stop_id, stop_sequence,
    stop_lat, stop_lon.
    """
    st = stop_times.select("trip_id", "stop_id", "stop_sequence")
    s = stops.select("stop_id", "stop_lat", "stop_lon")
    j = st.join(s, "stop_id", "inner")
    w = Window.partitionBy("trip_id").orderBy("stop_sequence", "stop_id")
    return j.select("trip_id", (F.row_number().over(w) - 1).cast("int").alias("stop_pos"), "stop_id",
                    "stop_sequence", "stop_lat", "stop_lon")


def trip_shape(trips: DataFrame, shapes: DataFrame) -> DataFrame:
    """Shape points of each trip in sequence order (``pt_pos`` 0-based); trips without shape
    points have no rows."""
    sh = shapes.select("shape_id", "shape_pt_sequence", "lat", "lon")
    j = trips.select("trip_id", "shape_id").join(sh, "shape_id", "inner")
    w = Window.partitionBy("trip_id").orderBy("shape_pt_sequence")
    return j.select("trip_id", "shape_id", (F.row_number().over(w) - 1).cast("int").alias("pt_pos"),
                    "shape_pt_sequence", "lat", "lon")


def line_of_trip(trips: DataFrame, shapes: DataFrame) -> DataFrame:
    """(trip_id, line_id): the shape when it has points, else the trip's own pseudo shape."""
    with_pts = shapes.select("shape_id").distinct()
    t = trips.select("trip_id", "shape_id").join(with_pts.withColumn("_has", F.lit(True)), "shape_id", "left")
    return t.select("trip_id", F.when(F.col("_has"), F.col("shape_id"))
                    .otherwise(F.concat(F.lit(PSEUDO_PREFIX), F.col("trip_id"))).alias("line_id"))


def pseudo_shape(trips: DataFrame, shapes: DataFrame, stops_of_trips: DataFrame) -> DataFrame:
    """Line points of trips without shape points: their stops in order."""
    no_shape = line_of_trip(trips, shapes).where(F.col("line_id").startswith(PSEUDO_PREFIX))
    p = stops_of_trips.join(no_shape, "trip_id", "inner")
    return p.select("line_id", "trip_id", F.col("stop_pos").alias("pt_pos"), F.col("stop_lat").alias("lat"),
                    F.col("stop_lon").alias("lon"))


def line_points(trips: DataFrame, shapes: DataFrame, stops_of_trips: DataFrame) -> DataFrame:
    """All line points: (line_id, pt_order, lat, lon), shape points and pseudo shapes."""
    sh = shapes.select(F.col("shape_id").alias("line_id"), F.col("shape_pt_sequence").cast("long").alias("pt_order"),
                       "lat", "lon")
    ps = pseudo_shape(trips, shapes, stops_of_trips).select("line_id", F.col("pt_pos").cast("long").alias("pt_order"),
                                                            "lat", "lon")
    return sh.unionByName(ps)


# --- densify and segments ---------------------------------------------------------------------------

def densify_polyline(points: DataFrame, step_m: float, *, line: str = "line_id", order: str = "pt_order") -> DataFrame:
    """Insert points so gaps are at most ``step_m``: for a segment longer than the step,
    n = floor(seg / step) points at t = k * step / seg (while t < 1), linear in lat/lon,
    then the end point. Lines of <= 1 point and step <= 0 leave the line unchanged.

    Output: line, ``pt_idx`` (0-based position in the densified line), lat, lon.
    """
    w = Window.partitionBy(line).orderBy(order)
    base = points.select(line, order, "lat", "lon").withColumn("_i", F.row_number().over(w) - 1)
    if step_m <= 0:
        return base.select(line, F.col("_i").cast("long").alias("pt_idx"), "lat", "lon")
    seg = (base.withColumn("_blat", F.lead("lat").over(w)).withColumn("_blon", F.lead("lon").over(w))
               .where(F.col("_blat").isNotNull()))
    seg = seg.withColumn("_g", geo.geodesic_inverse(F.col("lat"), F.col("lon"), F.col("_blat"), F.col("_blon")))
    d = F.col("_g.s12")
    step = F.lit(float(step_m))
    n = F.when(F.isnan(d) | d.isNull() | (d <= step), F.lit(0)).otherwise(F.floor(d / step)).cast("int")
    seg = seg.withColumn("_n", n)
    inner = (seg.where(F.col("_n") > 0)
                .withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
                .withColumn("_t", F.col("_k") * step / d)
                .where(F.col("_t") < 1.0)
                .select(line, F.col("_i").alias("_a"), F.col("_k").alias("_kk"),
                        (F.col("lat") + (F.col("_blat") - F.col("lat")) * F.col("_t")).alias("lat"),
                        (F.col("lon") + (F.col("_blon") - F.col("lon")) * F.col("_t")).alias("lon")))
    ends = seg.select(line, F.col("_i").alias("_a"), (F.col("_n") + 1).alias("_kk"),
                      F.col("_blat").alias("lat"), F.col("_blon").alias("lon"))
    first = base.where(F.col("_i") == 0).select(line, F.lit(-1).cast("long").alias("_a"), F.lit(0).alias("_kk"),
                                                "lat", "lon")
    allp = first.unionByName(inner.withColumn("_a", F.col("_a").cast("long"))) \
                .unionByName(ends.withColumn("_a", F.col("_a").cast("long")))
    w2 = Window.partitionBy(line).orderBy("_a", "_kk")
    return allp.select(line, (F.row_number().over(w2) - 1).cast("long").alias("pt_idx"), "lat", "lon")


def shape_segments(points: DataFrame, *, line: str = "line_id", order: str = "pt_idx") -> DataFrame:
    """Segments A->B of each line with length, azimuth at A and cumulative start distance;
    zero-length segments are dropped (they add nothing to the cumulative distance).

    Columns: line, seg_idx, a_lat, a_lon, b_lat, b_lon, seg_len, seg_az, cum_start.
    """
    w = Window.partitionBy(line).orderBy(order)
    s = (points.select(line, order, "lat", "lon")
               .withColumn("b_lat", F.lead("lat").over(w)).withColumn("b_lon", F.lead("lon").over(w))
               .where(F.col("b_lat").isNotNull()))
    s = s.withColumn("_g", geo.geodesic_inverse(F.col("lat"), F.col("lon"), F.col("b_lat"), F.col("b_lon")))
    s = s.select(line, F.col(order).alias("seg_idx"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"),
                 "b_lat", "b_lon", F.col("_g.s12").alias("seg_len"), F.col("_g.azi1").alias("seg_az"))
    s = s.where(F.col("seg_len") != 0.0)
    wc = Window.partitionBy(line).orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("cum_start", F.coalesce(F.sum("seg_len").over(wc), F.lit(0.0)))


# --- projection ---------------------------------------------------------------------------------------

def line_table(points: DataFrame, *, line: str = "line_id", order: str = "pt_order") -> DataFrame:
    """One row per line with its points in order: line, ``line_lat``, ``line_lon`` (arrays)."""
    in_order = F.sort_array(F.collect_list(F.struct(order, "lat", "lon")))
    return (points.groupBy(line).agg(in_order.alias("_pts"))
            .select(line, F.transform("_pts", lambda p: p["lat"]).alias("line_lat"), F.transform("_pts", lambda p: p["lon"]).alias("line_lon")))


def to_digits(x: np.ndarray, digits: int | None) -> np.ndarray:
    """Metres to so many decimal digits, halves up; None leaves them as they are."""
    return x if digits is None else np.floor(x * 10 ** digits + 0.5) / 10 ** digits


def deal_lines(points: DataFrame, lines: DataFrame, line: str, block_on: str | None, block_size: int) -> tuple[DataFrame, DataFrame]:
    """``points`` and ``lines`` with the block (``_pblk``) in which they meet (see :func:`project_along`)."""
    spread = F.xxhash64(block_on) if block_on else F.xxhash64("lat", "lon")
    # Only lines over the limit, at most points / block_size of them, are joined back.
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_size)).cast("long")
    many = points.groupBy(F.col(line).alias("_kl")).agg(blocks.alias("_kb")).where("_kb > 1")
    pts = (points.join(many, points[line] == many["_kl"], "left")
           .withColumn("_pblk", F.coalesce(F.pmod(spread, F.col("_kb")), F.lit(0)).cast("long")).drop("_kl", "_kb"))
    # Fresh column instances on the line side, so the two cogroup sides share no lineage.
    many_lines = many.select(F.col("_kl").alias("_ml"), F.col("_kb").alias("_mb"))
    rest = [c for c in lines.columns if c != line]
    side = lines.select(F.col(line).alias("_kl"), *rest)
    side = side.join(many_lines, side["_kl"] == many_lines["_ml"], "left").withColumn(
        "_pblk", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_mb"), F.lit(1)) - 1)))
    return pts, side.select(F.col("_kl").alias(line), "_pblk", *rest)


def project_along(points: DataFrame, lines: DataFrame, *, step_m: float = 10.0, line: str = "line_id", out: str = "s_now",
                  block_on: str | None = None, block_size: int = PROJECT_BLOCK, digits: int | None = None,
                  metric: str = "wgs84") -> DataFrame:
    """Append ``out`` (distance along the densified line) to every row of ``points`` (needs lat, lon, line).

    ``lines`` has one row per line (:func:`line_table`); its pieces of ``step_m`` metres are arithmetic inside
    :class:`.lines.Lines`, no row is made for them. Rows are dealt by line; a line with more than ``block_size``
    points is dealt over ``ceil(points / block_size)`` blocks by a hash of ``block_on`` (the
    coordinates when None), and its row is sent to each. So a line is copied once plus once per
    ``block_size`` points, whatever the range of ``block_on``. Points whose line has no segments
    get 0.0. ``digits``: keep so many decimals (3: millimetres), so that a sample on a stop has the stop's distance.
    ``metric="planar"`` takes the original segments in the plane.
    """
    pts, side = deal_lines(points, lines, line, block_on, block_size)
    schema = T.StructType(points.schema.fields + [T.StructField(out, T.DoubleType())])
    # One sorted stream per task: a line's row, then its points; lines of a batch are prepared together.
    both = (pts.withColumn("_point", F.lit(1)).unionByName(side.withColumn("_point", F.lit(0)), allowMissingColumns=True)
            .repartition(line, "_pblk").sortWithinPartitions(line, "_pblk", "_point"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held_lat, held_lon = None, None, None          # the line that the rows before this batch ended with
        for b in batches:
            is_point = b.column("_point").to_numpy().astype(bool)
            rows = np.flatnonzero(~is_point)
            names = b.column(line).take(pa.array(rows)).to_pylist()
            lat, lon = (b.column(c).take(pa.array(rows)) for c in ("line_lat", "line_lon"))
            size = [len(held_lat) if held_lat is not None else 0, *(pc.list_value_length(lat).fill_null(0).to_pylist())]
            every_lat = np.concatenate([held_lat if held_lat is not None else np.empty(0), lat.flatten().to_numpy(zero_copy_only=False)])
            every_lon = np.concatenate([held_lon if held_lon is not None else np.empty(0), lon.flatten().to_numpy(zero_copy_only=False)])
            first = np.concatenate([[0], np.cumsum(size)])
            points = b.filter(pa.array(is_point))
            if points.num_rows:
                which = np.cumsum(~is_point)[is_point]
                mine = pc.equal(points.column(line), pa.array([name, *names], b.column(line).type).take(pa.array(which)))
                which = np.where(mine.fill_null(False).to_numpy(zero_copy_only=False), which, -1)
                coords = [points.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("lat", "lon")]
                along = to_digits(METRICS[metric](every_lat, every_lon, first, step_m).project(*coords, which), digits)
                yield pa.record_batch([*(points.column(f.name) for f in points_schema), pa.array(along)], names=schema.names)
            if names:
                name = names[-1]
                held_lat, held_lon = every_lat[first[-2]:], every_lon[first[-2]:]

    points_schema = points.schema.fields
    return both.mapInArrow(run, schema)


# --- per-trip runtime ---------------------------------------------------------------------------------

def trip_schedule_start(trips: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """(trip_id, sched_start_ms): scheduled start in epoch ms, -1 when unknown."""
    t = trips.select("trip_id")
    if schedule is None:
        return t.withColumn("sched_start_ms", F.lit(-1).cast("long"))
    s = schedule.select("trip_id", F.col("sched_start_ms").cast("long").alias("_s"))
    return t.join(s, "trip_id", "left").select("trip_id", F.coalesce(F.col("_s"), F.lit(-1)).cast("long")
                                               .alias("sched_start_ms"))


def runtime_of_trips(trips: DataFrame, stops: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """The detector's row of every trip of ``trips``: its stop arrays (empty without stops) and scheduled start.

    ``stops``: trip_id, stop_id, stop_sequence, stop_s. A trip without stop times still anchors its first
    sample at its scheduled start, so it keeps its row."""
    rt = stop_runtime(stops, ["trip_id"]).drop("sched_start_ms")
    all_trips = trip_schedule_start(trips.select("trip_id"), schedule).join(rt, "trip_id", "left")
    kinds = {f.name: f.dataType for f in rt.schema.fields}
    return all_trips.select("trip_id", *(F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in ("stop_ids", "stop_seqs", "stop_s", "stop_m")), "sched_start_ms")


def trip_runtime(trips: DataFrame, shapes: DataFrame, stop_times: DataFrame, stops: DataFrame,
                 schedule: DataFrame | None = None, densify_step_m: float = 10.0,
                 for_trips: DataFrame | None = None,
                 materialize=None, metric: str = "wgs84", digits: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per trip: stops in order with their distance along the densified line, plus the
    scheduled start. Returns ``(runtime, line_of_trip, lines)`` where ``runtime`` has
    one row per trip (trip_id, line_id, stop_ids, stop_seqs, stop_s, stop_m, sched_start_ms), also for
    trips without stops, and ``lines`` one row per line (:func:`line_table`).

    ``for_trips`` (a DataFrame with ``trip_id``) limits the work to the trips samples ask
    for, like a memo filled on demand; shapes and stop times are cut to those trips first.
    Stops are projected once per distinct (line, stop point).
    ``materialize`` (e.g. ``session.cut_lineage``) is applied to the wanted trips, the lines and
    the finished runtime, so each is computed once and later plans start from stored data.
    """
    keep = materialize or (lambda d: d)
    if for_trips is not None:
        wanted = keep(for_trips.select("trip_id").where(F.col("trip_id").isNotNull()).distinct())
        trips = keep(trips.join(wanted, "trip_id", "left_semi"))
        stop_times = stop_times.join(wanted, "trip_id", "left_semi")
        shapes = shapes.join(trips.select("shape_id").where(F.col("shape_id").isNotNull()).distinct(),
                             "shape_id", "left_semi")
    ts = keep(trip_stops(stop_times, stops))
    of_trip = keep(line_of_trip(trips, shapes))
    pts = line_points(trips, shapes, ts)
    lines = keep(line_table(pts))
    on_line = ts.join(of_trip, "trip_id", "inner")
    stop_pts = on_line.select("line_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon")).distinct()
    proj = project_along(stop_pts, lines, step_m=densify_step_m, out="stop_s", digits=digits, metric=metric)
    pj = proj.select(F.col("line_id").alias("_pl"), F.col("lat").alias("_plat"), F.col("lon").alias("_plon"), "stop_s")
    ts_s = (on_line.join(pj, (F.col("line_id") == F.col("_pl")) & (F.col("stop_lat") == F.col("_plat"))
                         & (F.col("stop_lon") == F.col("_plon")), "inner")
            .select("trip_id", "stop_id", "stop_sequence", "stop_s"))
    rt = keep(runtime_of_trips(trips, ts_s, schedule).join(of_trip, "trip_id", "left"))
    return rt, of_trip, lines


__all__ = ["trip_stops", "trip_shape", "line_of_trip", "pseudo_shape", "line_points", "densify_polyline",
           "shape_segments", "line_table", "project_along", "trip_schedule_start",
           "runtime_of_trips", "trip_runtime"]
