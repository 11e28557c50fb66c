"""Source queries: raw feed snapshots, static GTFS files and position records, all built
from the fixture tables and read back through the real readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.timecols import local_time_columns, local_time_sql
from ..operators import ingest as ing
from ..session import cut_lineage
from ..sources import feed as fd
from ..sources import gtfs as gl
from ..sources import positions as ps
from ..sources.snapshot_source import read_snapshots
from ..streaming import runner
from .ingest_queries import NOW_S, _KEPT, _KEY, _RECORD
from .oracle import with_fx
from .registry import register


def _landing(spark, sf_dir):
    """Snapshots encoded from fx:feed_entities (protobuf, four body encodings), landed as a
    table in the shared folder and read back."""
    root = runner.run_dir(spark, "landing")
    fd.encode_snapshots(fx.feed_entities(spark, sf_dir)).write.parquet(root)
    return spark.read.parquet(root)


_ENC = ("CASE snapshot_no % 4 WHEN 0 THEN 'identity' WHEN 1 THEN 'gzip' ELSE 'deflate' END")


@register("feed_snapshot_source", with_fx(
    f"SELECT feed, snapshot_no, {_ENC} AS content_encoding, header_ts, CAST(count(*) AS BIGINT) AS entities FROM fx_feed_entities GROUP BY ALL", "fx_feed_entities"))
def q_feed_snapshot_source(spark, sf_dir):
    """Raw snapshot files as a stream that keeps the feed's own position: half of them land, the query runs and stops, the
    rest lands, it goes on from its checkpoint. Every snapshot once, its body decoded and parsed."""
    root = runner.run_dir(spark, "snapshots")
    snaps = cut_lineage(fd.encode_snapshots(fx.feed_entities(spark, sf_dir)))
    middle = snaps.agg(F.floor(F.avg("snapshot_no"))).scalar()
    for half in (F.col("snapshot_no") <= middle, F.col("snapshot_no") > middle):
        fd.write_landing_files(snaps.where(half), f"{root}/in")
        runner.run_available_now(read_snapshots(spark, f"{root}/in"), f"{root}/out", f"{root}/ckpt")
    p = fd.parse_snapshots(fd.decode_body(spark.read.parquet(f"{root}/out"), "AUTO"))
    return p.select("feed", "snapshot_no", "content_encoding", "header_ts", F.size("entities").cast("long").alias("entities"))


_MODES = ("AUTO", "TRY_SMART", "GZIP", "DEFLATE", "NONE")
# The body rotates over identity, gzip, zlib and raw deflate; which of them a mode can read.
_READS = {"AUTO": "TRUE", "TRY_SMART": "snapshot_no % 4 <> 3", "GZIP": "snapshot_no % 4 = 1", "DEFLATE": "snapshot_no % 4 IN (2, 3)", "NONE": "snapshot_no % 4 = 0"}


@register("decode_body", with_fx(" UNION ALL ".join(
    f"SELECT DISTINCT '{m}' AS mode, feed, snapshot_no, {_ENC} AS content_encoding, {c} AS readable, CASE WHEN {c} THEN header_ts END AS header_ts "
    f"FROM fx_feed_entities" for m, c in _READS.items()), "fx_feed_entities"))
def q_decode_body(spark, sf_dir):
    """Every snapshot body in every decoding mode: whether the payload is the snapshot that was encoded, and its header time."""
    landed = _landing(spark, sf_dir)
    plain = fd.decode_body(landed, "AUTO").select(F.col("feed").alias("f"), F.col("snapshot_no").alias("n"), F.sha2("payload", 256).alias("want"))
    parts = []
    for m in _MODES:
        p = fd.parse_snapshots(fd.decode_body(landed, m)).join(plain, (F.col("feed") == F.col("f")) & (F.col("snapshot_no") == F.col("n")))
        same = F.coalesce(F.sha2("payload", 256) == F.col("want"), F.lit(False))
        parts.append(p.select(F.lit(m).alias("mode"), "feed", "snapshot_no", "content_encoding", same.alias("readable"), F.when(same, F.col("header_ts")).alias("header_ts")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


_ENT = ("feed, snapshot_no, header_ts, entity_idx, entity_id, vehicle_id, entity_ts, CAST(CAST(lat AS FLOAT) AS DOUBLE) "
        "AS lat, CAST(CAST(lon AS FLOAT) AS DOUBLE) AS lon, trip_id, has_vehicle")


@register("explode_feed", with_fx(f"SELECT {_ENT} FROM fx_feed_entities", "fx_feed_entities"))
def q_explode_feed(spark, sf_dir):
    return fd.explode_feed(fd.parse_snapshots(fd.decode_body(_landing(spark, sf_dir), "AUTO")))


@register("ingest_from_landing", with_fx(f"SELECT snapshot_no, entity_idx, {_KEY}, {_RECORD} FROM d",
                                         "fx_feed_entities", extra=_KEPT))
def q_ingest_from_landing(spark, sf_dir):
    """Raw snapshot files to position records: decode, explode, filter, both de-dups, record."""
    snaps = fd.parse_snapshots(fd.decode_body(_landing(spark, sf_dir)))
    ents = fd.explode_feed(snaps)
    return ing.ingest_positions(ents, snaps.select("feed", "snapshot_no", "header_ts"), now_s=NOW_S)


def _gtfs_tables(spark, sf_dir):
    sh = fx.shapes(spark, sf_dir).select("shape_id", F.col("lat").alias("shape_pt_lat"),
                                         F.col("lon").alias("shape_pt_lon"), "shape_pt_sequence")
    return {"agency": fx.agency(spark, sf_dir), "routes": fx.routes(spark, sf_dir), "stops": fx.stops(spark, sf_dir),
            "calendar": fx.calendar(spark, sf_dir), "shapes": sh, "trips": fx.trips(spark, sf_dir),
            "stop_times": fx.stop_times(spark, sf_dir), "frequencies": fx.frequencies(spark, sf_dir),
            "transfers": fx.transfers(spark, sf_dir)}


_LOAD_FX = ("fx_agency", "fx_routes", "fx_stops", "fx_calendar", "fx_shapes", "fx_trips", "fx_stop_times",
            "fx_frequencies", "fx_transfers")


def _clock(seconds):
    """``h:mm:ss`` of seconds since midnight, hours past 24 included."""
    return F.format_string("%d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)


def _land_feed(spark, sf_dir, root):
    """The fixture tables as GTFS files in the shapes feeds come in: columns in any order, missing and unknown ones, a byte
    order mark, values with quotes and line breaks, files with different headers, rows that do not fit."""
    t = _gtfs_tables(spark, sf_dir)

    def number(c):
        return F.substring(c, 2, 20).cast("long")

    def write(name, df, mode="errorifexists"):
        df.write.mode(mode).option("header", True).option("escape", '"').csv(f"{root}/{name}.txt")

    write("agency", t["agency"].select("agency_name", F.concat(F.lit("logo-"), "agency_id").alias("agency_logo"), "agency_id"))
    write("routes", t["routes"].select("route_type", "route_short_name", "route_id", "agency_id"))
    k = number("stop_id")
    write("stops", t["stops"].select(
        F.when(k % 50 == 49, F.lit("north")).otherwise(F.col("stop_lat").cast("string")).alias("\ufeffstop_lat"), "parent_station",
        F.when(k % 3 == 0, F.concat("stop_name", F.lit(' "'), "stop_id", F.lit('",\n\nnext line'))).otherwise(F.col("stop_name")).alias("Stop_Name"),
        "stop_id", "stop_lon"))
    write("calendar", t["calendar"].select(F.lit("20240101").alias("start_date"), "service_id"))
    odd = number("shape_id") % 2 == 1
    write("shapes", t["shapes"].where(odd).select("shape_pt_lon", "shape_id", "shape_pt_lat", "shape_pt_sequence"))
    write("shapes", t["shapes"].where(~odd).select("shape_pt_sequence", "shape_pt_lat", "shape_pt_lon", "shape_id"), "append")
    write("trips", t["trips"].select("shape_id", "trip_id", "service_id", "route_id"))
    n = number("trip_id")
    sequence = F.col("stop_sequence").cast("string")
    write("stop_times", t["stop_times"].select(
        "stop_id", _clock(F.col("arrival_seconds") + 21600).alias("arrival_time"),
        F.when((n % 40 == 0) & (F.col("stop_sequence") == 2), F.concat(sequence, F.lit("nd"))).otherwise(sequence).alias("stop_sequence"), "trip_id"))
    write("frequencies", t["frequencies"].select(
        F.when(n % 100 == 7, F.lit("often")).otherwise(F.col("headway_secs").cast("string")).alias("headway_secs"),
        F.when(n % 100 == 8, F.lit("6 am")).otherwise(_clock(F.lit(90060) + n % 60)).alias("start_time"), "trip_id"))
    write("transfers", t["transfers"].select("to_trip_id", "to_route_id", "to_stop_id", "from_trip_id", "from_route_id", "from_stop_id"))


# What the loaded columns hold, as SQL over the fixture tables; columns that are not named are null.
_LOADED = {
    "agency": {"agency_id": "agency_id", "agency_name": "agency_name"},
    "routes": {c: c for c in ("route_id", "agency_id", "route_short_name", "route_type")},
    "stops": {"stop_id": "stop_id", "stop_lat": "stop_lat", "stop_lon": "stop_lon", "parent_station": "parent_station",
              "stop_name": """CASE WHEN CAST(substr(stop_id, 2) AS BIGINT) % 3 = 0 THEN stop_name || ' "' || stop_id || '",' || chr(10) || chr(10) || 'next line' ELSE stop_name END"""},
    "calendar": {"service_id": "service_id", "start_date": "'20240101'"},
    "shapes": {"shape_id": "shape_id", "shape_pt_lat": "lat", "shape_pt_lon": "lon", "shape_pt_sequence": "shape_pt_sequence"},
    "trips": {c: c for c in ("route_id", "service_id", "trip_id", "shape_id")},
    "stop_times": {"trip_id": "trip_id", "stop_id": "stop_id", "stop_sequence": "stop_sequence", "arrival_seconds": "arrival_seconds + 21600",
                   "arrival_time": "printf('%d:%02d:%02d', (arrival_seconds + 21600) // 3600, (arrival_seconds + 21600) // 60 % 60, (arrival_seconds + 21600) % 60)"},
    "frequencies": {"trip_id": "trip_id", "headway_secs": "headway_secs", "start_time": "'25:01:' || lpad(CAST(CAST(substr(trip_id, 2) AS BIGINT) % 60 AS VARCHAR), 2, '0')",
                    "start_seconds": "90060 + CAST(substr(trip_id, 2) AS BIGINT) % 60"},
    "transfers": {c: c for c in ("from_stop_id", "to_stop_id", "from_route_id", "to_route_id", "from_trip_id", "to_trip_id")},
}
_MISFIT = {"stops": {"stop_lat": "CAST(substr(stop_id, 2) AS BIGINT) % 50 = 49"},
           "stop_times": {"stop_sequence": "CAST(substr(trip_id, 2) AS BIGINT) % 40 = 0 AND stop_sequence = 2"},
           "frequencies": {"headway_secs": "CAST(substr(trip_id, 2) AS BIGINT) % 100 = 7",
                           "start_time": "CAST(substr(trip_id, 2) AS BIGINT) % 100 = 8"}}


def _loaded_columns(table):
    return [(c, k == gl.D) for c, k in gl.SCHEMAS[table]] + [(c, False) for c in gl.TIMES.get(table, {}).values()]


def _loaded_sql():
    parts = []
    for t, columns in _LOADED.items():
        cells = []
        for c, real in _loaded_columns(t):
            x = columns.get(c, "NULL")
            cells.append(f"coalesce(CAST({f'CAST({x} * 1048576 AS BIGINT)' if real else x} AS VARCHAR), '-')")
        fits = " AND ".join(f"NOT ({m})" for m in _MISFIT.get(t, {}).values()) or "TRUE"
        parts.append(f"SELECT '{t}' AS table_name, {f' || chr(124) || '.join(cells)} AS content FROM fx_{t} WHERE {fits}")
        parts += [f"SELECT 'rejects' AS table_name, '{t}.{c}=' || CAST(count(*) AS VARCHAR) AS content FROM fx_{t} WHERE {m} HAVING count(*) > 0" for c, m in _MISFIT.get(t, {}).items()]
    parts.append("SELECT 'extra' AS table_name, agency_id || '=logo-' || agency_id AS content FROM fx_agency")
    return " UNION ALL ".join(parts)


@register("gtfs_static_load", with_fx(_loaded_sql(), *_LOAD_FX))
def q_gtfs_static_load(spark, sf_dir):
    """GTFS files read by header name: every column of every row, rejected rows counted per column, unknown columns apart."""
    root = runner.run_dir(spark, "gtfs")
    _land_feed(spark, sf_dir, root)
    feed = gl.read_feed(spark, root)
    parts = []
    for t in _LOADED:
        cells = [F.coalesce((F.floor(F.col(c) * 1048576) if real else F.col(c)).cast("string"), F.lit("-")) for c, real in _loaded_columns(t)]
        parts.append(feed.tables[t].select(F.lit(t).alias("table_name"), F.concat_ws("|", *cells).alias("content")))
    report = feed.reject_report().groupBy("table_name", "column").agg(F.sum("rows").alias("n"))
    parts.append(report.select(F.lit("rejects").alias("table_name"), F.concat("table_name", F.lit("."), "column", F.lit("="), F.col("n").cast("string")).alias("content")))
    parts.append(feed.extras["agency"].select(F.lit("extra").alias("table_name"), F.concat("agency_id", F.lit("="), F.col("extra")["agency_logo"]).alias("content")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


_FK_SQL = []
for _t, _c, _rt, _rc in gl.FOREIGN_KEYS:
    if _t in ("calendar_dates",):
        continue
    _FK_SQL.append(f"SELECT '{_t}.{_c}->{_rt}.{_rc}' AS relation, CAST(count(*) AS BIGINT) AS orphan_rows "
                   f"FROM fx_{_t} WHERE {_c} IS NOT NULL AND {_c} NOT IN (SELECT {_rc} FROM fx_{_rt} "
                   f"WHERE {_rc} IS NOT NULL)")


@register("gtfs_dependency_check", with_fx(" UNION ALL ".join(_FK_SQL), *_LOAD_FX))
def q_gtfs_dependency_check(spark, sf_dir):
    t = _gtfs_tables(spark, sf_dir)
    problems = gl.check_dependencies(set(t))
    if problems:
        raise gl.MissingDependency("; ".join(problems))
    return gl.orphan_report(t)


def _records(spark, sf_dir):
    p = fx.positions(spark, sf_dir)
    return p.select("agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms",
                    *local_time_columns(F.col("ts_ms")), "seq")


_REC_SQL = (f"SELECT agency, vehicle_id, trip_id, latitude, longitude, ts_ms, {local_time_sql('ts_ms')}, seq "
            "FROM fx_positions")


@register("read_positions", with_fx(_REC_SQL, "fx_positions"))
def q_read_positions(spark, sf_dir):
    """Position records as JSON lines in a landing folder, read as a file stream with the
    record schema, exactly once into a table, read back."""
    root = runner.run_dir(spark, "positions")
    rec = _records(spark, sf_dir)
    runner.append_in_order(rec, f"{root}/in", "seq", 3, fmt="json")
    schema = ps.with_seq(ps.POSITION_SCHEMA)
    stream = ps.read_positions(spark, f"{root}/in", schema, stream=True)
    runner.run_available_now(stream, f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("bad_record_tolerance", with_fx(
    "SELECT CAST(count(*) FILTER (WHERE seq % 97 <> 0) AS BIGINT) AS good_rows, "
    "CAST(count(*) FILTER (WHERE seq % 97 = 0) AS BIGINT) AS bad_rows FROM fx_positions", "fx_positions"))
def q_bad_record_tolerance(spark, sf_dir):
    """Every 97th JSON line is cut short; those lines are set apart, the rest parse."""
    rec = _records(spark, sf_dir)
    line = F.to_json(F.struct(*rec.columns))
    lines = rec.select(F.when(F.col("seq") % 97 == 0, F.substring(line, 1, 25)).otherwise(line).alias("value"))
    good, bad = ps.parse_lines(lines, ps.with_seq(ps.POSITION_SCHEMA))
    g = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("k"), "n")
    b = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad").alias("k"), "n")
    u = g.unionByName(b)
    return u.groupBy().agg(F.sum(F.when(F.col("k") == "good", F.col("n"))).cast("long").alias("good_rows"),
                           F.sum(F.when(F.col("k") == "bad", F.col("n"))).cast("long").alias("bad_rows"))
