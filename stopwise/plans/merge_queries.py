"""GTFS merge queries over the fixture split (FIXTURES.md "Merge split")."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..operators import merge as mg
from ..streaming.runner import run_dir
from .oracle import with_fx
from .registry import register

# Fixed values for repeatable ids: run salt and run time (replace random() and clock time).
SALT = "stopwise-merge"
RUN_MS = 1735689600000
SOURCE_SCHEMA, TARGET_SCHEMA = "gtfs_new", "gtfs"

_FX = ("fx_agency", "fx_routes", "fx_stops", "fx_calendar", "fx_shapes", "fx_trips", "fx_stop_times",
       "fx_frequencies", "fx_transfers")


def _side(p: str, agencies: str) -> dict[str, str]:
    return {
        f"{p}_agency": f"SELECT * FROM fx_agency WHERE agency_id IN ({agencies})",
        f"{p}_routes": f"SELECT * FROM fx_routes WHERE agency_id IN (SELECT agency_id FROM {p}_agency)",
        f"{p}_trips": f"SELECT * FROM fx_trips WHERE route_id IN (SELECT route_id FROM {p}_routes)",
        f"{p}_stop_times": ("SELECT trip_id, stop_id, stop_sequence, arrival_seconds AS arrival_time FROM fx_stop_times "
                            f"WHERE trip_id IN (SELECT trip_id FROM {p}_trips)"),
        f"{p}_frequencies": f"SELECT * FROM fx_frequencies WHERE trip_id IN (SELECT trip_id FROM {p}_trips)",
    }


_SPLIT = {
    **_side("src", "'A0', 'A1'"), **_side("tgt", "'A1', 'A2', 'A3', 'A4'"),
    "src_transfers": "SELECT * FROM fx_transfers WHERE id % 2 = 0",
    "tgt_transfers": "SELECT * FROM fx_transfers WHERE id % 2 = 1",
    "cal_dates": ("SELECT DISTINCT 'C' || substr(o_orderpriority, 1, 1) AS service_id, '20240101' AS date, "
                  "'1' AS exception_type FROM orders"),
    "src_feed_info": ("SELECT 'publisher-' || n_nationkey * 3 % 7 || '-' || n_nationkey AS feed_publisher_name, 'en' AS feed_lang, "
                      "'nation-' || n_nationkey AS feed_version FROM nation"),
    "tgt_feed_info": ("SELECT 'publisher-' || r_regionkey * 3 % 7 || '-' || r_regionkey AS feed_publisher_name, 'en' AS feed_lang, "
                      "'region-' || r_regionkey AS feed_version FROM region"),
    "dup": ("SELECT DISTINCT agency_id, agency_name FROM tgt_agency t WHERE EXISTS "
            "(SELECT 1 FROM src_agency s WHERE s.agency_name = t.agency_name)"),
    "dup_routes": "SELECT route_id FROM tgt_routes WHERE agency_id IN (SELECT agency_id FROM dup)",
    "dup_trips": "SELECT trip_id FROM tgt_trips WHERE route_id IN (SELECT route_id FROM dup_routes)",
}


def _nid(tbl: str, old: str) -> str:
    return f"substr('{tbl}', 1, 2) || '_' || substr(md5('{tbl}' || {old} || '{SALT}'), 1, 10) || '_' || '{RUN_MS}'"


_MAP = {
    "mapping": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, old_id, {_nid(t, 'old_id')} AS new_id FROM "
        f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS old_id FROM {src} WHERE {c} IS NOT NULL)"
        for t, c, src in (("agency", "agency_id", "src_agency"), ("routes", "route_id", "src_routes"),
                          ("stops", "stop_id", "fx_stops"), ("calendar", "service_id", "fx_calendar"),
                          ("shapes", "shape_id", "fx_shapes"), ("trips", "trip_id", "src_trips"))),
    "maxes": ("SELECT (SELECT COALESCE(max(id), 0) FROM fx_shapes) AS max_shapes_id, "
              "(SELECT COALESCE(max(frequencies_row), 0) FROM tgt_frequencies) AS max_frequencies_row, "
              "(SELECT COALESCE(max(id), 0) FROM tgt_transfers) AS max_transfers_id"),
}


def _sql(body: str) -> str:
    return with_fx(body, *_FX, extra={**_SPLIT, **_MAP})


def _m(t: str, alias: str) -> str:
    return f"(SELECT old_id, new_id FROM mapping WHERE table_name = '{t}') {alias}"


def _split(spark, sf_dir):
    return fx.gtfs_split(spark, sf_dir)


def _one(spark, sf_dir):
    """(source, target, mapping) for queries that remap a single table."""
    src, tgt = _split(spark, sf_dir)
    return src, tgt, mg.Mapping(src, SALT, RUN_MS)


def _plan(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.plan_merge(spark, src, tgt, source_schema=SOURCE_SCHEMA, target_schema=TARGET_SCHEMA,
                         run_ms=RUN_MS, salt=SALT, feed_info_key=["feed_publisher_name"])


@register("merge_max_surrogate", _sql("SELECT * FROM maxes"))
def q_max_surrogate(spark, sf_dir):
    _, tgt = _split(spark, sf_dir)
    return mg.max_surrogates(tgt)


@register("merge_duplicate_agencies", _sql("SELECT agency_id, agency_name FROM dup"))
def q_dup(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.duplicate_agencies(src, tgt)


@register("merge_delete_transfers", _sql(
    "SELECT * FROM tgt_transfers tr WHERE NOT EXISTS (SELECT 1 FROM dup_routes r WHERE tr.from_route_id = r.route_id "
    "OR tr.to_route_id = r.route_id) AND NOT EXISTS (SELECT 1 FROM dup_trips t WHERE tr.from_trip_id = t.trip_id "
    "OR tr.to_trip_id = t.trip_id)"))
def q_del_transfers(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_transfers(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_delete_stop_times", _sql(
    "SELECT * FROM tgt_stop_times WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)"))
def q_del_stop_times(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_stop_times(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_delete_frequencies", _sql(
    "SELECT * FROM tgt_frequencies WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)"))
def q_del_frequencies(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_frequencies(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_delete_trips", _sql("SELECT * FROM tgt_trips WHERE route_id NOT IN (SELECT route_id FROM dup_routes)"))
def q_del_trips(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_trips(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_delete_routes", _sql("SELECT * FROM tgt_routes WHERE agency_id NOT IN (SELECT agency_id FROM dup)"))
def q_del_routes(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_routes(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_delete_agencies", _sql("SELECT * FROM tgt_agency WHERE agency_id NOT IN (SELECT agency_id FROM dup)"))
def q_del_agencies(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    return mg.delete_agencies(tgt, mg.duplicate_agencies(src, tgt))


@register("merge_id_mapping", _sql("SELECT table_name, old_id, new_id FROM mapping"))
def q_mapping(spark, sf_dir):
    src, _ = _split(spark, sf_dir)
    return mg.id_mapping(src, SALT, RUN_MS)


# A five-digit hash collides already on small tables; some first tries are taken by the target.
SHORT_HEX = 5


def _try(again: str) -> str:
    return (f"substr(table_name, 1, 2) || '_' || substr(md5(table_name || old_id || '{SALT}' || CASE WHEN {again} = 0 THEN '' ELSE '#' || {again} END), 1, {SHORT_HEX}) "
            f"|| '_' || '{RUN_MS}'")


_REPAIR = {
    "ids": "SELECT table_name, old_id FROM mapping",
    "taken": f"SELECT {_try('0')} AS id FROM ids WHERE table_name = 'trips' AND CAST(substr(old_id, 2) AS BIGINT) % 50 = 0",
    "rounds": (f"SELECT 0 AS r, table_name, old_id, {_try('0')} AS new_id, row_number() OVER (PARTITION BY {_try('0')} ORDER BY table_name, old_id) = 1 "
               f"AND {_try('0')} NOT IN (SELECT id FROM taken) AS settled FROM ids UNION ALL "
               "SELECT r + 1, table_name, old_id, c, settled OR (row_number() OVER (PARTITION BY c ORDER BY settled DESC, table_name, old_id) = 1 AND c NOT IN (SELECT id FROM taken)) "
               f"FROM (SELECT *, CASE WHEN settled THEN new_id ELSE {_try('r + 1')} END AS c, bool_or(NOT settled) OVER () AS more FROM rounds) q WHERE more"),
}


@register("merge_id_mapping_repaired", with_fx("SELECT table_name, old_id, new_id FROM rounds WHERE r = (SELECT max(r) FROM rounds)",
                                               *_FX, extra={**_SPLIT, **_MAP, **_REPAIR}, recursive=True))
def q_mapping_repaired(spark, sf_dir):
    """The id mapping with a hash so short that ids collide, and with ids that the target has already."""
    src, _ = _split(spark, sf_dir)
    first = mg.Mapping(src, SALT, RUN_MS, hex_chars=SHORT_HEX).table("trips")
    taken = first.where(F.substring("old_id", 2, 20).cast("long") % 50 == 0).select(F.col("new_id").alias("id"))
    return mg.id_mapping(src, SALT, RUN_MS, taken=taken, hex_chars=SHORT_HEX)


_NULL = "CAST(NULL AS VARCHAR)"


@register("merge_agency", _sql(
    f"SELECT m.new_id AS agency_id, s.agency_name, {', '.join(f'{_NULL} AS {c}' for c in mg.COLUMNS['agency'][2:])} "
    f"FROM src_agency s JOIN {_m('agency', 'm')} ON m.old_id = s.agency_id"))
def q_merge_agency(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_agency(src["agency"], m)


@register("merge_routes", _sql(
    "SELECT r.new_id AS route_id, a.new_id AS agency_id, s.route_short_name, s.route_type "
    f"FROM src_routes s JOIN {_m('routes', 'r')} ON r.old_id = s.route_id LEFT JOIN {_m('agency', 'a')} "
    "ON a.old_id = s.agency_id"))
def q_merge_routes(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_routes(src["routes"], m).select("route_id", "agency_id", "route_short_name", "route_type")


@register("merge_stops", _sql(
    "SELECT m.new_id AS stop_id, s.stop_name, s.stop_lat, s.stop_lon, p.new_id AS parent_station "
    f"FROM fx_stops s JOIN {_m('stops', 'm')} ON m.old_id = s.stop_id LEFT JOIN {_m('stops', 'p')} "
    "ON p.old_id = s.parent_station"))
def q_merge_stops(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_stops(src["stops"], m).select("stop_id", "stop_name", "stop_lat", "stop_lon",
                                                         "parent_station")


@register("merge_calendar", _sql(f"SELECT m.new_id AS service_id FROM fx_calendar s JOIN {_m('calendar', 'm')} "
                                 "ON m.old_id = s.service_id"))
def q_merge_calendar(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_calendar(src["calendar"], m).select("service_id")


@register("merge_calendar_dates", _sql(
    f"SELECT m.new_id AS service_id, s.date, s.exception_type FROM cal_dates s JOIN {_m('calendar', 'm')} "
    "ON m.old_id = s.service_id"))
def q_merge_calendar_dates(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_calendar_dates(src["calendar_dates"], m)


_SHAPES_BODY = (
    "SELECT row_number() OVER (ORDER BY m.new_id NULLS FIRST, s.shape_pt_sequence NULLS FIRST, s.lat NULLS FIRST, "
    "s.lon NULLS FIRST) + (SELECT max_shapes_id FROM maxes) AS id, m.new_id AS shape_id, s.shape_pt_sequence, s.lat, s.lon "
    f"FROM fx_shapes s JOIN {_m('shapes', 'm')} ON m.old_id = s.shape_id")


@register("merge_shapes", _sql(_SHAPES_BODY))
def q_merge_shapes(spark, sf_dir):
    src, tgt, m = _one(spark, sf_dir)
    return mg.remap_shapes(src["shapes"], m, mg.max_surrogates(tgt).select("max_shapes_id")).select("id", "shape_id", "shape_pt_sequence", "lat", "lon")


@register("merge_trips", _sql(
    "SELECT t.new_id AS trip_id, r.new_id AS route_id, c.new_id AS service_id, h.new_id AS shape_id "
    f"FROM src_trips s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id JOIN {_m('routes', 'r')} ON r.old_id = s.route_id "
    f"JOIN {_m('calendar', 'c')} ON c.old_id = s.service_id LEFT JOIN {_m('shapes', 'h')} ON h.old_id = s.shape_id"))
def q_merge_trips(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_trips(src["trips"], m).select("trip_id", "route_id", "service_id", "shape_id")


@register("merge_stop_times", _sql(
    "SELECT t.new_id AS trip_id, s.arrival_time, p.new_id AS stop_id, s.stop_sequence "
    f"FROM src_stop_times s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id JOIN {_m('stops', 'p')} "
    "ON p.old_id = s.stop_id"))
def q_merge_stop_times(spark, sf_dir):
    src, _, m = _one(spark, sf_dir)
    return mg.remap_stop_times(src["stop_times"], m).select("trip_id", "arrival_time", "stop_id", "stop_sequence")


@register("merge_frequencies", _sql(
    "SELECT row_number() OVER (ORDER BY t.new_id NULLS FIRST, s.headway_secs NULLS FIRST) "
    "+ (SELECT max_frequencies_row FROM maxes) AS frequencies_row, t.new_id AS trip_id, s.headway_secs "
    f"FROM src_frequencies s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id"))
def q_merge_frequencies(spark, sf_dir):
    src, tgt, m = _one(spark, sf_dir)
    return mg.remap_frequencies(src["frequencies"], m, mg.max_surrogates(tgt).select("max_frequencies_row")).select("frequencies_row", "trip_id", "headway_secs")


_TRANSFERS_BODY = (
    "SELECT a.new_id AS from_stop_id, b.new_id AS to_stop_id, c.new_id AS from_route_id, d.new_id AS to_route_id, "
    "e.new_id AS from_trip_id, f.new_id AS to_trip_id FROM src_transfers s "
    f"LEFT JOIN {_m('stops', 'a')} ON a.old_id = s.from_stop_id LEFT JOIN {_m('stops', 'b')} ON b.old_id = s.to_stop_id "
    f"LEFT JOIN {_m('routes', 'c')} ON c.old_id = s.from_route_id LEFT JOIN {_m('routes', 'd')} ON d.old_id = s.to_route_id "
    f"LEFT JOIN {_m('trips', 'e')} ON e.old_id = s.from_trip_id LEFT JOIN {_m('trips', 'f')} ON f.old_id = s.to_trip_id")
_TR_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("from_stop_id", "to_stop_id", "from_route_id", "to_route_id",
                                                    "from_trip_id", "to_trip_id"))


@register("merge_transfers", _sql(
    f"SELECT row_number() OVER (ORDER BY {_TR_ORDER}) + (SELECT max_transfers_id FROM maxes) AS id, * "
    f"FROM ({_TRANSFERS_BODY}) x"))
def q_merge_transfers(spark, sf_dir):
    src, tgt, m = _one(spark, sf_dir)
    return mg.remap_transfers(src["transfers"], m, mg.max_surrogates(tgt).select("max_transfers_id")).select(
        "id", "from_stop_id", "to_stop_id", "from_route_id", "to_route_id", "from_trip_id", "to_trip_id")


@register("surrogate_keys", _sql(
    f"SELECT row_number() OVER (ORDER BY {_TR_ORDER}) + (SELECT max_transfers_id FROM maxes) AS id, "
    f"from_stop_id, to_stop_id FROM ({_TRANSFERS_BODY}) x"))
def q_surrogate_keys(spark, sf_dir):
    src, tgt = _split(spark, sf_dir)
    mapping = mg.Mapping(src, SALT, RUN_MS)
    return mg.remap_transfers(src["transfers"], mapping, mg.max_surrogates(tgt).select("max_transfers_id")) \
        .select("id", "from_stop_id", "to_stop_id")


@register("merge_feed_info", _sql(
    "SELECT * FROM src_feed_info s WHERE NOT EXISTS (SELECT 1 FROM tgt_feed_info t "
    "WHERE t.feed_publisher_name = s.feed_publisher_name)"))
def q_merge_feed_info(spark, sf_dir):
    src, tgt, _ = _one(spark, sf_dir)
    return mg.merge_feed_info(src["feed_info"], tgt["feed_info"], ["feed_publisher_name"])


_TYPE = "CASE n % 6 WHEN 5 THEN '9' || n WHEN 4 THEN '1700' ELSE route_type END"


@register("enum_cast", with_fx(
    f"SELECT route_id, route_type, route_type IN ('0', '1', '2', '3', '4', '5', '6', '7', '11', '12', '1700') AS valid "
    f"FROM (SELECT route_id, {_TYPE} AS route_type FROM (SELECT *, CAST(substr(route_id, 2) AS BIGINT) AS n FROM fx_routes) q) q2", "fx_routes"))
def q_enum_cast(spark, sf_dir):
    """Route types checked against the target's labels, which know one extended type; unknown ones are rejected."""
    n = F.substring("route_id", 2, 20).cast("long")
    r = fx.routes(spark, sf_dir).withColumn("route_type", F.when(n % 6 == 5, F.concat(F.lit("9"), n.cast("string")))
                                            .when(n % 6 == 4, F.lit("1700")).otherwise(F.col("route_type")))
    labels = mg.target_labels({"routes": r.where(n % 6 == 4)})
    ok, bad = mg.enum_cast(r, "routes", labels)
    return ok.select("route_id", "route_type", F.lit(True).alias("valid")).unionByName(
        bad.select("route_id", "route_type", F.lit(False).alias("valid")))


_COUNTS = {
    "agency": f"SELECT count(*) FROM src_agency s JOIN {_m('agency', 'm')} ON m.old_id = s.agency_id",
    "routes": f"SELECT count(*) FROM src_routes s JOIN {_m('routes', 'm')} ON m.old_id = s.route_id",
    "stops": f"SELECT count(*) FROM fx_stops s JOIN {_m('stops', 'm')} ON m.old_id = s.stop_id",
    "calendar": f"SELECT count(*) FROM fx_calendar s JOIN {_m('calendar', 'm')} ON m.old_id = s.service_id",
    "calendar_dates": f"SELECT count(*) FROM cal_dates s JOIN {_m('calendar', 'm')} ON m.old_id = s.service_id",
    "shapes": f"SELECT count(*) FROM fx_shapes s JOIN {_m('shapes', 'm')} ON m.old_id = s.shape_id",
    "trips": (f"SELECT count(*) FROM src_trips s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id JOIN {_m('routes', 'r')} "
              f"ON r.old_id = s.route_id JOIN {_m('calendar', 'c')} ON c.old_id = s.service_id"),
    "stop_times": (f"SELECT count(*) FROM src_stop_times s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id "
                   f"JOIN {_m('stops', 'p')} ON p.old_id = s.stop_id"),
    "frequencies": f"SELECT count(*) FROM src_frequencies s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id",
    "transfers": "SELECT count(*) FROM src_transfers",
    "feed_info": ("SELECT count(*) FROM src_feed_info s WHERE NOT EXISTS (SELECT 1 FROM tgt_feed_info t "
                  "WHERE t.feed_publisher_name = s.feed_publisher_name)"),
}


@register("merge_report", _sql(
    "SELECT 'success' AS status, CAST(" + " + ".join(f"({q})" for q in _COUNTS.values()) + " AS BIGINT) "
    "AS total_rows_migrated, CAST((SELECT count(*) FROM tgt_agency WHERE agency_id IN (SELECT agency_id FROM dup)) "
    f"AS INTEGER) AS duplicate_agencies_removed, {mg.TABLES_PROCESSED} AS tables_processed, "
    "CAST((SELECT count(*) FROM mapping) AS BIGINT) AS id_mappings_created, "
    f"'{SOURCE_SCHEMA}' AS source_schema, '{TARGET_SCHEMA}' AS target_schema, "
    "CAST((SELECT count(*) FROM src_trips) - (" + _COUNTS["trips"] + ") AS BIGINT) AS trips_dropped"))
def q_merge_report(spark, sf_dir):
    return _plan(spark, sf_dir).report


_BEFORE = {t: f"SELECT count(*) FROM {s}" for t, s in (
    ("agency", "tgt_agency"), ("routes", "tgt_routes"), ("stops", "fx_stops"), ("calendar", "fx_calendar"),
    ("calendar_dates", "cal_dates"), ("shapes", "fx_shapes"), ("trips", "tgt_trips"), ("stop_times", "tgt_stop_times"),
    ("frequencies", "tgt_frequencies"), ("transfers", "tgt_transfers"), ("feed_info", "tgt_feed_info"))}
_KEPT = {
    "agency": "SELECT count(*) FROM tgt_agency WHERE agency_id NOT IN (SELECT agency_id FROM dup)",
    "routes": "SELECT count(*) FROM tgt_routes WHERE agency_id NOT IN (SELECT agency_id FROM dup)",
    "trips": "SELECT count(*) FROM tgt_trips WHERE route_id NOT IN (SELECT route_id FROM dup_routes)",
    "stop_times": "SELECT count(*) FROM tgt_stop_times WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)",
    "frequencies": "SELECT count(*) FROM tgt_frequencies WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)",
    "transfers": ("SELECT count(*) FROM tgt_transfers tr WHERE NOT EXISTS (SELECT 1 FROM dup_routes r WHERE "
                  "tr.from_route_id = r.route_id OR tr.to_route_id = r.route_id) AND NOT EXISTS (SELECT 1 FROM "
                  "dup_trips t WHERE tr.from_trip_id = t.trip_id OR tr.to_trip_id = t.trip_id)"),
}


# The published tables row by row: what the target keeps and what the source adds.
_ROWS = {
    "agency": ("SELECT agency_id, agency_name FROM tgt_agency WHERE agency_id NOT IN (SELECT agency_id FROM dup)",
               f"SELECT m.new_id, s.agency_name FROM src_agency s JOIN {_m('agency', 'm')} ON m.old_id = s.agency_id"),
    "routes": ("SELECT route_id, agency_id, route_short_name, route_type FROM tgt_routes WHERE agency_id NOT IN (SELECT agency_id FROM dup)",
               f"SELECT r.new_id, a.new_id, s.route_short_name, s.route_type FROM src_routes s JOIN {_m('routes', 'r')} ON r.old_id = s.route_id "
               f"LEFT JOIN {_m('agency', 'a')} ON a.old_id = s.agency_id"),
    "stops": ("SELECT stop_id, stop_name, CAST(stop_lat * 1048576 AS BIGINT) AS stop_lat, CAST(stop_lon * 1048576 AS BIGINT) AS stop_lon, parent_station FROM fx_stops",
              "SELECT m.new_id, s.stop_name, CAST(stop_lat * 1048576 AS BIGINT), CAST(stop_lon * 1048576 AS BIGINT), p.new_id "
              f"FROM fx_stops s JOIN {_m('stops', 'm')} ON m.old_id = s.stop_id LEFT JOIN {_m('stops', 'p')} ON p.old_id = s.parent_station"),
    "calendar": ("SELECT service_id FROM fx_calendar", f"SELECT m.new_id FROM fx_calendar s JOIN {_m('calendar', 'm')} ON m.old_id = s.service_id"),
    "calendar_dates": ("SELECT service_id, date, exception_type FROM cal_dates",
                       f"SELECT m.new_id, s.date, s.exception_type FROM cal_dates s JOIN {_m('calendar', 'm')} ON m.old_id = s.service_id"),
    "shapes": ("SELECT id, shape_id, shape_pt_sequence, CAST(lat * 1048576 AS BIGINT) AS lat, CAST(lon * 1048576 AS BIGINT) AS lon FROM fx_shapes",
               f"SELECT id, shape_id, shape_pt_sequence, CAST(lat * 1048576 AS BIGINT), CAST(lon * 1048576 AS BIGINT) FROM ({_SHAPES_BODY}) q"),
    "trips": ("SELECT trip_id, route_id, service_id, shape_id FROM tgt_trips WHERE route_id NOT IN (SELECT route_id FROM dup_routes)",
              f"SELECT t.new_id, r.new_id, c.new_id, h.new_id FROM src_trips s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id JOIN {_m('routes', 'r')} "
              f"ON r.old_id = s.route_id JOIN {_m('calendar', 'c')} ON c.old_id = s.service_id LEFT JOIN {_m('shapes', 'h')} ON h.old_id = s.shape_id"),
    "stop_times": ("SELECT trip_id, stop_id, stop_sequence, arrival_time FROM tgt_stop_times WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)",
                   f"SELECT t.new_id, p.new_id, s.stop_sequence, s.arrival_time FROM src_stop_times s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id "
                   f"JOIN {_m('stops', 'p')} ON p.old_id = s.stop_id"),
    "frequencies": ("SELECT frequencies_row, trip_id, headway_secs FROM tgt_frequencies WHERE trip_id NOT IN (SELECT trip_id FROM dup_trips)",
                    "SELECT row_number() OVER (ORDER BY t.new_id NULLS FIRST, s.headway_secs NULLS FIRST) + (SELECT max_frequencies_row FROM maxes), t.new_id, s.headway_secs "
                    f"FROM src_frequencies s JOIN {_m('trips', 't')} ON t.old_id = s.trip_id"),
    "transfers": ("SELECT id, from_stop_id, to_stop_id, from_route_id, to_route_id, from_trip_id, to_trip_id FROM tgt_transfers tr WHERE NOT EXISTS (SELECT 1 FROM dup_routes r WHERE "
                  "tr.from_route_id = r.route_id OR tr.to_route_id = r.route_id) AND NOT EXISTS (SELECT 1 FROM dup_trips t WHERE tr.from_trip_id = t.trip_id OR tr.to_trip_id = t.trip_id)",
                  f"SELECT row_number() OVER (ORDER BY {_TR_ORDER}) + (SELECT max_transfers_id FROM maxes), from_stop_id, to_stop_id, from_route_id, to_route_id, from_trip_id, to_trip_id FROM ({_TRANSFERS_BODY}) x"),
    "feed_info": ("SELECT feed_publisher_name, feed_lang, feed_version FROM tgt_feed_info",
                  "SELECT feed_publisher_name, feed_lang, feed_version FROM src_feed_info s WHERE NOT EXISTS (SELECT 1 FROM tgt_feed_info t WHERE t.feed_publisher_name = s.feed_publisher_name)"),
}
_NAMED = {t: [c.split(" AS ")[-1].strip() for c in re.split(r",(?![^(]*\))", kept[len("SELECT "): kept.index(" FROM ")])] for t, (kept, _) in _ROWS.items()}


def _content_sql(t: str) -> str:
    """Order-free sum over all rows of a published table, every column told (absent ones are null)."""
    cells = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" if c in _NAMED[t] else "'-'" for c in sorted(mg.COLUMNS.get(t, _NAMED[t])))
    return (f"SELECT CAST(sum(CAST('0x' || substr(md5({cells}), 1, 8) AS BIGINT)) AS BIGINT) FROM ({_ROWS[t][0]} UNION ALL {_ROWS[t][1]}) q({', '.join(_NAMED[t])})")


@register("merge_gtfs", _sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(({_BEFORE[t]}) AS BIGINT) AS rows_before, "
    f"CAST(({_KEPT.get(t, _BEFORE[t])}) AS BIGINT) AS rows_kept, CAST(({q}) AS BIGINT) AS rows_inserted, "
    f"CAST(({_KEPT.get(t, _BEFORE[t])}) + ({q}) AS BIGINT) AS rows_after, ({_content_sql(t)}) AS content_sum" for t, q in _COUNTS.items())))
def q_merge_gtfs(spark, sf_dir):
    """Whole merge: plan, validate, stage every table in the shared folder, publish, read the published version. Per
    table: target rows before, kept after the deletes, inserted, rows of the published table, and a hash over all its columns."""
    src, tgt = _split(spark, sf_dir)
    plans: list = []
    root = run_dir(spark, "merge")
    tables, report = mg.run_merge(spark, src, tgt, source_schema=SOURCE_SCHEMA, target_schema=TARGET_SCHEMA,
                                  run_ms=RUN_MS, salt=SALT, staging_dir=f"{root}/staged",
                                  feed_info_key=["feed_publisher_name"], result=plans)
    if report.first()["status"] != "success":
        raise RuntimeError(f"merge failed: {report.first().asDict()}")
    mg.publish(spark, f"{root}/log", RUN_MS, f"{root}/staged", list(tables), expected=0)
    now = mg.published(spark, f"{root}/log")
    staged = plans[0].extras["staged"]
    # kept / inserted / after come from the staged files (partitioned by origin), not recomputed
    parts = []
    for t in _COUNTS:
        parts.append(tgt[t].select(F.lit(t).alias("table_name"), F.lit("before").alias("k"), F.lit(None).cast("long").alias("h")))
        parts.append(staged[t].select(F.lit(t).alias("table_name"), F.col(mg.ORIGIN).alias("k"), F.lit(None).cast("long").alias("h")))
        cells = [F.coalesce((F.floor(F.col(c) * 1048576) if now[t].schema[c].dataType == T.DoubleType() else F.col(c)).cast("string"), F.lit("-")) for c in sorted(now[t].columns)]
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("long")
        parts.append(now[t].select(F.lit(t).alias("table_name"), F.lit("after").alias("k"), digest.alias("h")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    n = lambda k: F.count(F.when(F.col("k") == k, 1)).cast("long")
    return u.groupBy("table_name").agg(n("before").alias("rows_before"), n("kept").alias("rows_kept"),
                                       n("inserted").alias("rows_inserted"), n("after").alias("rows_after"), F.sum("h").alias("content_sum"))
