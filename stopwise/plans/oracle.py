"""DuckDB SQL text for the fixture tables (FIXTURES.md section 3) and helpers.

These are the second, independent definition of the stand-ins; the Spark side builds
them with the DataFrame API in ``stopwise.fixtures``.
"""

from __future__ import annotations

MS = "(epoch_us(ts) // 1000)"
# A trip of ``orders`` for a user's run number.
_TRIP = "'T' || CAST((user_id * 97 + {run}) % (SELECT max(o_orderkey) + 1 FROM orders) AS STRING)"

FX: dict[str, str] = {
    "fx_agency": "SELECT 'A' || CAST(r_regionkey AS STRING) AS agency_id, r_name AS agency_name FROM region",
    "fx_routes": ("SELECT 'R' || CAST(n_nationkey AS STRING) AS route_id, 'A' || CAST(n_regionkey AS STRING) AS agency_id, "
                  "n_name AS route_short_name, CAST(n_nationkey % 4 AS STRING) AS route_type FROM nation"),
    "fx_stops": ("SELECT 'S' || CAST(s_suppkey AS STRING) AS stop_id, s_name AS stop_name, "
                 "59.0 + CAST(s_suppkey % 97 AS DOUBLE) / 128 AS stop_lat, 18.0 + CAST(s_suppkey % 89 AS DOUBLE) / 128 AS stop_lon, "
                 "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'S' || CAST(s_suppkey - s_suppkey % 5 AS STRING) END AS parent_station "
                 "FROM supplier"),
    "fx_calendar": ("SELECT DISTINCT 'C' || substr(o_orderpriority, 1, 1) AS service_id FROM orders "
                    "WHERE substr(o_orderpriority, 1, 1) <> '5'"),
    "fx_shapes": ("SELECT c_custkey + 1 AS id, 'H' || CAST(c_custkey // 20 AS STRING) AS shape_id, "
                  "CAST(c_custkey % 20 AS INT) AS shape_pt_sequence, "
                  "59.0 + CAST(c_custkey // 20 % 25 AS DOUBLE) / 32 + CAST(c_custkey % 20 AS DOUBLE) / 1024 AS lat, "
                  "18.0 + CAST(c_custkey % 20 AS DOUBLE) / 2048 AS lon FROM customer"),
    "fx_trips": ("SELECT 'T' || CAST(o_orderkey AS STRING) AS trip_id, 'R' || CAST(o_custkey % 25 AS STRING) AS route_id, "
                 "'C' || substr(o_orderpriority, 1, 1) AS service_id, "
                 "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'H' || CAST(o_custkey // 20 AS STRING) END AS shape_id FROM orders"),
    "fx_stop_times": ("SELECT 'T' || CAST(l_orderkey AS STRING) AS trip_id, 'S' || CAST(l_suppkey AS STRING) AS stop_id, "
                      "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, "
                      "l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) AS INT) AS stop_sequence, "
                      "CAST(21600 + (l_orderkey % 1000) * 60 + l_linenumber * 120 AS INT) AS arrival_seconds FROM lineitem"),
    "fx_frequencies": ("SELECT o_orderkey + 1 AS frequencies_row, 'T' || CAST(o_orderkey AS STRING) AS trip_id, "
                       "CAST(600 + o_custkey % 5 * 60 AS INT) AS headway_secs FROM orders"),
    "fx_transfers": ("SELECT p_partkey + 1 AS id, 'S' || CAST(p_partkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS STRING) AS from_stop_id, "
                     "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'S' || CAST((p_partkey + 1) % (SELECT max(s_suppkey) + 1 FROM supplier) AS STRING) END AS to_stop_id, "
                     "'R' || CAST(p_partkey % 25 AS STRING) AS from_route_id, "
                     "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'R' || CAST((p_partkey + 6) % 25 AS STRING) END AS to_route_id, "
                     "CASE WHEN p_partkey % 4 = 0 THEN 'T' || CAST(p_partkey AS STRING) END AS from_trip_id, "
                     "CASE WHEN p_partkey % 6 = 0 THEN 'T' || CAST(p_partkey + 1 AS STRING) END AS to_trip_id FROM part"),
    "fx_positions": ("SELECT 'A' || CAST(user_id % 5 AS STRING) AS agency, "
                     "CASE WHEN event_id % 41 = 0 THEN '' ELSE 'V' || CAST(user_id AS STRING) END AS vehicle_id, "
                     "CASE WHEN event_id % 37 = 0 THEN '' ELSE " + _TRIP.format(run="(i - 1) // 10") + " END AS trip_id, "
                     "59.0 + CAST(user_id % 25 AS DOUBLE) / 32 + CAST((i - 1) % 10 AS DOUBLE) / 512 + CAST(event_id % 7 AS DOUBLE) / 2048 AS latitude, "
                     "18.0 + CAST((i - 1) % 10 AS DOUBLE) / 1024 AS longitude, " + MS + " AS ts_ms, event_id AS seq "
                     "FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) e"),
    "fx_sample_progress": ("SELECT 'V' || CAST(user_id AS STRING) AS vehicle_id, CAST(floor((i - 1) / 10) AS INT) AS trip_no, " + _TRIP.format(run="(i - 1) // 10") + " AS trip_id, "
                           "CAST((i - 1) % 10 * 200 + event_id % 7 * 50 AS DOUBLE) AS s_now, " + MS + " AS ts_ms, event_id AS seq "
                           "FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) e"),
    "fx_stop_progress": ("SELECT trip_id, stop_id || '/' || stop_sequence AS stop_id, stop_sequence, "
                         "CAST(stop_sequence * 175 + CAST(substr(stop_id, 2) AS BIGINT) % 3 * 250 AS DOUBLE) AS stop_s FROM fx_stop_times"),
    "fx_sample_schedule": ("SELECT trip_id, min(ts_ms) - CAST(substr(trip_id, 2) AS BIGINT) % 50 * 60000 AS sched_start_ms "
                           "FROM fx_sample_progress WHERE CAST(substr(trip_id, 2) AS BIGINT) % 3 = 0 GROUP BY trip_id"),
    "fx_feed_entities": ("SELECT feed, snapshot_no, header_ts, entity_idx, entity_id, "
                         + ", ".join(f"CASE WHEN has_vehicle THEN {c} END AS {c}" for c in ("vehicle_id", "entity_ts", "lat", "lon", "trip_id"))
                         + ", has_vehicle FROM (SELECT 'vehicle-positions' AS feed, CAST(floor(event_id / 20) AS BIGINT) AS snapshot_no, "
                         "CASE WHEN floor(event_id / 20) % 9 = 8 THEN 0 ELSE CAST(1704067200 + floor(event_id / 40) * 10 AS BIGINT) END AS header_ts, "
                         "CAST(event_id % 20 AS INT) AS entity_idx, 'E' || CAST(event_id AS STRING) AS entity_id, "
                         "CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'V' || CAST(user_id AS STRING) END AS vehicle_id, "
                         "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 0 ELSE CAST(1704067200 + floor(event_id / 60) * 30 AS BIGINT) END AS entity_ts, "
                         "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 59.0 + CAST(user_id AS DOUBLE) / 1024 END AS lat, "
                         "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 18.0 + CAST(event_id % 20 AS DOUBLE) / 1024 END AS lon, "
                         "CASE WHEN event_id % 23 = 0 THEN NULL ELSE " + _TRIP.format(run="event_id // 20") + " END AS trip_id, "
                         "event_id % 31 <> 0 AS has_vehicle FROM events) x"),
}


def with_fx(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``WITH fx_a AS (...), ... <body>``; ``extra`` adds further named CTEs after the fixtures
    (in dependency order); ``recursive`` allows a CTE to refer to itself."""
    parts = [f"{n} AS ({FX[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body
