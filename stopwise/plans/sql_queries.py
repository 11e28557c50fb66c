"""SQL surface: the lake positions table and the relational GTFS tables as views, queried
with Spark SQL (one catalog in place of the reference's two federated ones)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures as fx
from ..operators import ingest as ing
from .oracle import with_fx
from .registry import register


def register_views(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Temp views ``<prefix><name>`` for every table; returns the view names."""
    names = []
    for name, df in tables.items():
        v = f"{prefix}{name}"
        df.createOrReplaceTempView(v)
        names.append(v)
    return names


FEDERATED = """
SELECT a.agency_name, r.route_short_name, count(*) AS positions, count(DISTINCT p.vehicle_id) AS vehicles,
       max(p.ts_ms) AS last_ts_ms
FROM lake_positions p
JOIN gtfs_trips t ON t.trip_id = p.trip_id
JOIN gtfs_routes r ON r.route_id = t.route_id
JOIN gtfs_agency a ON a.agency_id = r.agency_id
GROUP BY a.agency_name, r.route_short_name
"""


@register("federated_sql", with_fx(
    FEDERATED.replace("lake_positions", "(SELECT agency, NULLIF(vehicle_id, '') AS vehicle_id, NULLIF(trip_id, '') "
                      "AS trip_id, ts_ms FROM fx_positions)")
    .replace("gtfs_trips", "fx_trips").replace("gtfs_routes", "fx_routes").replace("gtfs_agency", "fx_agency")
    .replace("count(*) AS positions", "CAST(count(*) AS BIGINT) AS positions")
    .replace("count(DISTINCT p.vehicle_id) AS vehicles", "CAST(count(DISTINCT p.vehicle_id) AS BIGINT) AS vehicles"),
    "fx_positions", "fx_trips", "fx_routes", "fx_agency"))
def q_federated_sql(spark, sf_dir):
    register_views(spark, {"lake_positions": ing.blank_to_null(fx.positions(spark, sf_dir)),
                           "gtfs_trips": fx.trips(spark, sf_dir), "gtfs_routes": fx.routes(spark, sf_dir),
                           "gtfs_agency": fx.agency(spark, sf_dir)})
    return spark.sql(FEDERATED)
