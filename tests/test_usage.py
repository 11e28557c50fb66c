"""The README's library example, run on files written from the fixtures; it must give the
registered query's result."""

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as se
from stopwise import fixtures as fx
from stopwise.operators import arrivals, ingest, trips
from stopwise.plans.source_queries import _gtfs_tables
from stopwise.session import cut_lineage
from stopwise.sources import gtfs, positions

from .conftest import SF_SMALL


def test_readme_example_matches_registered_query(spark, tmp_path):
    gtfs.write_gtfs(_gtfs_tables(spark, SF_SMALL), str(tmp_path / "gtfs"))
    fx.positions(spark, SF_SMALL).write.parquet(str(tmp_path / "positions"))

    recs = positions.read_positions(spark, str(tmp_path / "positions"), positions.with_seq(positions.POSITION_SCHEMA),
                                    fmt="parquet")
    recs = ingest.require_trip(ingest.blank_to_null(recs))
    g = gtfs.load_gtfs(spark, str(tmp_path / "gtfs"))
    shapes = g["shapes"].withColumnRenamed("shape_pt_lat", "lat").withColumnRenamed("shape_pt_lon", "lon")
    rt, of_trip, lines = trips.trip_runtime(g["trips"], shapes, g["stop_times"], g["stops"],
                                         schedule=fx.schedule(spark, SF_SMALL), for_trips=recs,
                                         materialize=cut_lineage, digits=3)
    p = recs.join(of_trip, "trip_id", "left").withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lon")
    p = p.withColumn("line_id", F.coalesce("line_id", F.lit("")))
    s = trips.project_along(p, lines, block_on="seq", digits=3)
    events = arrivals.arrival_events(arrivals.detect_arrivals(
        s, rt.drop("line_id"), ["agency", "vehicle_id", "trip_id"], on=["trip_id"]))

    want = se.queries()["arrivals_from_positions"](spark, SF_SMALL)
    got = Counter(tuple(r) for r in events.select(*want.columns).collect())
    assert got == Counter(tuple(r) for r in want.collect()) and sum(got.values()) > 0
