"""Plan shape guards: no nested-loop or cartesian joins, parquet scans pruned."""

import pytest

import __spark_entry__ as se

from .conftest import SF_SMALL

# Queries that run streams or write files while being built are left out here.
BATCH = ["detect_arrivals", "stop_passages", "vehicle_state", "arrival_events", "ingest_positions", "dedup_vehicle_ts",
         "dedup_snapshots", "merge_stop_times", "merge_transfers", "merge_shapes", "merge_frequencies",
         "merge_feed_info", "merge_report", "surrogate_keys", "latest_positions", "latest_positions_ttl",
         "recent_positions", "lake_identity_dedup", "federated_sql", "gtfs_dependency_check", "trip_stops",
         "pseudo_shape", "shape_segments", "densify_polyline", "geodesic_distance"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(se.queries()[name](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_only_used_columns(spark):
    df = se.queries()["detect_arrivals"](spark, SF_SMALL)
    explained = df._jdf.queryExecution().toString()
    schemas = [x.split(">")[0] for x in explained.split("ReadSchema: struct<")[1:]]
    assert schemas and all(not c.startswith(("o_total", "l_comment", "o_comment", "properties", "event_type")) for x in schemas for c in x.split(","))


def test_lines_are_copied_per_line_not_per_sequence_range(spark):
    """A sixteen times wider sequence range moves no more line rows."""
    from stopwise.operators import trips as tp
    lines = tp.line_table(spark.createDataFrame([("a", i, 59 + i / 1000, 18.0) for i in range(30)], "line_id string, pt_order long, lat double, lon double"))
    for step in (1, 16 << 16):
        pts = spark.createDataFrame([("a" if i % 4 else "b", i * step, 59 + i / 8000, 18.001) for i in range(200)], "line_id string, seq long, lat double, lon double")
        dealt, copies = tp.deal_lines(pts, lines, "line_id", "seq", 50)
        assert dealt.count() == 200 and copies.count() == 3               # 150 points of line a in blocks of 50
        assert tp.project_along(pts, lines, block_on="seq", block_size=50).count() == 200


def test_projection_makes_no_piece_rows(spark):
    """Densified pieces are arithmetic: nothing in the plan generates rows per piece."""
    import __spark_entry__ as se
    plan = se.queries()["project_along"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    generated = [x for x in plan.splitlines() if "Generate" in x]
    assert all("_pblk" in x or "sequence(0" in x for x in generated)      # only the copies of a line that many points share


def test_samples_carry_no_line_in_the_stream(spark):
    """The timetable part of a key travels on its own row: samples have null arrays."""
    from pyspark.sql import functions as F
    from stopwise.streaming import arrivals_stream as st
    samples = spark.createDataFrame([("V", "T", i, float(i), 1000 * i) for i in range(50)], "vehicle_id string, trip_id string, seq long, s_now double, ts_ms long")
    rt = spark.createDataFrame([("T", ["A"], [1], [5.0], [5.0], -1)], "trip_id string, stop_ids array<string>, stop_seqs array<int>, stop_s array<double>, stop_m array<double>, sched_start_ms long")
    seen: dict = {}
    original = type(samples.groupBy("trip_id")).transformWithStateInPandas

    def spy(self, **kw):
        seen["rows"] = self._df
        return original(self, **kw)

    type(samples.groupBy("trip_id")).transformWithStateInPandas = spy
    try:
        st.stream_arrivals(samples, rt, ["vehicle_id", "trip_id"], on=["trip_id"])
    finally:
        type(samples.groupBy("trip_id")).transformWithStateInPandas = original
    rows = seen["rows"]
    assert rows.where("from_timetable").count() == 1 and rows.where(~F.col("from_timetable") & F.col("stop_s").isNotNull()).count() == 0
