"""Streaming operators: latest positions with expiry, arrivals across a restart."""

import time


from stopwise.streaming import runner
from stopwise.streaming.latest_stream import latest_positions_stream
from stopwise.streaming.state import state_store

SCHEMA = "agency string, vehicle_id string, trip_id string, ts_ms long, seq long"


def test_latest_positions_expire(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("SL", "V1", "T1", 1000, 1), ("SL", "V1", "T1", 2000, 2), ("SL", "V2", "T2", 1500, 3)],
                          SCHEMA).coalesce(1).write.parquet(src)
    stream = runner.read_files(spark, src, spark.read.parquet(src).schema)
    with state_store(spark):
        q = (latest_positions_stream(stream, ttl_s=1).writeStream.format("memory").queryName("latest_ttl")
             .outputMode("update").option("checkpointLocation", str(tmp_path / "ckpt"))
             .trigger(processingTime="1 second").start())
    try:
        # processing-time timers keep the query busy, so poll the sink instead of processAllAvailable()
        deadline = time.time() + 60
        expired = []
        while time.time() < deadline:
            expired = spark.sql("SELECT cache_key FROM latest_ttl WHERE expired").collect()
            if len(expired) == 2:
                break
            time.sleep(1)
        rows = spark.sql("SELECT cache_key, ts_ms FROM latest_ttl WHERE NOT expired").collect()
        assert sorted((r.cache_key, r.ts_ms) for r in rows) == [("vehpos:SL:T1", 2000), ("vehpos:SL:T2", 1500)]
        assert sorted(r.cache_key for r in expired) == ["vehpos:SL:T1", "vehpos:SL:T2"]
    finally:
        q.stop()


def test_stream_from_positions_equals_batch(spark):
    from stopwise.plans import registry
    from .conftest import SF_SMALL
    registry.load_all()
    batch = registry.QUERIES["arrivals_from_positions"](spark, SF_SMALL)
    stream = registry.QUERIES["stream_arrivals_from_positions"](spark, SF_SMALL)
    from collections import Counter
    a = Counter(tuple(r) for r in batch.collect())
    b = Counter(tuple(r) for r in stream.select(*batch.columns).collect())
    assert a == b and sum(a.values()) > 0


def test_ingest_job_from_raw_files(spark, tmp_path):
    """Raw snapshot files -> binaryFile stream -> whole ingest -> lake table; equals the batch path."""
    from collections import Counter

    from stopwise import fixtures as fx
    from stopwise.operators import ingest as ing
    from stopwise.sources import feed as fd
    from stopwise.streaming.ingest_job import start_ingest
    from .conftest import SF_SMALL
    ents = fx.feed_entities(spark, SF_SMALL)
    fd.write_landing_files(fd.encode_snapshots(ents), str(tmp_path / "landing"))
    q = start_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "ckpt"),
                     now_s=1735689600, available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "lake")).drop("snapshot_no", "entity_idx")
    want = ing.ingest_positions(ents, now_s=1735689600).drop("snapshot_no", "entity_idx")
    assert Counter(tuple(r[c] for c in sorted(want.columns)) for r in got.collect()) == \
        Counter(tuple(r[c] for c in sorted(want.columns)) for r in want.collect())


def test_identity_dedup_stream_drops_copies(spark, tmp_path):
    from pyspark.sql import functions as F

    from stopwise.sinks.lake import identity_dedup_stream
    src = str(tmp_path / "in")
    rows = [("SL", "V1", 1000, 1), ("SL", "V1", 1000, 2), ("SL", "V2", 1000, 3), ("SL", "V1", 2000, 4)]
    spark.createDataFrame(rows, "agency string, vehicle_id string, ts_ms long, seq long").coalesce(1).write.parquet(src)
    stream = runner.read_files(spark, src, spark.read.parquet(src).schema).withColumn(
        "event_time", F.timestamp_millis("ts_ms"))
    out = str(tmp_path / "out")
    runner.run_available_now(identity_dedup_stream(stream, "event_time"), out, str(tmp_path / "ckpt"))
    got = sorted((r.vehicle_id, r.ts_ms) for r in spark.read.parquet(out).collect())
    assert got == [("V1", 1000), ("V1", 2000), ("V2", 1000)]
