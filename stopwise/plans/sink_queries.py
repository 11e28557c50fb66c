"""Sink queries: write through the real sinks, read back, compare with the fixture records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import with_scalars
from ..functions.timecols import local_time_columns, local_time_sql
from ..operators import arrivals as ar
from ..session import cut_lineage
from ..sinks import lake as lk
from ..sinks import latest as lt
from ..sinks import ndjson as nd
from ..sinks.events import event_key
from ..sinks.lake_schema import SchemaTable
from ..sinks.latest_table import LatestTable
from ..sources import positions as ps
from ..streaming import runner
from ..streaming.arrivals_stream import stream_arrivals
from ..streaming.latest_stream import latest_in_event_time
from .arrival_queries import FEED_AGENCY, KEYS, ON, TOLERANCE, _inputs, _sql as _arr_sql
from .oracle import with_fx
from .registry import register
from .. import fixtures as fx

TOPIC = "gtfs.vehicle.positions.sl"


def _records(spark, sf_dir):
    p = fx.positions(spark, sf_dir)
    key = F.concat(F.lit("vehicle-positions|"), F.col("vehicle_id"), F.lit("|"), F.floor(F.col("ts_ms") / 1000)
                   .cast("string"))
    return p.select(key.alias("record_key"), "agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms",
                    *local_time_columns(F.col("ts_ms")), "seq")


_KEY_SQL = "'vehicle-positions|' || vehicle_id || '|' || CAST(ts_ms // 1000 AS VARCHAR)"
_REC = (f"SELECT {_KEY_SQL} AS record_key, agency, vehicle_id, trip_id, latitude, longitude, ts_ms, "
        f"{local_time_sql('ts_ms')}, seq FROM fx_positions")


def _rsql(body: str) -> str:
    return with_fx(body, "fx_positions", extra={"rec": _REC})


@register("ndjson_dump", _rsql(
    "SELECT seq AS offset, '{\"topic\":\"" + TOPIC + "\",\"partition\":0,\"offset\":' || seq || ',\"timestamp\":' || ts_ms "
    "|| ',\"key\":\"' || record_key || '\"' AS head, agency, vehicle_id, trip_id, latitude, longitude, ts_ms, "
    "to_base64(encode(record_key)) AS key_bytes, TRUE AS bytes_form_ok FROM rec"))
def q_ndjson_dump(spark, sf_dir):
    """Records dumped as JSON lines (a binary copy of the key shows the bytes form), read back."""
    rec = _records(spark, sf_dir).withColumn("key_bytes", F.encode("record_key", "UTF-8"))
    lines = nd.dump_lines(rec, topic=F.lit(TOPIC), offset="seq", timestamp="ts_ms", key="record_key",
                          value_cols=["agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms", "key_bytes"])
    path = runner.run_dir(spark, "dump") + "/vehpos.ndjson"
    nd.append_ndjson(lines, path)
    txt = spark.read.text(path).withColumnRenamed("value", "line")
    vs = T.StructType([T.StructField("offset", T.LongType()), T.StructField("value", T.StructType([
        T.StructField("agency", T.StringType()), T.StructField("vehicle_id", T.StringType()),
        T.StructField("trip_id", T.StringType()), T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("key_bytes", T.StructType([T.StructField("data", T.StringType()),
                                                 T.StructField("encoding", T.StringType())]))]))])
    j = txt.withColumn("j", F.from_json("line", vs))
    kb = F.col("j.value.key_bytes.data")
    return j.select(F.col("j.offset").alias("offset"), F.substring_index("line", ',"value":', 1).alias("head"),
                    *[F.col(f"j.value.{c}").alias(c) for c in ("agency", "vehicle_id", "trip_id", "latitude",
                                                              "longitude", "ts_ms")],
                    kb.alias("key_bytes"),
                    F.col("line").contains(F.concat(F.lit('"key_bytes":{"data":"'), kb,
                                                    F.lit('","encoding":"base64"}'))).alias("bytes_form_ok"))


@register("ndjson_dump_stream", _rsql(
    "SELECT '{\"topic\":\"" + TOPIC + "\",\"partition\":0,\"offset\":' || seq || ',\"timestamp\":' || ts_ms "
    "|| ',\"key\":\"' || record_key || '\",\"value\":{\"agency\":\"' || agency || '\",\"vehicle_id\":\"' || vehicle_id || '\",\"trip_id\":' "
    "|| CASE WHEN seq % 37 = 0 THEN 'null' ELSE '\"' || trip_id || '\"' END || ',\"ts_ms\":' || ts_ms || '}}' AS line FROM rec"))
def q_ndjson_dump_stream(spark, sf_dir):
    """The dump as a running sink: three ordered micro-batches with restarts, the last one written twice; whole lines compared."""
    rec = _records(spark, sf_dir).select("record_key", "agency", "vehicle_id", F.when(F.col("seq") % 37 != 0, F.col("trip_id")).alias("trip_id"), "ts_ms", "seq")
    root = runner.run_dir(spark, "dump_stream")
    path = f"{root}/vehpos.ndjson"

    def told(df):
        return nd.dump_lines(df, topic=TOPIC, offset="seq", timestamp="ts_ms", key="record_key")
    for p in range(3):
        runner.append_in_order(rec, f"{root}/in-{p}", "seq", 3, range(p, p + 1))
        rec_in = spark.read.schema(rec.schema).parquet(f"{root}/in-{p}")
        rec_in.write.mode("append").parquet(f"{root}/in")
        q = nd.dump_stream(told(runner.read_files(spark, f"{root}/in", rec.schema)), path, f"{root}/ckpt", available_now=True)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    nd.write_batch(told(rec_in), 2, path)          # batch 2 again, as after a failure
    return spark.read.text(path).select(F.col("value").alias("line"))


_LATEST = ("SELECT 'vehpos:SL:' || trip_id AS cache_key, arg_max(agency, seq) AS agency, "
           "arg_max(vehicle_id, seq) AS vehicle_id, arg_max(trip_id, seq) AS trip_id, "
           "arg_max(latitude, seq) AS latitude, arg_max(longitude, seq) AS longitude, arg_max(ts_ms, seq) AS ts_ms, "
           "max(seq) AS write_seq FROM rec GROUP BY 1")


def _latest(spark, sf_dir):
    rec = _records(spark, sf_dir).select("agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms", "seq")
    return rec, lt.latest_positions(rec)


@register("latest_positions", _rsql(_LATEST))
def q_latest_positions(spark, sf_dir):
    return _latest(spark, sf_dir)[1]


@register("latest_positions_ttl", with_fx(
    "SELECT cache_key, ts_ms FROM latest WHERE (SELECT max(ts_ms) FROM rec) - ts_ms <= 120000",
    "fx_positions", extra={"rec": _REC, "latest": _LATEST}))
def q_latest_positions_ttl(spark, sf_dir):
    rec, latest = _latest(spark, sf_dir)
    d = with_scalars(latest, rec.agg(F.max("ts_ms").alias("as_of")))
    return lt.expire(d, F.col("as_of")).select("cache_key", "ts_ms")


@register("recent_positions", with_fx(
    "SELECT cache_key, vehicle_id, ts_ms FROM latest WHERE (SELECT max(ts_ms) FROM rec) - ts_ms <= 600000",
    "fx_positions", extra={"rec": _REC, "latest": _LATEST}))
def q_recent_positions(spark, sf_dir):
    rec, latest = _latest(spark, sf_dir)
    d = with_scalars(latest, rec.agg(F.max("ts_ms").alias("as_of")))
    return lt.recent_positions(d, F.col("as_of")).select("cache_key", "vehicle_id", "ts_ms")


_REC_COLS = ("record_key, agency, vehicle_id, trip_id, latitude, longitude, ts_ms, time_local, time_local_extended, "
             "time_local_seconds, time_local_extended_seconds, local_date, prev_local_date, seq")


@register("lake_append_positions", _rsql(f"SELECT {_REC_COLS} FROM rec"))
def q_lake_append_positions(spark, sf_dir):
    """Records as a file stream appended to a lake table partitioned by agency, exactly once."""
    root = runner.run_dir(spark, "lake")
    rec = _records(spark, sf_dir)
    runner.append_in_order(rec, f"{root}/in", "seq", 3, fmt="json")
    stream = ps.read_positions(spark, f"{root}/in", rec.schema, stream=True)
    q = lk.append_stream(stream, f"{root}/positions", f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    return lk.read_lake(spark, f"{root}/positions").select(*[c.strip() for c in _REC_COLS.split(",")])


@register("lake_identity_dedup", _rsql(
    f"SELECT {_REC_COLS} FROM rec QUALIFY row_number() OVER (PARTITION BY agency, vehicle_id, ts_ms ORDER BY seq) = 1"))
def q_lake_identity_dedup(spark, sf_dir):
    return lk.identity_dedup(_records(spark, sf_dir)).select(*[c.strip() for c in _REC_COLS.split(",")])


@register("evolve_schema", _rsql(
    f"SELECT {_REC_COLS} FROM rec WHERE seq % 3 = 0 UNION ALL BY NAME "
    f"SELECT {_REC_COLS}, CAST(seq % 360 AS DOUBLE) AS bearing FROM rec WHERE seq % 3 = 1 UNION ALL BY NAME "
    f"SELECT {_REC_COLS}, CAST(seq AS DOUBLE) / 4 AS bearing, seq * 4294967296 AS odometer FROM rec WHERE seq % 3 = 2 UNION ALL BY NAME "
    f"SELECT {_REC_COLS}, CAST(seq % 7 AS BIGINT) AS odometer FROM rec WHERE seq % 30 = 1"))
def q_evolve_schema(spark, sf_dir):
    """Four appends through the schema log: a new float column, the same as double, a new long column, the same as int
    (cast up). Older files are read through the wider types, without a look at any footer."""
    rec = _records(spark, sf_dir)
    table = SchemaTable(spark, runner.run_dir(spark, "evolve"), ["agency"])
    part = F.col("seq") % 3
    table.append(rec.where(part == 0))
    table.append(rec.where(part == 1).withColumn("bearing", (F.col("seq") % 360).cast("float")))
    table.append(rec.where(part == 2).withColumn("bearing", F.col("seq").cast("double") / 4).withColumn("odometer", F.col("seq") * 4294967296))
    table.append(rec.where(F.col("seq") % 30 == 1).withColumn("odometer", (F.col("seq") % 7).cast("int")))
    return table.read().select(*[c.strip() for c in _REC_COLS.split(",")], "bearing", "odometer")


@register("latest_positions_upsert", _rsql(_LATEST))
def q_latest_positions_upsert(spark, sf_dir):
    """The latest positions kept by a stream: four ordered micro-batches with restarts, the last one applied twice; equals the batch result."""
    rec = _records(spark, sf_dir).select("agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms", "seq")
    root = runner.run_dir(spark, "latest")
    table = LatestTable(spark, f"{root}/table", buckets=16)
    for p in range(4):
        runner.append_in_order(rec, f"{root}/in", "seq", 4, range(p, p + 1))
        q = table.start(runner.read_files(spark, f"{root}/in", rec.schema), f"{root}/ckpt", available_now=True)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    if table.upsert(rec, 3):      # batch 3 again: nothing may change
        raise RuntimeError("a batch was applied twice")
    return table.read()


@register("latest_positions_expiry", with_fx(
    "SELECT cache_key, ts_ms, ts_ms + 120000 AS expired_at_ms FROM (SELECT 'vehpos:SL:' || trip_id AS cache_key, ts_ms, max(ts_ms) OVER () AS newest, "
    "lead(ts_ms) OVER (PARTITION BY trip_id ORDER BY ts_ms, seq) AS following FROM fx_positions) q "
    "WHERE following - ts_ms > 120000 OR (following IS NULL AND ts_ms + 120000 <= newest)", "fx_positions"))
def q_latest_positions_expiry(spark, sf_dir):
    """Every expiry of a latest position, in event time: four micro-batches of time ranges with restarts in between."""
    rec = _records(spark, sf_dir).select("agency", "vehicle_id", "trip_id", "ts_ms", "seq")
    root = runner.run_dir(spark, "expiry")
    rec = runner.staged(rec, root)
    for p in range(4):
        runner.append_in_order(rec, f"{root}/in", "ts_ms", 4, range(p, p + 1))
        stream = latest_in_event_time(runner.read_files(spark, f"{root}/in", rec.schema))
        runner.run_available_now(stream, f"{root}/out", f"{root}/ckpt")
    return spark.read.schema("cache_key string, ts_ms long, expired_at_ms long").parquet(f"{root}/out")


# Records in four time ranges; every tenth of the first range comes with the last (too late), a fifth of all
# comes twice in its range, another fifth again with the next range.
_ARRIVALS = {
    "edges": "SELECT min(ts_ms) AS lo, (max(ts_ms) - min(ts_ms)) // 4 + 1 AS width FROM fx_positions",
    "timed": "SELECT p.agency, p.vehicle_id, p.ts_ms, p.seq, CAST(floor((p.ts_ms - lo) / width) AS BIGINT) AS part FROM fx_positions p, edges",
    "sent": ("SELECT agency, vehicle_id, ts_ms, seq, CASE WHEN part = 0 AND seq % 10 = 3 THEN 3 ELSE part END AS batch, 0 AS copy FROM timed UNION ALL "
             "SELECT agency, vehicle_id, ts_ms, seq, part, 1 FROM timed WHERE seq % 5 = 0 AND NOT (part = 0 AND seq % 10 = 3) UNION ALL "
             "SELECT agency, vehicle_id, ts_ms, seq, part + 1, 2 FROM timed WHERE seq % 5 = 1 AND part < 3 AND NOT (part = 0 AND seq % 10 = 3)"),
    "marks": "SELECT b AS batch, (SELECT max(ts_ms) - 600000 FROM sent s WHERE s.batch < b) AS mark FROM range(4) r(b)",
    "judged": "SELECT sent.*, coalesce(ts_ms <= mark, FALSE) AS late FROM sent JOIN marks USING (batch)",
}


@register("lake_identity_dedup_stream", with_fx(
    "SELECT 'kept' AS what, agency, vehicle_id, ts_ms, CAST(1 AS BIGINT) AS n FROM judged WHERE NOT late GROUP BY agency, vehicle_id, ts_ms UNION ALL "
    "SELECT 'late' AS what, NULL AS agency, NULL AS vehicle_id, NULL AS ts_ms, CAST(count(*) AS BIGINT) AS n FROM judged WHERE late", "fx_positions", extra=_ARRIVALS))
def q_lake_identity_dedup_stream(spark, sf_dir):
    """Repeated and late records through the streaming de-dup, four micro-batches with restarts: what is kept, and how
    many rows lateness dropped (from the query's progress)."""
    rec = fx.positions(spark, sf_dir).select("agency", "vehicle_id", "ts_ms", "seq")
    edges = rec.agg(F.min("ts_ms").alias("lo"), F.expr("(max(ts_ms) - min(ts_ms)) div 4 + 1").alias("width"))
    timed = with_scalars(rec, edges).withColumn("part", F.floor((F.col("ts_ms") - F.col("lo")) / F.col("width"))).drop("lo", "width")
    held = (F.col("part") == 0) & (F.col("seq") % 10 == 3)
    sent = (timed.withColumn("batch", F.when(held, 3).otherwise(F.col("part")))
            .unionByName(timed.where((F.col("seq") % 5 == 0) & ~held).withColumn("batch", F.col("part")))
            .unionByName(timed.where((F.col("seq") % 5 == 1) & (F.col("part") < 3) & ~held).withColumn("batch", F.col("part") + 1)))
    root = runner.run_dir(spark, "dedup")
    late = 0
    for p in range(4):
        sent.where(F.col("batch") == p).drop("batch", "part").write.mode("append").parquet(f"{root}/in")
        stream = runner.read_files(spark, f"{root}/in", rec.schema).withColumn("event_time", F.timestamp_millis("ts_ms"))
        progress = runner.run_available_now(lk.identity_dedup_stream(stream, "event_time"), f"{root}/out", f"{root}/ckpt")
        late += sum(op["numRowsDroppedByWatermark"] for x in progress for op in x["stateOperators"])
    kept = spark.read.parquet(f"{root}/out").select(F.lit("kept").alias("what"), "agency", "vehicle_id", "ts_ms", F.lit(1).cast("long").alias("n"))
    nothing = F.lit(None)
    return kept.unionByName(spark.range(1).select(F.lit("late").alias("what"), nothing.cast("string").alias("agency"), nothing.cast("string").alias("vehicle_id"),
                                                  nothing.cast("long").alias("ts_ms"), F.lit(late).cast("long").alias("n")))


@register("write_arrivals", _arr_sql(
    "SELECT '{\"agency\":\"" + FEED_AGENCY + "\",\"vehicleId\":\"' || vehicle_id || '\",\"tripId\":\"' || "
    "trip_id || '\"}' AS key, '" + FEED_AGENCY + "' AS agency, vehicle_id, "
    "trip_id, stop_id, stop_sequence, arrival_time_millis, "
    + local_time_sql("arrival_time_millis", "arrival_time_local", "arrival_date", "arrival_prev_date")
    + " FROM p WHERE emitted", "p"))
def q_write_arrivals(spark, sf_dir):
    """Streaming arrival events written exactly once (file sink + checkpoint) with a JSON key."""
    samples, rt = _inputs(spark, sf_dir)
    root = runner.run_dir(spark, "arrivals_out")
    samples, rt = runner.staged(samples, root), cut_lineage(rt)
    for p in range(2):  # a restart from the checkpoint in between
        runner.append_in_order(samples, f"{root}/in", "seq", 2, range(p, p + 1))
        stream = runner.read_files(spark, f"{root}/in", samples.schema)
        ev = ar.arrival_events(stream_arrivals(stream, rt, KEYS, on=ON, tolerance_m=TOLERANCE), agency=F.lit(FEED_AGENCY))
        runner.run_available_now(ev.select(event_key().alias("key"), *ev.columns), f"{root}/events",
                                 f"{root}/ckpt", fmt="json")
    schema = T.StructType([T.StructField("key", T.StringType())] + list(ev.schema.fields))
    return spark.read.schema(schema).json(f"{root}/events")
