"""Continuous ingest: raw snapshot files landing in a folder, through the whole ingest,
appended to the lake table (partitioned by agency) every trigger (10 s by default)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest as ing
from ..sinks.lake import COMMIT_INTERVAL, PARTITION_BY
from ..sources import feed as fd
from ..sources.feed import read_landing_folder
from .dedup_stream import dedup_vehicle_ts_stream, keep_snapshots_stream
from .state import state_store


def ingest_stream(snapshots: DataFrame, now_s: int) -> DataFrame:
    """Snapshot stream -> position records: decode, parse, snapshot de-dup (state per
    feed), explode, filter, vehicle de-dup (state per feed and vehicle), record."""
    parsed = fd.parse_snapshots(fd.decode_body(snapshots)).where("parse_error IS NULL")
    snaps = keep_snapshots_stream(parsed.select("feed", "snapshot_no", "header_ts", "entities"))
    ents = fd.explode_feed(snaps.withColumn("parse_error", F.lit(None).cast("string")))
    ents = ing.filter_vehicle_entities(ents).drop("has_vehicle")
    return ing.position_record(dedup_vehicle_ts_stream(ents), now_s=now_s, keep=("snapshot_no", "entity_idx"))


def start_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, *, now_s: int | None = None,
                 trigger: str = COMMIT_INTERVAL, available_now: bool = False,
                 files_per_batch: int = 50) -> StreamingQuery:
    """Start the stream. ``now_s`` fixes the fallback timestamp for records without any
    (default: the wall clock when the job starts)."""
    snaps = read_landing_folder(spark, landing, stream=True, files_per_batch=files_per_batch)
    records = ingest_stream(snaps, now_s if now_s is not None else int(time.time()))
    w = (records.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy(*PARTITION_BY).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    with state_store(spark):
        return w.start(table)
