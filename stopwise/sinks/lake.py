"""Lake table sink: append position records to a table partitioned by agency.

Streaming: a checkpointed Parquet file sink (exactly once), one commit per trigger
(10 s like the reference's commit interval), created on first write, reading the
source from the earliest record. Identity columns (agency, vehicle_id, ts_ms) can be
de-duplicated keeping the first record by arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Table partitioning, identity columns, commit interval.
PARTITION_BY = ["agency"]
IDENTITY = ["agency", "vehicle_id", "ts_ms"]
COMMIT_INTERVAL = "10 seconds"


def append_batch(df: DataFrame, path: str, partition_by: list[str] = PARTITION_BY) -> None:
    df.write.mode("append").partitionBy(*partition_by).option("mergeSchema", "true").parquet(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] = PARTITION_BY,
                  trigger: str | None = COMMIT_INTERVAL, available_now: bool = False) -> StreamingQuery:
    w = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy(*partition_by)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The table with all schema versions merged (added columns are null in older files)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def identity_dedup(df: DataFrame, ids: list[str] = IDENTITY, order: str = "seq") -> DataFrame:
    """First record by ``order`` per identity; an aggregate (map-side partial), not a window,
    so one identity with very many copies stays cheap."""
    others = [c for c in df.columns if c not in ids]
    agg = df.groupBy(*ids).agg(F.min_by(F.struct(*others), F.col(order)).alias("r"))
    return agg.select(*ids, *[F.col(f"r.{c}").alias(c) for c in others])


def identity_dedup_stream(stream: DataFrame, event_time: str, delay: str = "10 minutes",
                          ids: list[str] = IDENTITY) -> DataFrame:
    """Streaming form: duplicates arriving within the watermark delay are dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(ids)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both schema versions; columns only one side has are null on the other."""
    return old.unionByName(new, allowMissingColumns=True)
