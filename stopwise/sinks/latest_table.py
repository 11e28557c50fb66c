"""Latest position per key as a continuously updated table.

A micro-batch is reduced to one row per key, merged with the buckets it touches and written as new files; a
manifest (:mod:`.versions`) then names the files of every bucket. Readers see a whole version; buckets that a batch does not
touch are not rewritten. The manifest also holds the last batch of each stream, so a batch that is run again
after a failure changes nothing, and two writers cannot both build on one version.

A bucket holds about ``keys / buckets`` rows; take enough buckets that one is a small file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .latest import latest_positions
from .versions import VersionLog

BUCKET = "bucket"


class LatestTable:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, order: str = "seq"):
        self.spark, self.folder, self.buckets, self.order = spark, folder.rstrip("/"), buckets, order
        self.log = VersionLog(spark, f"{self.folder}/log")

    def _manifest(self, version: int | None = None) -> tuple[int, dict]:
        at = version if version is not None else (self.log.latest() or 0)
        return at, (self.log.read(at) if at else {"files": {}, "batches": {}, "schema": None})

    def upsert(self, batch: DataFrame, batch_id: int, stream: str = "main") -> bool:
        """Apply one micro-batch of records; False when this stream's batch was applied before. Raises ``Conflict`` when another
        writer got in between (the streaming engine runs the batch again)."""
        at, now = self._manifest()
        if now["batches"].get(stream, -1) >= batch_id:
            return False
        bucket = F.pmod(F.xxhash64("cache_key"), F.lit(self.buckets)).cast("int")
        new = latest_positions(batch, order=self.order).withColumn(BUCKET, bucket).persist()
        try:
            touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())      # at most ``buckets``
            files = dict(now["files"])
            old = [files[str(b)] for b in touched if str(b) in files]
            if old:
                before = self.spark.read.schema(new.drop(BUCKET).schema).parquet(*old)
                both = before.withColumn(BUCKET, bucket).unionByName(new)
                fields = [c for c in new.columns if c not in ("cache_key", BUCKET)]
                merged = (both.groupBy("cache_key", BUCKET).agg(F.max_by(F.struct(*fields), "write_seq").alias("r"))
                          .select("cache_key", *[F.col(f"r.{c}").alias(c) for c in fields], BUCKET))
            else:
                merged = new
            if touched:
                root = f"{self.folder}/data/{at + 1:012d}-{uuid.uuid4().hex[:8]}"
                merged.repartition(min(len(touched), self.buckets), BUCKET).write.partitionBy(BUCKET).parquet(root)
                files |= {str(b): f"{root}/{BUCKET}={b}" for b in touched}
            self.log.commit(at + 1, {"files": files, "batches": now["batches"] | {stream: batch_id}, "schema": new.drop(BUCKET).schema.json(), "touched": touched})
        finally:
            new.unpersist()
        return True

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table of a version (the latest when None); None before the first batch."""
        from pyspark.sql.types import StructType
        import json

        _, now = self._manifest(version)
        if now["schema"] is None:
            return None
        schema = StructType.fromJson(json.loads(now["schema"]))
        files = sorted(set(now["files"].values()))
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def start(self, records: DataFrame, checkpoint: str, stream: str = "main", available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
        """Keep the table up to date from a stream of records."""
        w = records.writeStream.foreachBatch(lambda batch, i: self.upsert(batch, i, stream) and None).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
        return w.start()
