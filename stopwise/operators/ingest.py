"""Feed entities to position records: filter, snapshot and vehicle de-duplication, typing.

Order is feed order (snapshot number, then entity index), never event time. Both
de-duplications are "compare with the previous eligible item of the same key", done
with the hot-key-safe scan so one busy feed or vehicle does not serialise the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import previous_in_order
from ..functions.timecols import BUSINESS_ZONE, local_time_columns

# Defaults of the position feed.
FEED_NAME = "vehicle-positions"
FEED_AGENCY = "SL"
UNKNOWN_ID = "unknown"
KEY_SEPARATOR = "|"

# Snapshots per block of the snapshot scan.
SNAPSHOT_BLOCK = 1 << 16

POSITION_COLUMNS = ["agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms", "time_local",
                    "time_local_extended", "time_local_seconds", "time_local_extended_seconds",
                    "local_date", "prev_local_date"]


def filter_vehicle_entities(entities: DataFrame) -> DataFrame:
    """Keep entities that carry a vehicle position with coordinates."""
    cond = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    if "has_vehicle" in entities.columns:
        cond = F.coalesce(F.col("has_vehicle"), F.lit(False)) & cond
    return entities.where(cond)


def snapshots_of(entities: DataFrame) -> DataFrame:
    """Snapshot-level rows (feed, snapshot_no, header_ts) of an exploded entity table."""
    return entities.select("feed", "snapshot_no", "header_ts").distinct()


def repeated_snapshots(snapshots: DataFrame) -> DataFrame:
    """(feed, snapshot_no) of snapshots whose header ts is > 0 and equals the last non-zero
    header ts of the feed: the ones the de-dup drops."""
    nz = snapshots.where(F.col("header_ts") > 0).select("feed", "snapshot_no", "header_ts")
    prev = previous_in_order(nz, ["feed"], "snapshot_no", ["header_ts"], block_size=SNAPSHOT_BLOCK)
    return prev.where(F.col("header_ts_prev") == F.col("header_ts")).select("feed", "snapshot_no")


def dedup_snapshots(snapshots: DataFrame) -> DataFrame:
    """Drop a snapshot whose header ts is > 0 and equals the last non-zero header ts of
    the feed; ts 0 always passes and leaves the last value as it was."""
    # The repeated set is usually tiny; AQE broadcasts it when its runtime size allows.
    return snapshots.join(repeated_snapshots(snapshots), ["feed", "snapshot_no"], "left_anti")


def keep_snapshots(entities: DataFrame, kept: DataFrame) -> DataFrame:
    return entities.join(kept.select("feed", "snapshot_no"), ["feed", "snapshot_no"], "left_semi")


def drop_snapshots(entities: DataFrame, repeated: DataFrame) -> DataFrame:
    """Entities minus those of repeated snapshots. The same rows as ``keep_snapshots`` with
    the kept set, but the side that is joined is the (normally tiny) repeated set, which AQE
    can broadcast, so the entities are not shuffled for it."""
    return entities.join(repeated, ["feed", "snapshot_no"], "left_anti")


def dedup_vehicle_ts(entities: DataFrame) -> DataFrame:
    """Drop an entity whose timestamp equals the previous one of the same vehicle (same
    feed), inside and across snapshots. Rows without vehicle id or timestamp pass and
    do not take part in the comparison."""
    eligible = F.col("vehicle_id").isNotNull() & F.col("entity_ts").isNotNull()
    el = entities.where(eligible)
    rest = entities.where(~eligible)
    prev = previous_in_order(el, ["feed", "vehicle_id"], ["snapshot_no", "entity_idx"], ["entity_ts"])
    kept = prev.where(F.col("entity_ts_prev").isNull() | (F.col("entity_ts_prev") != F.col("entity_ts")))
    return kept.drop("entity_ts_prev", "row_no").unionByName(rest)


def effective_ts(entity_ts: Column, header_ts: Column, now_s: Column) -> Column:
    """Seconds: entity ts if > 0, else header ts if > 0, else ``now_s``."""
    return F.coalesce(F.when(entity_ts > 0, entity_ts), F.when(header_ts > 0, header_ts), now_s).cast("long")


def record_key(feed: Column, vehicle_id: Column, entity_id: Column, ts_s: Column) -> Column:
    """``feed|id|ts`` with id = vehicle id, else entity id, else ``unknown``."""
    ident = F.coalesce(vehicle_id, entity_id, F.lit(UNKNOWN_ID))
    return F.concat_ws(KEY_SEPARATOR, feed, ident, ts_s.cast("string"))


def position_record(entities: DataFrame, *, agency: str = FEED_AGENCY, now_s: int | Column,
                    zone: str = BUSINESS_ZONE, with_key: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Final 12-column position record, after the ``keep`` columns and ``record_key``."""
    now = now_s if isinstance(now_s, Column) else F.lit(int(now_s))
    ts_s = effective_ts(F.col("entity_ts"), F.col("header_ts"), now)
    ms = ts_s * 1000
    cols = [F.col(k) for k in keep]
    if with_key:
        cols.append(record_key(F.col("feed"), F.col("vehicle_id"), F.col("entity_id"), ts_s).alias("record_key"))
    trip = F.col("trip_id") if "trip_id" in entities.columns else F.lit(None).cast("string")
    cols += [
        F.lit(agency).alias("agency"),
        F.coalesce(F.col("vehicle_id"), F.lit("")).alias("vehicle_id"),
        F.coalesce(trip, F.lit("")).alias("trip_id"),
        # Coordinates travel as float32 in the feed, then widen to double.
        F.col("lat").cast("float").cast("double").alias("latitude"),
        F.col("lon").cast("float").cast("double").alias("longitude"),
        ms.alias("ts_ms"),
        *local_time_columns(ms, zone),
    ]
    return entities.select(*cols)


def ingest_positions(entities: DataFrame, snapshots: DataFrame | None = None, *, agency: str = FEED_AGENCY,
                     now_s: int | Column, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Filter, snapshot de-dup, vehicle-ts de-dup, key and record.

    Output keeps ``feed``, ``snapshot_no``, ``entity_idx`` as the feed order of the records.
    """
    snaps = snapshots if snapshots is not None else snapshots_of(entities)
    e = filter_vehicle_entities(drop_snapshots(entities, repeated_snapshots(snaps)))
    e = dedup_vehicle_ts(e)
    return position_record(e, agency=agency, now_s=now_s, zone=zone, keep=("snapshot_no", "entity_idx"))


def blank_to_null(positions: DataFrame) -> DataFrame:
    """Empty vehicle/trip ids become null (the record form writes null as "")."""
    return (positions.withColumn("vehicle_id", F.nullif(F.col("vehicle_id"), F.lit("")))
                     .withColumn("trip_id", F.nullif(F.col("trip_id"), F.lit(""))))


def vehicle_key(positions: DataFrame) -> DataFrame:
    """Samples per (agency, vehicle, trip) key; null parts group together."""
    return positions.groupBy("agency", "vehicle_id", "trip_id").agg(
        F.count(F.lit(1)).alias("samples"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def require_trip(positions: DataFrame) -> DataFrame:
    return positions.where(F.col("trip_id").isNotNull() & (F.col("trip_id") != ""))
