"""Record-transform queries over a message frame built from the position records."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import transforms as tr
from .oracle import with_fx
from .registry import register

TOPIC = "gtfs.vehicle.positions.sl"
VALUE = ["agency", "vehicle_id", "trip_id", "latitude", "longitude", "ts_ms"]


def _frame(spark, sf_dir, extra=None):
    p = fx.positions(spark, sf_dir)
    key = F.concat(F.lit("vehicle-positions|"), F.col("vehicle_id"), F.lit("|"), F.floor(F.col("ts_ms") / 1000)
                   .cast("string"))
    p = p.withColumn("record_key", key)
    for name, c in (extra or {}).items():
        p = p.withColumn(name, c)
    headers = F.array(F.struct(F.lit("feed").alias("key"), F.lit("vehicle-positions").alias("value")),
                      F.struct(F.lit("agency").alias("key"), F.col("agency").alias("value")))
    return tr.message_frame(p, topic=TOPIC, offset="seq", timestamp="ts_ms", key="record_key",
                            value_cols=VALUE + list(extra or {}), headers=headers)


def _flat(df, on="value"):
    return df.select("offset", *[F.col(f"{on}.{f.name}").alias(f"{on}_{f.name}")
                                 for f in df.schema[on].dataType.fields])


_KEY = "'vehicle-positions|' || vehicle_id || '|' || CAST(ts_ms // 1000 AS VARCHAR)"


def _sql(body: str) -> str:
    return with_fx(body, "fx_positions")


@register("value_to_key", _sql("SELECT seq AS offset, trip_id AS key_trip_id FROM fx_positions"))
def q_value_to_key(spark, sf_dir):
    return _flat(tr.value_to_key(_frame(spark, sf_dir), ["trip_id"]), "key")


@register("extract_key_field", _sql("SELECT seq AS offset, trip_id AS key FROM fx_positions"))
def q_extract_key_field(spark, sf_dir):
    d = tr.extract_key_field(tr.value_to_key(_frame(spark, sf_dir), ["trip_id"]), "trip_id")
    return d.select("offset", "key")


@register("bytes_to_string", _sql(f"SELECT seq AS offset, {_KEY} AS value_raw, agency AS value_agency FROM fx_positions"))
def q_bytes_to_string(spark, sf_dir):
    d = tr.bytes_to_string(_frame(spark, sf_dir, {"raw": F.encode("record_key", "UTF-8")}), ["raw"])
    return d.select("offset", F.col("value.raw").alias("value_raw"), F.col("value.agency").alias("value_agency"))


_CAMEL = {"agency": "Agency", "vehicle_id": "VehicleId", "trip_id": "TripId", "latitude": "Latitude",
          "longitude": "Longitude", "ts_ms": "TsMs"}


@register("change_case", _sql("SELECT seq AS offset, " + ", ".join(f'{k} AS "value_{v}"' for k, v in _CAMEL.items())
                              + " FROM fx_positions"))
def q_change_case(spark, sf_dir):
    return _flat(tr.change_case(_frame(spark, sf_dir), "LOWER_UNDERSCORE", "UPPER_CAMEL"))


@register("change_topic_case", _sql(
    "SELECT seq AS offset, 'VehiclePositions' || upper(substr(lower(agency), 1, 1)) || substr(lower(agency), 2) "
    "AS topic FROM fx_positions"))
def q_change_topic_case(spark, sf_dir):
    d = _frame(spark, sf_dir).withColumn("topic", F.concat(F.lit("vehicle_positions_"), F.col("value.agency")))
    return tr.change_topic_case(d, "LOWER_UNDERSCORE", "UPPER_CAMEL").select("offset", "topic")


@register("extract_nested_field", _sql("SELECT seq AS offset, latitude AS lat_out FROM fx_positions"))
def q_extract_nested_field(spark, sf_dir):
    d = _frame(spark, sf_dir, {"pos": F.struct("latitude", "longitude")})
    d = tr.extract_nested_field(d, "pos", "latitude", "lat_out")
    return d.select("offset", F.col("value.lat_out").alias("lat_out"))


@register("extract_timestamp", _sql("SELECT seq AS offset, ts_ms - 1000 AS timestamp FROM fx_positions"))
def q_extract_timestamp(spark, sf_dir):
    d = _frame(spark, sf_dir, {"event_ms": F.col("ts_ms") - 1000})
    return tr.extract_timestamp(d, "event_ms").select("offset", "timestamp")


@register("header_to_field", _sql("SELECT seq AS offset, agency AS hdr_agency FROM fx_positions"))
def q_header_to_field(spark, sf_dir):
    d = tr.header_to_field(_frame(spark, sf_dir), ["agency:STRING:hdr_agency"])
    return d.select("offset", F.col("value.hdr_agency").alias("hdr_agency"))


@register("normalize_schema", _sql(
    "SELECT seq AS offset, agency, vehicle_id, CAST(NULL AS DOUBLE) AS bearing FROM fx_positions WHERE seq % 3 = 0 "
    "UNION ALL SELECT seq AS offset, agency, vehicle_id, CAST(seq % 360 AS DOUBLE) AS bearing FROM fx_positions "
    "WHERE seq % 3 <> 0"))
def q_normalize_schema(spark, sf_dir):
    p = fx.positions(spark, sf_dir)
    old = p.where(F.col("seq") % 3 == 0).select(F.col("seq").alias("offset"), "agency", "vehicle_id")
    new = p.where(F.col("seq") % 3 != 0).select(F.col("seq").alias("offset"), "agency", "vehicle_id",
                                                (F.col("seq") % 360).cast("double").alias("bearing"))
    return tr.normalize_schema([old, new])


@register("pattern_filter", _sql("SELECT seq AS offset FROM fx_positions WHERE NOT regexp_full_match(vehicle_id, 'V1[0-9]')"))
def q_pattern_filter(spark, sf_dir):
    return tr.pattern_filter(_frame(spark, sf_dir), "V1[0-9]", ["vehicle_id"]).select("offset")


@register("pattern_rename", _sql(
    "SELECT seq AS offset, agency AS value_agency, vehicle_id AS value_vehicle_key, trip_id AS value_trip_key, "
    "latitude AS value_latitude, longitude AS value_longitude, ts_ms AS value_ts_ms FROM fx_positions"))
def q_pattern_rename(spark, sf_dir):
    return _flat(tr.pattern_rename(_frame(spark, sf_dir), "(.*)_ID", "$1_key"))


@register("set_maximum_precision", _sql(
    "SELECT seq AS offset, CAST(latitude AS DECIMAL(20, 10)) AS lat_dec FROM fx_positions"))
def q_set_maximum_precision(spark, sf_dir):
    d = _frame(spark, sf_dir, {"lat_dec": F.col("latitude").cast("decimal(30,10)")})
    d = tr.set_maximum_precision(d, 20)
    return d.select("offset", F.col("value.lat_dec").alias("lat_dec"))


@register("set_null", _sql("SELECT seq AS offset, CAST(NULL AS VARCHAR) AS key FROM fx_positions"))
def q_set_null(spark, sf_dir):
    return tr.set_null(_frame(spark, sf_dir), "key").select("offset", "key")


def _now_between(value, started: float):
    """Whether a processing time lies between the start of the query's construction and now."""
    return value.between(F.lit(int(started * 1000)), F.unix_millis(F.current_timestamp()))


@register("timestamp_now", _sql("SELECT seq AS offset, TRUE AS is_now FROM fx_positions"))
def q_timestamp_now(spark, sf_dir):
    started = time.time()
    return tr.timestamp_now(_frame(spark, sf_dir)).select("offset", _now_between(F.col("timestamp"), started).alias("is_now"))


@register("timestamp_now_field", _sql("SELECT seq AS offset, TRUE AS is_now FROM fx_positions"))
def q_timestamp_now_field(spark, sf_dir):
    started = time.time()
    d = tr.timestamp_now_field(_frame(spark, sf_dir), ["processed_at"])
    return d.select("offset", _now_between(F.unix_millis("value.processed_at"), started).alias("is_now"))


@register("to_json_value", _sql(
    "SELECT seq AS offset, '{\"agency\":\"' || agency || '\",\"vehicle_id\":\"' || vehicle_id || '\",\"trip_id\":\"' "
    "|| trip_id || '\",\"ts_ms\":' || ts_ms || '}' AS value FROM fx_positions"))
def q_to_json_value(spark, sf_dir):
    p = fx.positions(spark, sf_dir)
    d = tr.message_frame(p, topic=TOPIC, offset="seq", timestamp="ts_ms", key=None,
                         value_cols=["agency", "vehicle_id", "trip_id", "ts_ms"])
    return tr.to_json_value(d).select("offset", "value")


@register("to_long", _sql(
    "SELECT seq AS offset, CAST(trunc(latitude) AS BIGINT) AS value_latitude, CAST(trunc(longitude) AS BIGINT) "
    "AS value_longitude FROM fx_positions"))
def q_to_long(spark, sf_dir):
    d = tr.to_long(_frame(spark, sf_dir), ["latitude", "longitude"])
    return d.select("offset", F.col("value.latitude").alias("value_latitude"),
                    F.col("value.longitude").alias("value_longitude"))


@register("topic_name_to_field", _sql(f"SELECT seq AS offset, '{TOPIC}' AS topic_name FROM fx_positions"))
def q_topic_name_to_field(spark, sf_dir):
    d = tr.topic_name_to_field(_frame(spark, sf_dir), "topic_name")
    return d.select("offset", F.col("value.topic_name").alias("topic_name"))
