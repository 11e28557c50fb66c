"""Arrival events to their output: a checkpointed file sink (exactly once) everywhere, or a
broker topic where the ``kafka``/``avro`` packages exist (at least once, so consumers
de-duplicate on the event key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_key(agency: str = "agency", vehicle_id: str = "vehicle_id", trip_id: str = "trip_id") -> Column:
    """The vehicle key as a JSON object ``{"agency", "vehicleId", "tripId"}``; nulls kept."""
    return F.to_json(F.struct(F.col(agency).alias("agency"), F.col(vehicle_id).alias("vehicleId"),
                              F.col(trip_id).alias("tripId")), {"ignoreNullFields": "false"})


def write_events_files(events: DataFrame, path: str, checkpoint: str, fmt: str = "json") -> StreamingQuery:
    return (events.select(event_key().alias("key"), *events.columns).writeStream.format(fmt)
            .option("checkpointLocation", checkpoint).outputMode("append").start(path))


def write_events_kafka(events: DataFrame, bootstrap: str, topic: str, avro_schema_json: str,
                       checkpoint: str) -> StreamingQuery:
    from pyspark.sql.avro.functions import to_avro
    out = events.select(event_key().alias("key"), to_avro(F.struct(*events.columns), avro_schema_json).alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
