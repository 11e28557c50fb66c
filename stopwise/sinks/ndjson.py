"""NDJSON dump: one JSON line per record ``{topic, partition, offset, timestamp, key, value}``.

Nested structs become objects in field order, nulls stay ``null``, binary values become
``{"data": <base64>, "encoding": "base64"}`` (the key order the reference's hash map
produces), dates and timestamps their string form; numbers (decimals too), arrays and maps pass as they are.
Lines are appended as text part files under a folder whose name ends in ``.ndjson``. The streaming dump
writes a sub-folder per micro-batch and overwrites it when the batch runs again, so every line is there once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _normalize(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.BinaryType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(F.base64(c).alias("data"), F.lit("base64").alias("encoding")))
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_normalize(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("string")
    return c


def dump_lines(df: DataFrame, *, topic: str | Column, partition: int | str | Column = 0, offset: str = "seq",
               timestamp: str = "ts_ms", key: str | None = "record_key", value_cols: list[str] | None = None) -> DataFrame:
    """A one-column DataFrame ``line`` (plus ``offset`` for ordering) of dump lines.

    ``topic`` is the topic name (or a Column); the other arguments name columns."""
    col = lambda x: F.col(x) if isinstance(x, str) else (F.lit(x) if isinstance(x, int) else x)
    fields = {f.name: f.dataType for f in df.schema.fields}
    vals = value_cols or [c for c in df.columns if c not in (offset, key)]
    value = F.struct(*[_normalize(F.col(c), fields[c]).alias(c) for c in vals])
    kcol = _normalize(F.col(key), fields[key]) if key else F.lit(None)
    tcol = F.lit(topic) if isinstance(topic, str) else topic
    env = F.struct(tcol.alias("topic"), col(partition).cast("int").alias("partition"),
                   F.col(offset).cast("long").alias("offset"), F.col(timestamp).cast("long").alias("timestamp"),
                   kcol.alias("key"), value.alias("value"))
    return df.select(F.col(offset).alias("offset"), F.to_json(env, JSON_OPTIONS).alias("line"))


def _checked(path: str) -> str:
    if not path.rstrip("/").endswith(".ndjson"):
        raise ValueError("dump target must end in .ndjson")
    return path.rstrip("/")


def append_ndjson(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("append").text(_checked(path))


def write_batch(lines: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch's lines; a record without a line (one that could not be told as JSON) is left out, the rest goes on."""
    lines.where(F.col("line").isNotNull()).select("line").write.mode("overwrite").text(f"{_checked(path)}/batch={batch_id:012d}")


def dump_stream(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """Keep a dump of a stream of :func:`dump_lines`; read it back with ``spark.read.text(path)`` (column ``batch`` besides)."""
    target = _checked(path)
    w = lines.writeStream.foreachBatch(lambda df, i: write_batch(df, i, target)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
