"""Position records from a topic-like source: JSON or Parquet files (batch or stream).

The broker + Avro registry of the reference become a file stream with the same
record schema; ``kafka``/``from_avro`` can be swapped in where those packages exist.
Malformed lines are kept apart (PERMISSIVE parsing), never a failed query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITION_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()), T.StructField("vehicle_id", T.StringType()),
    T.StructField("trip_id", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("time_local", T.StringType()), T.StructField("time_local_extended", T.StringType()),
    T.StructField("time_local_seconds", T.IntegerType()), T.StructField("time_local_extended_seconds", T.IntegerType()),
    T.StructField("local_date", T.StringType()), T.StructField("prev_local_date", T.StringType())])

CORRUPT = "_corrupt_record"


def with_seq(schema: T.StructType, name: str = "seq") -> T.StructType:
    """A copy of ``schema`` with an order column appended."""
    return T.StructType(list(schema.fields) + [T.StructField(name, T.LongType())])


def read_positions(spark: SparkSession, path: str, schema: T.StructType = POSITION_SCHEMA, fmt: str = "json",
                   stream: bool = False, files_per_batch: int = 1) -> DataFrame:
    r = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    return r.format(fmt).schema(schema).load(path)


def parse_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good records, bad lines) from a text column; a line is bad when it is not a JSON
    object of the schema (``from_json`` PERMISSIVE with a corrupt-record column)."""
    with_bad = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    p = lines.withColumn("_r", F.from_json(F.col(value), with_bad, {"mode": "PERMISSIVE",
                                                                     "columnNameOfCorruptRecord": CORRUPT}))
    bad_cond = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    good = p.where(~bad_cond).select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])
    bad = p.where(bad_cond).select(F.col(value).alias("line"))
    return good, bad


def read_positions_kafka(spark: SparkSession, bootstrap: str, topic: str, avro_schema_json: str,
                         starting_offsets: str = "earliest") -> DataFrame:
    """Position records from a broker topic with Avro values, where the ``kafka`` and
    ``avro`` packages are on the classpath (they are not in this environment). ``seq`` is
    the offset, so the stateful operators keep topic order per partition."""
    from pyspark.sql.avro.functions import from_avro
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
           .option("startingOffsets", starting_offsets).load())
    rec = raw.select(F.col("partition"), F.col("offset").alias("seq"), F.col("key").cast("string").alias("record_key"),
                     from_avro(F.col("value"), avro_schema_json).alias("v"))
    return rec.select("record_key", "partition", "seq", "v.*")
