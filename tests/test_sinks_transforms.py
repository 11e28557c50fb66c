"""Exact dump lines, case styles, renames, JDBC evolution DDL, identity de-dup."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.operators import transforms as tr
from stopwise.sinks import jdbc, lake, ndjson


def test_dump_line_shape(spark):
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("ts_ms", T.LongType()),
                           T.StructField("record_key", T.StringType()), T.StructField("flag", T.BooleanType()),
                           T.StructField("raw", T.BinaryType()), T.StructField("note", T.StringType()),
                           T.StructField("pos", T.StructType([T.StructField("lat", T.DoubleType()),
                                                              T.StructField("lon", T.DoubleType())])),
                           T.StructField("tags", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([(7, 1000, None, True, bytearray(b"hi"), None, (59.5, 18.25), ["a", "b"])], schema)
    line = ndjson.dump_lines(df, topic="t", offset="seq", timestamp="ts_ms", key="record_key").first().line
    assert line == ('{"topic":"t","partition":0,"offset":7,"timestamp":1000,"key":null,"value":{"ts_ms":1000,'
                    '"flag":true,"raw":{"data":"aGk=","encoding":"base64"},"note":null,'
                    '"pos":{"lat":59.5,"lon":18.25},"tags":["a","b"]}}')
    assert json.loads(line)["value"]["raw"]["data"] == "aGk="


def test_case_styles():
    assert tr.convert_case("vehicle_id", "LOWER_UNDERSCORE", "UPPER_CAMEL") == "VehicleId"
    assert tr.convert_case("vehicle_id", "LOWER_UNDERSCORE", "LOWER_CAMEL") == "vehicleId"
    assert tr.convert_case("vehicleId", "LOWER_CAMEL", "UPPER_UNDERSCORE") == "VEHICLE_ID"
    assert tr.convert_case("VehicleId", "UPPER_CAMEL", "LOWER_HYPHEN") == "vehicle-id"
    assert tr.convert_case("TRIP_ID", "UPPER_UNDERSCORE", "LOWER_UNDERSCORE") == "trip_id"


def test_topic_case_column(spark):
    df = spark.createDataFrame([("vehicle-positions-sl",), ("gtfsRealtimeFeed",)], "topic string")
    a = df.select(tr.case_column(F.col("topic"), "LOWER_HYPHEN", "UPPER_UNDERSCORE").alias("t")).first().t
    b = df.select(tr.case_column(F.col("topic"), "LOWER_CAMEL", "LOWER_UNDERSCORE").alias("t")).collect()[1].t
    assert a == "VEHICLE_POSITIONS_SL" and b == "gtfs_realtime_feed"


def test_pattern_rename_java_groups(spark):
    df = spark.createDataFrame([(("a", "b", 1),)], "value struct<vehicle_id:string,Trip_ID:string,n:int>")
    out = tr.pattern_rename(df, "(.*)_id", "$1_key")
    assert out.schema["value"].dataType.names == ["vehicle_key", "Trip_key", "n"]


def test_evolution_ddl():
    old = T.StructType([T.StructField("agency", T.StringType())])
    new = T.StructType([T.StructField("agency", T.StringType()), T.StructField("bearing", T.DoubleType())])
    assert jdbc.evolution_ddl("positions", old, new) == ["ALTER TABLE positions ADD COLUMN bearing DOUBLE PRECISION"]


def test_identity_dedup_keeps_first_by_seq_on_a_hot_identity(spark):
    rows = [("SL", "V1", 5, i, float(i)) for i in range(500)] + [("SL", "V2", 5, 9, 1.0)]
    df = spark.createDataFrame(rows, "agency string, vehicle_id string, ts_ms long, seq long, x double")
    got = sorted(tuple(r) for r in lake.identity_dedup(df).collect())
    assert got == [("SL", "V1", 5, 0, 0.0), ("SL", "V2", 5, 9, 1.0)]


def test_header_to_field_missing_header_is_null(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        F.lit("t").alias("topic"), F.struct(F.lit("a").alias("f")).alias("value"),
        F.array(F.struct(F.lit("h1").alias("key"), F.lit("7").alias("value"))).alias("headers"))
    out = tr.header_to_field(df, ["missing:STRING:m", "h1:INT:n"]).select("value.m", "value.n").first()
    assert out.m is None and out.n == 7
