"""Raw feed snapshots: landing folder, body decoding and entity explosion.

The HTTP poller of the reference is replaced by a landing folder (or table) of fetched
snapshot bodies; one row per snapshot ``(feed, snapshot_no, fetched_at, body,
content_encoding)``. Decoding and protobuf parsing are Arrow UDFs over
the binary column (Python's gzip/zlib and the protobuf runtime), entities as Arrow columns; the explode into one
row per entity is Spark's. A snapshot that cannot be decoded yields no entities and
an error text, never a failed query.
"""

from __future__ import annotations

import gzip
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import gtfs_rt

SNAPSHOT_COLUMNS = ["feed", "snapshot_no", "fetched_at", "body", "content_encoding"]

# File extensions of landing files and the content encoding they stand for.
EXTENSION_ENCODING = {".gz": "gzip", ".gzip": "gzip", ".zz": "deflate", ".deflate": "deflate", ".pb": "identity"}

ENTITY_TYPE = T.StructType([
    T.StructField("entity_idx", T.IntegerType()), T.StructField("entity_id", T.StringType()),
    T.StructField("has_vehicle", T.BooleanType()), T.StructField("vehicle_id", T.StringType()),
    T.StructField("entity_ts", T.LongType()), T.StructField("lat", T.FloatType()),
    T.StructField("lon", T.FloatType()), T.StructField("trip_id", T.StringType())])
PARSED_TYPE = T.StructType([T.StructField("header_ts", T.LongType()),
                            T.StructField("entities", T.ArrayType(ENTITY_TYPE)),
                            T.StructField("error", T.StringType())])
_ENTITY = pa.struct(list(to_arrow_schema(ENTITY_TYPE)))
#: Snapshots of a batch that are parsed to Arrow together.
SNAPSHOTS_AT_ONCE = 256
DECODED_TYPE = T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("error", T.StringType())])


def read_landing_folder(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int = 50) -> DataFrame:
    """Snapshots from raw files ``<path>/<feed>/<snapshot_no>.<ext>`` (binaryFile source).

    The extension names the content encoding; ``fetched_at`` is the file time.
    """
    r = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    df = r.format("binaryFile").option("recursiveFileLookup", "true")
    if stream:
        df = df.schema("path string, modificationTime timestamp, length long, content binary")
    df = df.load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.regexp_extract(name, r"(\.[A-Za-z]+)$", 1))
    enc = F.coalesce(*[F.when(ext == k, F.lit(v)) for k, v in EXTENSION_ENCODING.items()], F.lit("identity"))
    return df.select(
        F.element_at(F.split("path", "/"), -2).alias("feed"),
        # a file not named by its snapshot number is ordered by its time
        F.coalesce(F.regexp_extract(name, r"^(\d+)", 1).try_cast("long"), F.unix_millis("modificationTime")).alias("snapshot_no"),
        F.col("modificationTime").alias("fetched_at"),
        F.col("content").alias("body"),
        enc.alias("content_encoding"))


@F.arrow_udf(DECODED_TYPE)
def _decode_udf(body: pa.Array, enc: pa.Array, mode: pa.Array) -> pa.Array:
    out, err = [], []
    for b, e, m in zip(body, enc, mode, strict=True):
        try:
            out.append(gtfs_rt.decompress(bytes(b.as_py()), e.as_py(), m.as_py()))
            err.append(None)
        except (OSError, EOFError, zlib.error, ValueError) as x:
            out.append(None)
            err.append(f"{type(x).__name__}: {x}")
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.array(err, pa.string())], DECODED_TYPE.names)


def decode_body(snapshots: DataFrame, mode: str = "AUTO") -> DataFrame:
    """Add ``payload`` (decompressed body) and ``decode_error``."""
    d = snapshots.withColumn("_d", _decode_udf(F.col("body"), F.col("content_encoding"), F.lit(mode)))
    return d.withColumn("payload", F.col("_d.payload")).withColumn("decode_error", F.col("_d.error")).drop("_d")


def _parsed(payloads: pa.Array) -> pa.Array:
    hs, ents, errs = [], [], []
    for p in payloads:
        if not p.is_valid:
            hs.append(None), ents.append(None), errs.append("no payload")
            continue
        try:
            h, rows = gtfs_rt.decode_snapshot(p.as_py())
            # As Arrow at once: a snapshot that does not fit the columns is a bad one too, and no entity stays a Python object.
            columns = zip(*rows, strict=True) if rows else [()] * len(ENTITY_TYPE)
            ent = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTITY, strict=True)], fields=list(_ENTITY))
            hs.append(pa.scalar(h, pa.int64()).as_py())
            ents.append(ent)
            errs.append(None)
        except Exception as x:  # noqa: BLE001 - any parse failure makes the snapshot bad, not the query
            hs.append(None), ents.append(None), errs.append(f"{type(x).__name__}: {x}")
    size = np.array([0] + [0 if e is None else len(e) for e in ents]).cumsum()
    flat = pa.concat_arrays([e for e in ents if e is not None]) if any(e is not None for e in ents) else pa.array([], _ENTITY)
    lists = pa.ListArray.from_arrays(pa.array(size, pa.int32()), flat, mask=pa.array([e is None for e in ents], pa.bool_()))
    return pa.StructArray.from_arrays([pa.array(hs, pa.int64()), lists, pa.array(errs, pa.string())], PARSED_TYPE.names)


@F.arrow_udf(PARSED_TYPE)
def _parse_udf(payload: pa.Array) -> pa.Array:
    return pa.concat_arrays([_parsed(payload.slice(i, SNAPSHOTS_AT_ONCE)) for i in range(0, max(len(payload), 1), SNAPSHOTS_AT_ONCE)])


def parse_snapshots(decoded: DataFrame) -> DataFrame:
    """One row per snapshot with ``header_ts``, ``entities`` (array) and ``parse_error``."""
    d = decoded.withColumn("_p", _parse_udf(F.col("payload")))
    return (d.withColumn("header_ts", F.col("_p.header_ts")).withColumn("entities", F.col("_p.entities"))
             .withColumn("parse_error", F.coalesce(F.col("decode_error"), F.col("_p.error"))).drop("_p"))


def explode_feed(parsed: DataFrame) -> DataFrame:
    """One row per entity with its snapshot's header ts (float coordinates widened to double)."""
    e = parsed.where(F.col("parse_error").isNull()).select(
        "feed", "snapshot_no", "header_ts", F.explode("entities").alias("e"))
    return e.select("feed", "snapshot_no", "header_ts", "e.entity_idx", "e.entity_id", "e.vehicle_id", "e.entity_ts",
                    F.col("e.lat").cast("double").alias("lat"), F.col("e.lon").cast("double").alias("lon"),
                    "e.trip_id", "e.has_vehicle")


def bad_snapshots(parsed: DataFrame) -> DataFrame:
    """Snapshots that could not be decoded or parsed (the log of the reference)."""
    cols = [c for c in ("feed", "snapshot_no", "fetched_at", "parse_error") if c in parsed.columns]
    return parsed.where(F.col("parse_error").isNotNull()).select(*cols)


# --- building snapshots (landing data derived from entity tables) ------------------------------------

@F.arrow_udf(T.BinaryType())
def _encode_udf(header_ts: pa.Array, entities: pa.Array, encoding: pa.Array) -> pa.Array:
    out = []
    for h, es, enc in zip(header_ts, entities, encoding, strict=True):    # one snapshot's entities are Python objects at a time
        rows = sorted(es.as_py(), key=lambda r: r["entity_idx"])
        raw = gtfs_rt.encode_snapshot(h.as_py(), rows)
        enc = enc.as_py()
        if enc == "gzip":
            raw = gzip.compress(raw, mtime=0)
        elif enc == "deflate":
            raw = zlib.compress(raw)
        elif enc == "raw-deflate":
            c = zlib.compressobj(wbits=-zlib.MAX_WBITS)
            raw = c.compress(raw) + c.flush()
        out.append(raw)
    return pa.array(out, pa.binary())


def encode_snapshots(entities: DataFrame, fetched_at_ms: int = 1704067200000) -> DataFrame:
    """Snapshot rows from an entity table (one group per snapshot, bounded by one feed
    response); the body encoding rotates over identity, gzip, zlib and raw deflate."""
    ent = F.struct("entity_idx", "entity_id", "has_vehicle", "vehicle_id", "entity_ts", "lat", "lon", "trip_id")
    g = entities.groupBy("feed", "snapshot_no").agg(F.first("header_ts").alias("header_ts"),
                                                    F.collect_list(ent).alias("entities"))
    enc_code = F.element_at(F.array(F.lit("identity"), F.lit("gzip"), F.lit("deflate"), F.lit("raw-deflate")),
                            (F.col("snapshot_no") % 4 + 1).cast("int"))
    g = g.withColumn("_enc", enc_code)
    return g.select("feed", "snapshot_no",
                    F.timestamp_millis(F.lit(fetched_at_ms) + F.col("snapshot_no") * 10000).alias("fetched_at"),
                    _encode_udf(F.col("header_ts"), F.col("entities"), F.col("_enc")).alias("body"),
                    F.when(F.col("_enc") == "raw-deflate", F.lit("deflate")).otherwise(F.col("_enc"))
                     .alias("content_encoding"))


def write_landing_files(snapshots: DataFrame, root: str) -> None:
    """Write each snapshot body as a raw file ``<root>/<feed>/<snapshot_no>.<ext>`` (for the
    binaryFile source); each task writes its own rows. Local or mounted folders only
    (plain file IO); on a cluster, land snapshots as a table instead."""
    if root.startswith("file:"):
        root = root[len("file:"):]
    ext = {"gzip": ".gz", "deflate": ".zz", "identity": ".pb"}

    def write(it):
        for pdf in it:
            for feed, no, body, enc in zip(pdf["feed"], pdf["snapshot_no"], pdf["body"], pdf["content_encoding"]):
                d = os.path.join(root, feed)
                os.makedirs(d, exist_ok=True)
                with open(os.path.join(d, f"{int(no):012d}{ext.get(enc, '.pb')}"), "wb") as fh:
                    fh.write(bytes(body))
            yield pd.DataFrame({"n": [len(pdf)]})

    snapshots.select("feed", "snapshot_no", "body", "content_encoding").mapInPandas(write, "n long") \
             .agg(F.sum("n")).collect()
