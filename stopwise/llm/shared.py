"""Small helpers that the operators share: tables in the shared folder, Arrow batches."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, ship_package, table_path

__all__ = ["stored", "release", "sweep", "scratch", "documents", "labels", "sliced", "table_path", "ship_package"]

SWEEP_S = 3.0


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, lost executors lose nothing.

    The table stays until :func:`release` drops it (or the folder's owner cleans up after the job)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


_last_sweep = [0.0]


def release(*frames: DataFrame) -> None:
    """Drop stored tables whose successor is written; nothing lazy may read them any more.

    Spark deletes shuffle files when the driver's collector finds their plans gone, which a
    driver with little garbage does rarely: at most every ``SWEEP_S`` seconds it is asked to."""
    for df in frames:
        path = df.__dict__.pop("stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
    if frames and time.monotonic() - _last_sweep[0] > SWEEP_S:
        sweep(frames[0].sparkSession)


def sweep(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    _last_sweep[0] = time.monotonic()
    gc.collect()
    spark._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, "documents"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "labels"))


def crc_fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % mod


def sliced(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def concat_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ranges starts[i] .. starts[i] + lengths[i]."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep].astype(np.int64), lengths[keep].astype(np.int64)
    heads = np.concatenate([[0], np.cumsum(n)[:-1]])
    out[heads] = s
    out[heads[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)
