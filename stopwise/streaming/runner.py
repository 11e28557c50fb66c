"""Run file-stream jobs to completion: landing folders, checkpoints, availableNow triggers.

Folders live under the shared checkpoint directory (``spark.checkpoint.dir``), one
fresh sub-folder per run, so nothing on a single machine's local disk is assumed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .state import state_store


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/stopwise/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, root: str) -> DataFrame:
    """``df`` written once below ``root`` and read back: ranges cut from it do not compute it again."""
    df.write.parquet(f"{root}/whole")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/whole")


def append_in_order(df: DataFrame, path: str, order_col: str, parts: int, which: range | None = None,
                    fmt: str = "parquet") -> None:
    """Append ranges ``which`` (default all) of ``parts`` consecutive ranges of ``order_col`` to
    ``path``, each as as many files as the frame has partitions.

    A stream that runs to completion after each range sees the ranges as ordered micro-batches."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return
    width = (hi - lo) // parts + 1
    part = F.floor((F.col(order_col) - F.lit(lo)) / F.lit(width))
    for p in (which if which is not None else range(parts)):
        df.where(part == p).write.mode("append").format(fmt).save(path)


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of a folder's files; without a limit a run takes all new files as one micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).load(path)


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: list[str] | None = None, output_mode: str = "append",
                      state_partitions: int | None = None) -> list[dict]:
    """Process everything available, exactly once into a file sink, then stop. Returns the progress of its micro-batches.

    State settings: see :func:`.state.state_store`.
    """
    with state_store(stream.sparkSession, state_partitions):
        w = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode(output_mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        q = w.trigger(availableNow=True).start(out_path)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return [json.loads(p.json) for p in q.recentProgress]
