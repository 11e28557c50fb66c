"""Settings that a stateful query takes along when it starts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, in so many partitions (the cluster's default parallelism
    unless given; a query fixes the number at its first start). A started query has its own copy of the
    settings, so the session's are as before afterwards."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
