"""Keyed state held by the bucket.

A state call crosses from the Python worker to the JVM and back, some milliseconds a key and micro-batch. So keys are dealt by
hash into ``BUCKETS`` groups; a handler call sees the rows of a whole bucket, reads its keys' state in one call and folds key by
key. State columns travel as one Arrow table. A query fixes the number of buckets at its first start.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 512
BUCKET = "_bucket"
#: A state value that is one packed table.
PACKED = T.StructType([T.StructField("rows", T.BinaryType())])


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def with_text_keys(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with its bucket and with keys as strings: pandas has no null in a whole-number column."""
    text = {k: F.col(k).cast("string") for k in keys}
    return df.withColumn(BUCKET, bucket_of(keys, buckets)).withColumns(text)


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(rows)).read_all()


def key_tuples(columns: Iterable) -> list[tuple]:
    """Keys of a frame's or a table's rows; a null is None."""
    lists = [c.to_pylist() if isinstance(c, pa.ChunkedArray) else [None if pd.isna(x) else x for x in c] for c in columns]
    return list(zip(*lists, strict=True))


def groups(keys: list[tuple], *order: np.ndarray) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Distinct keys, the permutation that brings each key's rows together (stable, by ``order`` inside), and where each begins."""
    code: dict[tuple, int] = {}
    codes = np.fromiter((code.setdefault(k, len(code)) for k in keys), np.int64, len(keys))
    at = np.lexsort((*order[::-1], codes))
    return list(code), at, np.searchsorted(codes[at], np.arange(len(code) + 1))


class ListColumns:
    """Rows of a packed table as plain values: lists become arrays without a Python object per number."""

    def __init__(self, table: pa.Table, names: Sequence[str]):
        self.columns = {}
        for n in names:
            c = table[n].combine_chunks()
            c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
            known = c.is_valid().to_numpy(zero_copy_only=False)
            if pa.types.is_list(c.type):
                self.columns[n] = known, c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)
            else:
                self.columns[n] = known, None, c.to_pylist()

    def row(self, i: int) -> dict:
        return {n: (None if not known[i] else v[i] if at is None else v[at[i]:at[i + 1]]) for n, (known, at, v) in self.columns.items()}
