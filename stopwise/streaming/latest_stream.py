"""Latest position per cache key as a stream, entries expiring 120 s after their last write.

:func:`latest_in_event_time` counts those seconds in the records' own time: a watermark and event-time timers
make the expiries a function of the data, whatever the micro-batches and restarts were. State and timer are held by the bucket (:mod:`.buckets`).

:func:`latest_positions_stream` counts them by the clock. Keyed ValueState plus one processing-time timer per key: every record updates its key
and is emitted as the key's new value (``expired`` = false); when a key receives no
record for the TTL its timer fires, the state is cleared and a tombstone (``expired`` =
true) is emitted. A key-value sink applies the stream as upserts and deletes, e.g.
through ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sinks.latest import TTL_S, cache_key
from .buckets import BUCKET, PACKED, bucket_of, groups, key_tuples, pack, unpack

_HELD = pa.schema([("cache_key", pa.string()), ("ts_ms", pa.int64())])
_EVER = np.iinfo(np.int64).min


class LatestWithTtl(StatefulProcessor):
    def __init__(self, schema: T.StructType, ttl_ms: int):
        self.schema, self.ttl_ms = schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        last = pdf.iloc[[-1]].copy()
        self.state.update(tuple(last.iloc[0][f.name] for f in self.schema.fields))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        last["expired"] = False
        yield last

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        row = {f.name: [None] for f in self.schema.fields}
        row["cache_key"] = [key[0]]
        row["expired"] = [True]
        yield pd.DataFrame(row)


class LatestInEventTime(StatefulProcessor):
    """Folds the records of a bucket's keys in event-time order. An entry that no later record follows within the TTL expires at its time
    plus the TTL: seen inside a micro-batch when the next record is further away, else by the bucket's timer, which stands at the earliest
    expiry of its entries."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_write", PACKED)

    def _held(self) -> dict[tuple, int]:
        state = self.last.get()
        table = unpack(bytes(state[0])) if state is not None else _HELD.empty_table()
        return dict(zip(key_tuples([table["cache_key"]]), table["ts_ms"].to_pylist(), strict=True))

    def _keep(self, held: dict[tuple, int]) -> None:
        if held:
            self.last.update((pack(pa.table([[k for k, in held], list(held.values())], schema=_HELD)),))
            self.handle.registerTimer(min(held.values()) + self.ttl_ms)
        else:
            self.last.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(pdf["cache_key"], pdf["ts_ms"].to_numpy(np.int64)) for pdf in rows]
        held = self._held()
        if held:
            self.handle.deleteTimer(min(held.values()) + self.ttl_ms)
        keys, ts = key_tuples([pd.concat([k for k, _ in parts])]), np.concatenate([t for _, t in parts])
        met = {k: held[k] for k in keys if k in held}
        # What is older than the entry that is there does not come back; the entry itself is the first of its key.
        due = ts >= np.fromiter((met.get(k, _EVER) for k in keys), np.int64, len(keys))
        keys = [*met] + [k for k, d in zip(keys, due.tolist(), strict=True) if d]
        ts = np.concatenate([np.fromiter(met.values(), np.int64, len(met)), ts[due]])
        names, order, at = groups(keys, ts)
        ts = ts[order]
        of = np.repeat(np.arange(len(names)), np.diff(at))
        gone = np.flatnonzero((of[1:] == of[:-1]) & (np.diff(ts) > self.ttl_ms))
        held.update(zip(names, ts[at[1:] - 1].tolist(), strict=True))
        self._keep(held)
        if len(gone):
            yield self._expired([names[i][0] for i in of[gone]], ts[gone])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, now = self._held(), timerValues.getCurrentWatermarkInMs()
        gone = [(k, t) for k, t in held.items() if t + self.ttl_ms <= now]
        for k, _ in gone:
            del held[k]
        self._keep(held)
        if gone:
            yield self._expired([k for (k,), _ in gone], np.array([t for _, t in gone], np.int64))

    def _expired(self, keys: list, ts: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"cache_key": pd.Series(keys, dtype=object), "ts_ms": ts, "expired_at_ms": ts + self.ttl_ms})


def latest_in_event_time(records: DataFrame, ttl_s: int = TTL_S, delay: str = "0 seconds") -> DataFrame:
    """Expiries (cache_key, ts_ms, expired_at_ms) of a stream of records; records more than ``delay`` late are dropped."""
    d = (records.withColumn("event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", delay)
         .select(cache_key().alias("cache_key"), "ts_ms", "event_time"))
    return d.withColumn(BUCKET, bucket_of(["cache_key"])).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=LatestInEventTime(ttl_s * 1000), outputStructType="cache_key string, ts_ms long, expired_at_ms long",
        outputMode="Append", timeMode="EventTime")


def latest_positions_stream(records: DataFrame, ttl_s: int = TTL_S) -> DataFrame:
    d = records.withColumn("cache_key", cache_key())
    out = T.StructType(list(d.schema.fields) + [T.StructField("expired", T.BooleanType())])
    return d.groupBy("cache_key").transformWithStateInPandas(
        statefulProcessor=LatestWithTtl(d.schema, ttl_s * 1000), outputStructType=out, outputMode="Update",
        timeMode="ProcessingTime")
