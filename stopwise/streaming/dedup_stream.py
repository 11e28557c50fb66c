"""Streaming de-duplication with keyed state (transformWithStateInPandas).

* snapshots: keyed by feed, state = last non-zero header ts; only (feed, snapshot_no, header_ts) goes there;
* vehicle timestamps: by (feed, vehicle), state = last entity ts, held by the bucket (:mod:`.buckets`); rows without a
  vehicle id or timestamp bypass the state (a stateless branch unioned back).

Inside a micro-batch each key's rows are put in feed order before the fold, so the
stream keeps exactly the rows the batch operators keep.
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

from .buckets import BUCKET, PACKED, bucket_of, groups, key_tuples, pack, unpack

#: Snapshots are dealt into so many groups to meet their verdicts: a group's rows are in memory together.
SNAPSHOT_BUCKETS = 4096
VEHICLE = ("feed", "vehicle_id")
_HELD = pa.schema([("feed", pa.string()), ("vehicle_id", pa.string()), ("ts", pa.int64())])

class SnapshotDedup(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_header_ts", T.StructType([T.StructField("ts", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["snapshot_no"].to_numpy(np.int64), p["header_ts"].to_numpy(np.int64)) for p in rows]
        no, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(no, kind="stable")
        no, h = no[order], h[order]
        held = self.last.get()
        # last non-zero header ts before each snapshot (the state's before the first)
        at = np.maximum.accumulate(np.where(h > 0, np.arange(len(h)), -1))
        at = np.concatenate([[-1], at[:-1]])
        before = np.where(at >= 0, h[np.maximum(at, 0)], held[0] if held is not None else -1)
        keep = ~((h > 0) & (h == before))
        if (h > 0).any():
            self.last.update((int(h[h > 0][-1]),))
        if keep.any():
            yield pd.DataFrame({"feed": [key[0]] * int(keep.sum()), "snapshot_no": no[keep], "header_ts": h[keep]})


class VehicleTsDedup(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_entity_ts", PACKED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).drop(columns=BUCKET, errors="ignore")
        names, order, at = groups(key_tuples(pdf[c] for c in VEHICLE), pdf["snapshot_no"].to_numpy(), pdf["entity_idx"].to_numpy())
        ts = pdf["entity_ts"].to_numpy(np.int64)[order]
        state = self.last.get()
        table = unpack(bytes(state[0])) if state is not None else _HELD.empty_table()
        held = dict(zip(key_tuples(table[c] for c in VEHICLE), table["ts"].to_pylist(), strict=True))
        first = at[:-1]
        keep = np.concatenate([[True], ts[1:] != ts[:-1]])
        keep[first] = [held.get(name) != t for name, t in zip(names, ts[first].tolist(), strict=True)]
        held.update(zip(names, ts[at[1:] - 1].tolist(), strict=True))
        self.last.update((pack(pa.table([*zip(*held)] + [list(held.values())], schema=_HELD)),))
        if keep.any():
            yield pdf.iloc[order[keep]]


class Verdict(StatefulProcessor):
    """Rows of a snapshot pass when the snapshot's verdict came with them; nothing is kept between micro-batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, passed = [], set()
        for pdf in rows:
            verdict = pdf["verdict"].to_numpy(dtype=bool)
            passed.update(key_tuples(pdf.loc[verdict, c] for c in ("feed", "snapshot_no")))
            if not verdict.all():
                held.append(pdf.loc[~verdict].drop(columns=["verdict", BUCKET], errors="ignore"))
        for pdf in held:
            passes = np.fromiter((k in passed for k in key_tuples(pdf[c] for c in ("feed", "snapshot_no"))), bool, len(pdf))
            if passes.any():
                yield pdf[passes]


def dedup_snapshots_stream(snapshots: DataFrame) -> DataFrame:
    """The kept snapshots as (feed, snapshot_no, header_ts): all that a feed's one state sees of them."""
    narrow = snapshots.select("feed", F.col("snapshot_no").cast("long").alias("snapshot_no"), F.col("header_ts").cast("long").alias("header_ts"))
    return narrow.groupBy("feed").transformWithStateInPandas(
        statefulProcessor=SnapshotDedup(), outputStructType=narrow.schema, outputMode="Append", timeMode="None")


def keep_snapshots_stream(snapshots: DataFrame) -> DataFrame:
    """The kept snapshots with all their columns. Only their numbers and header times go through the feed's state; the rest
    is grouped by snapshot, where the verdict meets it within the micro-batch."""
    verdict = dedup_snapshots_stream(snapshots).select("feed", "snapshot_no", F.lit(True).alias("verdict"))
    snapshots = snapshots.withColumn("snapshot_no", F.col("snapshot_no").cast("long"))   # hashed alike on both sides
    both = snapshots.withColumn("verdict", F.lit(False)).unionByName(verdict, allowMissingColumns=True)
    return both.withColumn(BUCKET, bucket_of(("feed", "snapshot_no"), SNAPSHOT_BUCKETS)).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=Verdict(), outputStructType=snapshots.schema, outputMode="Append", timeMode="None")


def dedup_vehicle_ts_stream(entities: DataFrame) -> DataFrame:
    eligible = F.col("vehicle_id").isNotNull() & F.col("entity_ts").isNotNull()
    kept = entities.where(eligible).withColumn(BUCKET, bucket_of(VEHICLE)).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=VehicleTsDedup(), outputStructType=entities.schema, outputMode="Append", timeMode="None")
    return kept.unionByName(entities.where(~eligible))
