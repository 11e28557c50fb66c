"""Feed snapshots as a streaming source whose offset is the feed's own position.

Raw files ``<path>/<feed>/<snapshot_no>.<ext>`` in the order of their numbers, which is fetch order
(Spark's file source goes by modification time, and keeps a log of every file). The offset holds, per feed, the
last snapshot number and its header time, so a restarted query goes on behind the last committed snapshot whatever happened to
the files before it; they may be archived or deleted. Only names and one header per feed and batch are read while planning;
bodies are read by the tasks, ``FILES_PER_TASK`` files each.

``path`` is any URI that Arrow's file systems open (local and mounted folders, HDFS, S3, GCS). Files whose
name has no number are ignored; a file that appears with a number below the feed's offset is late and is
not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions import gtfs_rt

NAME = "feed_snapshots"
SCHEMA = "feed string, snapshot_no long, fetched_at timestamp, body binary, content_encoding string"
FILES_PER_TASK = 64
#: File extensions of landing files and the content encoding they stand for.
ENCODINGS = {".gz": "gzip", ".gzip": "gzip", ".zz": "deflate", ".deflate": "deflate", ".pb": "identity"}
_NUMBER = re.compile(r"^(\d+)(\.[A-Za-z]+)?$")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path))


def _listed(files: fs.FileSystem, folder: str) -> Iterator[tuple[str, int, str]]:
    """(feed, snapshot number, path) of every snapshot file."""
    for info in files.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
        named = _NUMBER.match(info.base_name)
        if info.type == fs.FileType.File and named:
            yield os.path.basename(os.path.dirname(info.path)), int(named[1]), info.path


def _encoding(path: str) -> str:
    return ENCODINGS.get(os.path.splitext(path)[1].lower(), "identity")


@dataclass
class Files(InputPartition):
    """Some files of one batch: (feed, number, path)."""
    files: tuple[tuple[str, int, str], ...]


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, path: str, per_batch: int):
        self.path, self.per_batch = path, per_batch
        self.at: dict = {}                       # where the last planned batch ended; set from the checkpoint by partitions()

    def initialOffset(self) -> dict:
        return {}

    def _header(self, files: fs.FileSystem, path: str) -> int | None:
        """Header time of a snapshot; None when its body cannot be read."""
        try:
            with files.open_input_stream(path, compression=None) as f:
                return gtfs_rt.decode_snapshot(gtfs_rt.decompress(f.read(), _encoding(path), "AUTO"))[0]
        except Exception:  # noqa: BLE001 - a bad snapshot is an empty one, never a failed query
            return None

    def latestOffset(self) -> dict:
        files, folder = _open(self.path)
        found: dict[str, list[tuple[int, str]]] = {}
        for feed, number, path in _listed(files, folder):
            found.setdefault(feed, []).append((number, path))
        out = dict(self.at)
        for feed, some in found.items():
            behind = self.at[feed]["snapshot_no"] if feed in self.at else -1
            new = sorted(x for x in some if x[0] > behind)[: self.per_batch]
            if new:
                out[feed] = {"snapshot_no": new[-1][0], "header_ts": self._header(files, new[-1][1])}
        self.at = out
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = {**self.at, **end}
        files, folder = _open(self.path)
        due = sorted((feed, n, path) for feed, n, path in _listed(files, folder)
                     if feed in end and (start[feed]["snapshot_no"] if feed in start else -1) < n <= end[feed]["snapshot_no"])
        return [Files(tuple(due[i: i + FILES_PER_TASK])) for i in range(0, len(due), FILES_PER_TASK)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.path)
        for feed, number, path in partition.files:
            with files.open_input_stream(path, compression=None) as f:
                body = f.read()
            when = files.get_file_info(path).mtime
            yield pa.record_batch([pa.array([feed]), pa.array([number], pa.int64()), pa.array([when], pa.timestamp("us", "UTC")), pa.array([body], pa.binary()),
                                   pa.array([_encoding(path)])], names=["feed", "snapshot_no", "fetched_at", "body", "content_encoding"])


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SnapshotReader:
        return SnapshotReader(self.options["path"], int(self.options.get("snapshotsperbatch", "1000000000")))


def read_snapshots(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """The landing folder as a stream; ``per_batch`` bounds the snapshots of a feed in one micro-batch."""
    spark.dataSource.register(SnapshotSource)
    r = spark.readStream.format(NAME)
    return (r.option("snapshotsPerBatch", per_batch) if per_batch else r).load(path)
