"""A log of table versions: one small JSON file per version, created only if nobody else created it.

``commit(n, ...)`` is a compare-and-swap: it succeeds for exactly one of several writers that all read version
``n - 1``. The file is written under another name and renamed without overwriting, through the Hadoop file
context, so any file system Spark writes to will do (HDFS and object stores with an atomic rename give the full
guarantee). Readers list the folder and read one file; data files are never changed once a version names them.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer committed the version first."""

    def __init__(self, version: int):
        super().__init__(f"version {version} exists already")
        self.version = version


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = self._root.getFileSystem(self._conf)
        self._root = self._fs.makeQualified(self._root)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def read(self, version: int | None = None) -> dict | None:
        """The content of a version (the latest when None); None when there is none."""
        version = self.latest() if version is None else version
        if version is None:
            return None
        path = self._path(f"{version:012d}.json")
        if not self._fs.exists(path):
            raise KeyError(f"no version {version} in {self.folder}")
        stream = self._fs.open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def commit(self, version: int, content: dict) -> int:
        """Create ``version``; raises :class:`Conflict` when it exists."""
        self._fs.mkdirs(self._root)
        held, final = self._path(f".{version}-{uuid.uuid4().hex}.tmp"), self._path(f"{version:012d}.json")
        stream = self._fs.create(held, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), self._conf)
            never = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
            context.rename(held, final, never)
        except Py4JJavaError as e:
            self._fs.delete(held, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(version) from None
            raise
        return version
