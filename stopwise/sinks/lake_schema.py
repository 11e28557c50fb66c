"""Lake table with a schema log: writers agree on the schema, readers do not look into file footers.

Each commit of :mod:`.versions` holds the table's schema. An append may add columns and widen types (``WIDER``); what it
widens or lacks is cast or null in its own files, and older files are read through the wider type. Anything else (a
narrower value for a wider column is cast up; a type that fits neither way) is refused before a file is written. Two writers that
change the schema at once: the second gets the first one's schema and tries again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import Conflict, VersionLog

#: Types a column of the left type may grow into; Parquet files of the old type are read as the new one.
WIDER: dict[str, tuple[str, ...]] = {"tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint",), "float": ("double",)}


class SchemaRefused(ValueError):
    pass


def merged_schema(table: T.StructType, new: T.StructType) -> T.StructType:
    """The table's schema after an append of ``new``: wider types, further columns at the end, all nullable."""
    out = {f.name: f.dataType for f in table.fields}
    for f in new.fields:
        have = out.get(f.name)
        if have is None or f.dataType.simpleString() in WIDER.get(have.simpleString(), ()):
            out[f.name] = f.dataType
        elif have != f.dataType and have.simpleString() not in WIDER.get(f.dataType.simpleString(), ()):
            raise SchemaRefused(f"column {f.name}: {f.dataType.simpleString()} does not fit {have.simpleString()}")
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


class SchemaTable:
    def __init__(self, spark: SparkSession, folder: str, partition_by: list[str] | None = None):
        self.spark, self.folder, self.partition_by = spark, folder.rstrip("/"), list(partition_by or [])
        self.log = VersionLog(spark, f"{self.folder}/_schema")

    def schema(self, version: int | None = None) -> T.StructType:
        found = self.log.read(version)
        return T.StructType.fromJson(json.loads(found["schema"])) if found else T.StructType([])

    def agree(self, new: T.StructType) -> T.StructType:
        """Bring the table's schema up to ``new`` and return it; a version is committed only when it changes."""
        while True:
            at = self.log.latest() or 0
            now = self.schema(at) if at else T.StructType([])
            then = merged_schema(now, new)
            if then == now:
                return now
            try:
                self.log.commit(at + 1, {"schema": then.json()})
                return then
            except Conflict:
                continue

    def append(self, df: DataFrame) -> None:
        schema = self.agree(df.schema)
        have = set(df.columns)
        out = df.select(*[F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        w = out.write.mode("append")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(f"{self.folder}/data")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows with the schema of a version (the latest when None)."""
        schema = self.schema(version)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/data").select(*schema.names)
