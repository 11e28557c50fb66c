"""Relational sink: insert-only append of position records, batches of 1000 rows.

Implemented with Spark's JDBC writer (``foreachBatch`` for streams). Schema evolution
is an ``ALTER TABLE ... ADD COLUMN`` per new field, derived from the schema difference.
Not exercised in this repository's checks: that needs a database process, which the
test environment does not start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Table name and insert batch size of the reference's relational sink.
TABLE = "positions"
BATCH_SIZE = 1000

SQL_TYPES = {T.StringType: "VARCHAR(1024)", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
             T.DoubleType: "DOUBLE PRECISION", T.FloatType: "REAL", T.BooleanType: "BOOLEAN",
             T.BinaryType: "BLOB", T.TimestampType: "TIMESTAMP", T.DateType: "DATE"}


def append_jdbc(df: DataFrame, url: str, table: str = TABLE, properties: dict | None = None,
                batch_size: int = BATCH_SIZE) -> None:
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties or {})


def append_jdbc_stream(stream: DataFrame, url: str, checkpoint: str, table: str = TABLE,
                       properties: dict | None = None) -> StreamingQuery:
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda b, _id: append_jdbc(b, url, table, properties)).start())


def evolution_ddl(table: str, existing: T.StructType, incoming: T.StructType) -> list[str]:
    """``ALTER TABLE`` statements adding the incoming fields the table lacks."""
    have = {f.name.lower() for f in existing.fields}
    out = []
    for f in incoming.fields:
        if f.name.lower() not in have:
            out.append(f"ALTER TABLE {table} ADD COLUMN {f.name} {SQL_TYPES.get(type(f.dataType), 'VARCHAR(1024)')}")
    return out
