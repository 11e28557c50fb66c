"""Attach one-row aggregates to every row without a driver round trip or a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of ``one_row`` (a global aggregate: exactly one row, a proven size
    bound) to every row of ``df`` as an uncorrelated scalar subquery. Spark evaluates it
    once and uses the value as a constant; no rows of ``df`` move."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumn("_s", packed).select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in one_row.columns])
