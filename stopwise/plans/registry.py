"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (  # noqa: F401
        arrival_queries,
        geo_queries,
        ingest_queries,
        merge_queries,
        sink_queries,
        source_queries,
        sql_queries,
        stream_queries,
        transform_queries,
    )
