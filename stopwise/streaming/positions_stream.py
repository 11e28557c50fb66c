"""Raw positions to arrivals as one streaming query.

Position records go to their key's state as they are (coordinates, time, order); the trip's line and
stops are in that state already or come with the key's first row, and the handler projects and detects there
(:mod:`.arrivals_stream`). No line rides on a sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .arrivals_stream import Projection, stream_arrivals

KEYS = ("agency", "vehicle_id", "trip_id")


def trip_table(runtime: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per trip for the stream: the trip runtime (with ``line_id``) and its line's points."""
    return runtime.join(lines, "line_id", "left").drop("line_id")


def stream_arrivals_from_positions(positions: DataFrame, trips: DataFrame, keys: Sequence[str] = KEYS, *,
                                   projection: Projection = Projection(), version: str = "1",
                                   initial: DataFrame | None = None) -> DataFrame:
    """Position records (blank ids as null, trip required) -> projected -> keyed-state arrivals."""
    p = positions.withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lon")
    return stream_arrivals(p, trips, list(keys), on=["trip_id"], projection=projection, version=version, initial=initial)
