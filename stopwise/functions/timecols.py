"""Local clock columns derived from epoch milliseconds.

All arithmetic is on longs, so results do not depend on the session time zone and
stay inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the business zone of the feed is UTC+1 all year (no daylight saving).
BUSINESS_ZONE = "UTC+1"

DAY_MS = 86_400_000
DAY_S = 86_400

_FIXED = re.compile(r"^(?:UTC|GMT)?\s*([+-])(\d{1,2})(?::?(\d{2}))?$")


def fixed_offset_ms(zone: str) -> int | None:
    """Offset in ms for zones like ``UTC+1``, ``+01:00``, ``UTC`` or ``Z``; None for region ids."""
    z = zone.strip()
    if z.upper() in ("UTC", "GMT", "Z"):
        return 0
    m = _FIXED.match(z)
    if not m:
        return None
    sign = -1 if m.group(1) == "-" else 1
    return sign * (int(m.group(2)) * 3600 + int(m.group(3) or 0) * 60) * 1000


def local_ms(ms: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Epoch ms shifted to the wall clock of ``zone``."""
    off = fixed_offset_ms(zone)
    if off is not None:
        return ms + F.lit(off)
    # Region ids (with daylight saving): offset at that instant, session-zone independent.
    ts = F.timestamp_millis(ms)
    return F.unix_millis(F.from_utc_timestamp(ts, zone))


def epoch_millis(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Epoch ms of a timestamp column; TIMESTAMP_NTZ is read as UTC wall clock."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    return F.unix_millis(col.cast("timestamp"))


def local_time_columns(ms: Column, zone: str = BUSINESS_ZONE, prefix: str = "time_local",
                       date_name: str = "local_date", prev_date_name: str = "prev_local_date") -> list[Column]:
    """``HH:mm:ss``, the +24 h form, both as seconds of day, local date and the day before.

    Output names: ``{prefix}``, ``{prefix}_extended``, ``{prefix}_seconds``,
    ``{prefix}_extended_seconds``, ``date_name``, ``prev_date_name``.
    """
    lm = local_ms(ms, zone)
    sod = F.pmod(F.floor(lm / 1000), F.lit(DAY_S)).cast("int")
    hh = (sod / 3600).cast("int")
    mi = ((sod % 3600) / 60).cast("int")
    ss = sod % 60
    day = F.floor(lm / DAY_MS).cast("int")
    d = F.date_from_unix_date(day)
    return [
        F.format_string("%02d:%02d:%02d", hh, mi, ss).alias(prefix),
        F.format_string("%02d:%02d:%02d", hh + 24, mi, ss).alias(f"{prefix}_extended"),
        sod.alias(f"{prefix}_seconds"),
        (sod + F.lit(DAY_S)).alias(f"{prefix}_extended_seconds"),
        d.cast("string").alias(date_name),
        F.date_sub(d, 1).cast("string").alias(prev_date_name),
    ]


def local_time_sql(ms: str, prefix: str = "time_local", date_name: str = "local_date",
                   prev_date_name: str = "prev_local_date", offset_ms: int = 3_600_000) -> str:
    """The same columns as DuckDB SQL text (for oracles); ``ms`` must be non-negative."""
    lm = f"(({ms}) + {offset_ms})"
    sod = f"CAST((({lm}) // 1000) % 86400 AS INTEGER)"
    hh, mi, ss = f"({sod} // 3600)", f"(({sod} % 3600) // 60)", f"({sod} % 60)"
    day = f"(DATE '1970-01-01' + CAST(({lm}) // 86400000 AS INTEGER))"
    return ", ".join([
        f"printf('%02d:%02d:%02d', {hh}, {mi}, {ss}) AS {prefix}",
        f"printf('%02d:%02d:%02d', {hh} + 24, {mi}, {ss}) AS {prefix}_extended",
        f"{sod} AS {prefix}_seconds",
        f"{sod} + 86400 AS {prefix}_extended_seconds",
        f"CAST({day} AS VARCHAR) AS {date_name}",
        f"CAST({day} - 1 AS VARCHAR) AS {prev_date_name}",
    ])
