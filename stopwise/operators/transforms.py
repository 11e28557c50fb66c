"""Per-record transforms of a message frame, for batch and streaming DataFrames alike.

A message frame has the columns ``topic, partition, offset, timestamp, key, value,
headers`` where ``value`` (and possibly ``key``) is a struct and ``headers`` is an
``array<struct<key string, value string>>``. Every transform is one projection.
Schema-level work (renaming fields) only touches column names on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Case styles understood by the case transforms.
CASES = ("LOWER_HYPHEN", "LOWER_UNDERSCORE", "LOWER_CAMEL", "UPPER_CAMEL", "UPPER_UNDERSCORE")
SPARK_MAX_PRECISION = 38


def message_frame(df: DataFrame, *, topic: str | Column, offset: str, timestamp: str, key: str | None,
                  value_cols: Sequence[str], partition: int = 0, headers: Column | None = None) -> DataFrame:
    t = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(t.alias("topic"), F.lit(partition).alias("partition"), F.col(offset).cast("long").alias("offset"),
                     F.col(timestamp).cast("long").alias("timestamp"),
                     (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
                     F.struct(*value_cols).alias("value"),
                     (headers if headers is not None else F.array().cast(
                         "array<struct<key:string,value:string>>")).alias("headers"))


def _fields(df: DataFrame, on: str) -> list[T.StructField]:
    dt = df.schema[on].dataType
    return list(dt.fields) if isinstance(dt, T.StructType) else []


def _rebuild(df: DataFrame, on: str, cols: list[Column]) -> DataFrame:
    return df.withColumn(on, F.struct(*cols))


# --- key/value shaping ----------------------------------------------------------------------------

def value_to_key(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Key = struct of the named value fields."""
    return df.withColumn("key", F.struct(*[F.col(f"value.{f}").alias(f) for f in fields]))


def extract_key_field(df: DataFrame, field: str) -> DataFrame:
    """Key struct replaced by one of its fields."""
    return df.withColumn("key", F.col(f"key.{field}"))


def set_null(df: DataFrame, on: str = "value") -> DataFrame:
    return df.withColumn(on, F.lit(None).cast(df.schema[on].dataType))


def to_json_value(df: DataFrame, output: str = "STRING") -> DataFrame:
    """Value struct as a JSON string (or its UTF-8 bytes)."""
    j = F.to_json(F.col("value"), {"ignoreNullFields": "false"})
    return df.withColumn("value", j if output.upper() == "STRING" else F.encode(j, "UTF-8"))


# --- field level ------------------------------------------------------------------------------------

def bytes_to_string(df: DataFrame, fields: Sequence[str] | None = None, charset: str = "UTF-8",
                    on: str = "value") -> DataFrame:
    """Binary fields decoded with ``charset`` (all binary fields when ``fields`` is None)."""
    cols = []
    for f in _fields(df, on):
        c = F.col(f"{on}.{f.name}")
        if isinstance(f.dataType, T.BinaryType) and (fields is None or f.name in fields):
            c = F.decode(c, charset)
        cols.append(c.alias(f.name))
    return _rebuild(df, on, cols)


def extract_nested_field(df: DataFrame, outer: str, inner: str, output: str, on: str = "value") -> DataFrame:
    return df.withColumn(on, F.col(on).withField(output, F.col(f"{on}.{outer}.{inner}")))


def extract_timestamp(df: DataFrame, field: str, on: str = "value") -> DataFrame:
    """Record timestamp (epoch ms) from an int64 or timestamp field."""
    dt = df.schema[on].dataType[field].dataType
    c = F.col(f"{on}.{field}")
    ms = F.unix_millis(c) if isinstance(dt, T.TimestampType) else c.cast("long")
    return df.withColumn("timestamp", ms)


def header_to_field(df: DataFrame, mappings: Sequence[str], on: str = "value") -> DataFrame:
    """``header:type:field`` mappings: copy the first header with that name into a field."""
    d = df
    for m in mappings:
        h, typ, field = m.split(":")
        # get() is null for a missing header (plain indexing fails under ANSI mode)
        v = F.get(F.filter("headers", lambda x: x["key"] == F.lit(h)), 0)["value"]
        d = d.withColumn(on, F.col(on).withField(field, v.cast(typ.lower())))
    return d


def topic_name_to_field(df: DataFrame, field: str, on: str = "value") -> DataFrame:
    return df.withColumn(on, F.col(on).withField(field, F.col("topic")))


def timestamp_now(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.unix_millis(F.current_timestamp()))


def timestamp_now_field(df: DataFrame, fields: Sequence[str], on: str = "value") -> DataFrame:
    d = df
    for f in fields:
        d = d.withColumn(on, F.col(on).withField(f, F.current_timestamp()))
    return d


def to_long(df: DataFrame, fields: Sequence[str], on: str = "value") -> DataFrame:
    cols = [(F.col(f"{on}.{f.name}").cast("long") if f.name in fields else F.col(f"{on}.{f.name}")).alias(f.name)
            for f in _fields(df, on)]
    return _rebuild(df, on, cols)


def set_maximum_precision(df: DataFrame, max_precision: int, on: str = "value") -> DataFrame:
    """Decimal fields with precision above ``max_precision`` (1..64) are narrowed; Spark's own
    limit is 38, so the effective cap is min(max_precision, 38)."""
    if not 1 <= max_precision <= 64:
        raise ValueError("precision.max must be in [1, 64]")
    cap = min(max_precision, SPARK_MAX_PRECISION)
    cols = []
    for f in _fields(df, on):
        c = F.col(f"{on}.{f.name}")
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > cap:
            c = c.cast(T.DecimalType(cap, min(f.dataType.scale, cap)))
        cols.append(c.alias(f.name))
    return _rebuild(df, on, cols)


def pattern_filter(df: DataFrame, pattern: str, fields: Sequence[str], drop_matches: bool = True,
                   on: str = "value") -> DataFrame:
    """Rows whose named string fields fully match ``pattern`` are dropped (or kept alone)."""
    full = f"^(?:{pattern})$"
    hit = F.lit(False)
    for f in fields:
        hit = hit | F.coalesce(F.col(f"{on}.{f}").rlike(full), F.lit(False))
    return df.where(~hit if drop_matches else hit)


def normalize_schema(versions: Sequence[DataFrame]) -> DataFrame:
    """Rows of every schema version in the newest version's layout (the last one);
    fields a version lacks are null, other fields are cast to the newest types."""
    newest = versions[-1].schema
    out = None
    for v in versions:
        have = {f.name for f in v.schema.fields}
        d = v.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in newest.fields])
        out = d if out is None else out.unionByName(d)
    return out


# --- names ------------------------------------------------------------------------------------------

def _words(name: str, style: str) -> list[str]:
    if style in ("LOWER_HYPHEN",):
        return name.split("-")
    if style in ("LOWER_UNDERSCORE", "UPPER_UNDERSCORE"):
        return name.split("_")
    return [w for w in re.split(r"(?=[A-Z])", name) if w]


def convert_case(name: str, src: str, dst: str) -> str:
    if src not in CASES or dst not in CASES:
        raise ValueError(f"case style must be one of {CASES}")
    w = [x.lower() for x in _words(name, src)]
    if dst == "LOWER_HYPHEN":
        return "-".join(w)
    if dst == "LOWER_UNDERSCORE":
        return "_".join(w)
    if dst == "UPPER_UNDERSCORE":
        return "_".join(w).upper()
    cap = [x[:1].upper() + x[1:] for x in w]
    if dst == "UPPER_CAMEL":
        return "".join(cap)
    return (w[0] if w else "") + "".join(cap[1:])


def change_case(df: DataFrame, src: str, dst: str, on: str = "value") -> DataFrame:
    cols = [F.col(f"{on}.{f.name}").alias(convert_case(f.name, src, dst)) for f in _fields(df, on)]
    return _rebuild(df, on, cols)


def case_column(c: Column, src: str, dst: str) -> Column:
    """The same conversion on string values (for topic names)."""
    if src == "LOWER_HYPHEN":
        words = F.split(F.lower(c), "-")
    elif src in ("LOWER_UNDERSCORE", "UPPER_UNDERSCORE"):
        words = F.split(F.lower(c), "_")
    else:
        words = F.split(F.lower(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2")), "_")
    cap = F.transform(words, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 20)))
    if dst == "LOWER_HYPHEN":
        return F.array_join(words, "-")
    if dst == "LOWER_UNDERSCORE":
        return F.array_join(words, "_")
    if dst == "UPPER_UNDERSCORE":
        return F.upper(F.array_join(words, "_"))
    if dst == "UPPER_CAMEL":
        return F.array_join(cap, "")
    return F.concat(F.element_at(words, 1), F.array_join(F.slice(cap, 2, 1 << 20), ""))


def change_topic_case(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.withColumn("topic", case_column(F.col("topic"), src, dst))


def _java_replacement(rep: str) -> str:
    return re.sub(r"\$(\d+)", r"\\\1", rep)


def pattern_rename(df: DataFrame, pattern: str, replacement: str, case_insensitive: bool = True,
                   on: str = "value") -> DataFrame:
    """Rename fields whose name matches ``pattern`` (Java-style ``$1`` groups in the replacement)."""
    rx = re.compile(pattern, re.IGNORECASE if case_insensitive else 0)
    rep = _java_replacement(replacement)
    cols = []
    for f in _fields(df, on):
        new = rx.sub(rep, f.name) if rx.fullmatch(f.name) else f.name
        cols.append(F.col(f"{on}.{f.name}").alias(new))
    return _rebuild(df, on, cols)
