"""Static GTFS tables: load the ``*.txt`` CSV files of a feed folder into typed DataFrames.

*Columns by name.* GTFS fixes column names, not their order. Every file's own header line says
which column is which: known names become typed columns wherever they stand, missing ones are null,
unknown ones are kept apart (``Loaded.extras``). Files of one table may have different headers.

*Records.* A quoted value may hold line breaks. Files are read as lines, in splits; a line begins
a record when the quotes before it in its file are even in number. One summary row per split
(how many lines of it hold an odd number) carries that parity across splits, so a file of any size
is read by many tasks, and only the pieces of broken records are shuffled. Files whose lines are
all balanced skip this.

*Rejects.* A row that does not fit (too few or too many values, an unbalanced quote, a value that is no
number, time or date, a missing key; an empty value is null, quoted or not) leaves the table and is kept with the columns that do not fit and its text
(``Loaded.rejects``). Times of day may pass 24:00:00 and come as seconds besides the text.

Unknown files are ignored. ``require_dependencies`` fails when a table that another loaded table
refers to is missing, and ``orphan_report`` counts dangling foreign keys per relation
with anti joins.
"""

from __future__ import annotations

import csv
import os
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

# GTFS file columns and their types (ids and times stay strings).
SCHEMAS: dict[str, list[tuple[str, T.DataType]]] = {
    "agency": [("agency_id", S), ("agency_name", S), ("agency_url", S), ("agency_timezone", S), ("agency_lang", S),
               ("agency_phone", S), ("agency_fare_url", S), ("agency_email", S)],
    "routes": [("route_id", S), ("agency_id", S), ("route_short_name", S), ("route_long_name", S), ("route_desc", S),
               ("route_type", S), ("route_url", S), ("route_color", S), ("route_text_color", S),
               ("route_sort_order", I)],
    "stops": [("stop_id", S), ("stop_code", S), ("stop_name", S), ("stop_desc", S), ("stop_lat", D), ("stop_lon", D),
              ("zone_id", S), ("stop_url", S), ("location_type", S), ("parent_station", S), ("stop_timezone", S),
              ("wheelchair_boarding", S), ("level_id", S), ("platform_code", S)],
    "calendar": [("service_id", S), ("monday", S), ("tuesday", S), ("wednesday", S), ("thursday", S), ("friday", S),
                 ("saturday", S), ("sunday", S), ("start_date", S), ("end_date", S)],
    "calendar_dates": [("service_id", S), ("date", S), ("exception_type", S)],
    "shapes": [("shape_id", S), ("shape_pt_lat", D), ("shape_pt_lon", D), ("shape_pt_sequence", I),
               ("shape_dist_traveled", D)],
    "trips": [("route_id", S), ("service_id", S), ("trip_id", S), ("trip_headsign", S), ("trip_short_name", S),
              ("direction_id", I), ("block_id", S), ("shape_id", S), ("wheelchair_accessible", S), ("bikes_allowed", S)],
    "stop_times": [("trip_id", S), ("arrival_time", S), ("departure_time", S), ("stop_id", S), ("stop_sequence", I),
                   ("stop_headsign", S), ("pickup_type", S), ("drop_off_type", S), ("shape_dist_traveled", D),
                   ("timepoint", S)],
    "frequencies": [("trip_id", S), ("start_time", S), ("end_time", S), ("headway_secs", I), ("exact_times", S)],
    "transfers": [("from_stop_id", S), ("to_stop_id", S), ("transfer_type", S), ("min_transfer_time", I),
                  ("from_route_id", S), ("to_route_id", S), ("from_trip_id", S), ("to_trip_id", S)],
    "feed_info": [("feed_publisher_name", S), ("feed_publisher_url", S), ("feed_lang", S), ("feed_start_date", S),
                  ("feed_end_date", S), ("feed_version", S)],
}

# Foreign keys (table, column, referenced table, referenced column).
FOREIGN_KEYS = [
    ("routes", "agency_id", "agency", "agency_id"),
    ("trips", "route_id", "routes", "route_id"),
    ("trips", "service_id", "calendar", "service_id"),
    ("trips", "shape_id", "shapes", "shape_id"),
    ("stop_times", "trip_id", "trips", "trip_id"),
    ("stop_times", "stop_id", "stops", "stop_id"),
    ("stops", "parent_station", "stops", "stop_id"),
    ("frequencies", "trip_id", "trips", "trip_id"),
    ("transfers", "from_stop_id", "stops", "stop_id"),
    ("transfers", "to_stop_id", "stops", "stop_id"),
    ("transfers", "from_route_id", "routes", "route_id"),
    ("transfers", "to_route_id", "routes", "route_id"),
    ("transfers", "from_trip_id", "trips", "trip_id"),
    ("transfers", "to_trip_id", "trips", "trip_id"),
    ("calendar_dates", "service_id", "calendar", "service_id"),
]

# A table needs these tables to exist (trips may use calendar or calendar_dates).
REQUIRES = {"routes": [["agency"]], "trips": [["routes"], ["calendar", "calendar_dates"]],
            "stop_times": [["trips"], ["stops"]], "frequencies": [["trips"]], "transfers": [["stops"]]}


class MissingDependency(Exception):
    pass


def schema_of(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in SCHEMAS[table]])


def check_dependencies(present: set[str]) -> list[str]:
    problems = []
    for t, needs in REQUIRES.items():
        if t in present:
            for alternatives in needs:
                if not any(a in present for a in alternatives):
                    problems.append(f"{t} requires {' or '.join(alternatives)}")
    return problems


# Columns that hold a time of day (h:mm:ss, also past 24 h) or a date (yyyymmdd), and each table's key.
TIMES = {"stop_times": {"arrival_time": "arrival_seconds", "departure_time": "departure_seconds"},
         "frequencies": {"start_time": "start_seconds", "end_time": "end_seconds"}}
DATES = {"calendar": ["start_date", "end_date"], "calendar_dates": ["date"], "feed_info": ["feed_start_date", "feed_end_date"]}
KEYS = {"routes": "route_id", "stops": "stop_id", "calendar": "service_id", "calendar_dates": "service_id", "shapes": "shape_id",
        "trips": "trip_id", "stop_times": "trip_id", "frequencies": "trip_id"}
CORRUPT = "_corrupt_record"
#: A quoted value with more line breaks than this is an unbalanced quote; its lines are rejected one by one.
MAX_RECORD_LINES = 1000
#: Foreign keys: up to so many referenced keys are broadcast (about 100 bytes each); more are joined in tasks of so many rows.
BROADCAST_KEYS = 1_000_000
ROWS_PER_TASK = 1_000_000


@dataclass
class Loaded:
    """A feed as loaded: typed ``tables``; ``extras``, per table with unknown columns its typed columns and a map ``extra``;
    ``rejects`` (table_name, file, bad_columns, _corrupt_record)."""
    tables: dict[str, DataFrame]
    extras: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None

    def reject_report(self) -> DataFrame:
        """Rejected rows per table, file and column that does not fit."""
        return (self.rejects.select("table_name", "file", F.explode("bad_columns").alias("column"))
                .groupBy("table_name", "file", "column").agg(F.count(F.lit(1)).alias("rows")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, block, pos``: lines with their file, their split's first byte and their order in the split."""
    raw = spark.read.option("lineSep", "\n").text(path)
    value = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    return raw.select(value.alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))


def _odd(value: str = "value") -> Column:
    """1 when a line holds an odd number of quotes."""
    quotes = F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))
    return F.when(F.contains(F.col(value), F.lit('"')), (quotes % 2).cast("int")).otherwise(0)


def header_names(line: str | None) -> list[str]:
    """Column names of a header line; a repeated name keeps its first place only (later ones get a suffix)."""
    names: list[str] = []
    for n in next(csv.reader([(line or "").removeprefix("\ufeff")]), []):
        n = n.strip().lower()
        while n in names:
            n += "_"
        names.append(n)
    return names


def whole_records(lines: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``file, value``: records of lines whose quoted values may hold line breaks (a prefix scan of quote parities).

    Lines of a record that stays open for more than ``max_lines`` lines come one by one."""
    odd = lines.withColumn("odd", _odd())
    # One row per split: its parity, and (from the parity before it) how many records begin in it.
    per_file = Window.partitionBy("file").orderBy("block")
    split = Window.partitionBy("file", "block").orderBy("pos")
    before = per_file.rowsBetween(Window.unboundedPreceding, -1)
    carry = (odd.groupBy("file", "block").agg(F.sum("odd").alias("n"))
             .select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried")))
    inside = (odd.join(carry, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).drop("f", "b")
              .withColumn("open", (F.col("carried") + F.coalesce(F.sum("odd").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2))
    whole = inside.where((F.col("open") == 0) & (F.col("odd") == 0)).select("file", "value")
    # Pieces of broken records: a record is named by the line that begins it.
    piece = inside.where((F.col("open") == 1) | (F.col("odd") == 1)).withColumn("begins", F.col("open") == 0)
    begun = (piece.groupBy("file", "block").agg(F.sum(F.col("begins").cast("long")).alias("k"))
             .select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("earlier")))
    named = (piece.join(begun, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).drop("f", "b")
             .withColumn("record", F.col("earlier") + F.sum(F.col("begins").cast("long")).over(split)))
    sizes = named.groupBy("file", "record").agg(F.count(F.lit(1)).alias("size"))
    long_ones = sizes.where(F.col("size") > max_lines).select("file", "record")
    joined = (named.join(long_ones, ["file", "record"], "left_anti").groupBy("file", "record")
              .agg(F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("parts"))
              .select("file", F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("value")))
    single = named.join(long_ones, ["file", "record"], "left_semi").select("file", "value")
    return whole.unionByName(joined).unionByName(single)


def _seconds(time: Column) -> Column:
    """Seconds of ``h:mm:ss`` (hours may pass 24), null for anything else."""
    t = F.trim(time)
    ok = t.rlike(r"^\d{1,4}:[0-5]\d:[0-5]\d$")
    return F.when(ok, F.split_part(t, F.lit(":"), F.lit(1)).cast("int") * 3600 + F.split_part(t, F.lit(":"), F.lit(2)).cast("int") * 60
                  + F.split_part(t, F.lit(":"), F.lit(3)).cast("int"))


def _parsed(table: str, records: DataFrame, header: list[str]) -> DataFrame:
    """Typed columns, ``extra``, ``file``, ``fits``, ``bad_columns`` and the record's text, from the records of files with one header."""
    schema = T.StructType([T.StructField(f"c{i}", S) for i in range(max(len(header), 1))] + [T.StructField(CORRUPT, S)])
    row = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "quote": '"'})
    at = {n: F.col(f"r.c{i}") for i, n in enumerate(header)}
    # A generated column: a filter on it stays above it. One on a projected column is moved below, where every condition parses the text again.
    records = records.select("file", "value", F.explode(F.array(row)).alias("r"))
    columns, bad = [], [F.when(F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull(), F.lit("*"))]
    for name, kind in SCHEMAS[table]:
        text = at.get(name, F.lit(None).cast(S))
        value = text if kind == S else F.trim(text).try_cast(kind)
        columns.append(value.alias(name))
        if name in at and kind != S:
            bad.append(F.when(text.isNotNull() & (value.isNull() | F.isnan(value.cast("double"))), F.lit(name)))
    for name, out in TIMES.get(table, {}).items():
        text = at.get(name, F.lit(None).cast(S))
        columns.append(_seconds(text).alias(out))
        bad.append(F.when(text.isNotNull() & _seconds(text).isNull(), F.lit(name)))
    for name in DATES.get(table, []):
        if name in at:
            bad.append(F.when(at[name].isNotNull() & ~F.trim(at[name]).rlike(r"^\d{8}$"), F.lit(name)))
    if table in KEYS:
        bad.append(F.when(at.get(KEYS[table], F.lit(None)).isNull(), F.lit(KEYS[table])))
    known = {n for n, _ in SCHEMAS[table]}
    unknown = [n for n in header if n not in known]
    extra = F.map_from_arrays(F.array(*(F.lit(n) for n in unknown)), F.array(*(at[n] for n in unknown))) if unknown else F.lit(None).cast("map<string,string>")
    return records.select(*columns, extra.alias("extra"), "file", F.coalesce(*bad).isNull().alias("fits"), F.array_distinct(F.array_compact(F.array(*bad))).alias("bad_columns"), F.col("value").alias(CORRUPT))


def _load_table(spark: SparkSession, table: str, path: str) -> tuple[DataFrame, list[str]]:
    """All rows of a table's files, and its unknown columns. One pass reads the headers and counts quotes (one row per split)."""
    lines = _lines(spark, path)
    splits = lines.groupBy("file", "block").agg(F.sum(_odd()).alias("odd"), F.min_by("value", "pos").alias("first"))
    files = (splits.groupBy("file").agg(F.max("odd").alias("odd"), F.min_by("first", "block").alias("header"))
             .collect())                                     # one row per file, like Spark's own listing
    groups: dict[tuple[str, bool], list[str]] = {}
    for f in files:
        groups.setdefault((f.header, f.odd > 0), []).append(f.file)
    parts, unknown = [], []
    for (line, broken), names in sorted(groups.items()):
        mine = lines if len(groups) == 1 else lines.where(F.col("file").isin(names))
        records = whole_records(mine) if broken else mine.select("file", "value")
        header = header_names(line)
        unknown += [n for n in header if n not in unknown and n not in {c for c, _ in SCHEMAS[table]}]
        parts.append(_parsed(table, records.where((F.col("value") != line) & (F.col("value") != "")), header))
    if not parts:
        parts = [_parsed(table, lines.select("file", "value"), [])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, unknown


def read_feed(spark: SparkSession, folder: str, require_dependencies: bool = True) -> Loaded:
    """The known GTFS files of ``folder`` (see the module's text); other files are ignored.

    A known file that is absent is simply not in the result (its path fails to resolve). A file
    without a line is an empty table. Lines equal to their file's header are skipped wherever they stand."""
    rows: dict[str, DataFrame] = {}
    unknown: dict[str, list[str]] = {}
    for t in SCHEMAS:
        try:
            rows[t], unknown[t] = _load_table(spark, t, os.path.join(folder, f"{t}.txt"))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    if require_dependencies:
        problems = check_dependencies(set(rows))
        if problems:
            raise MissingDependency("; ".join(problems))
    fits = {t: df.where("fits") for t, df in rows.items()}
    kept = {t: [c for c, _ in SCHEMAS[t]] + list(TIMES.get(t, {}).values()) for t in rows}
    rejects = [df.where("not fits").select(F.lit(t).alias("table_name"), "file", "bad_columns", CORRUPT) for t, df in rows.items()]
    rejected = rejects[0] if rejects else spark.createDataFrame([], f"table_name string, file string, bad_columns array<string>, {CORRUPT} string")
    for r in rejects[1:]:
        rejected = rejected.unionByName(r)
    return Loaded({t: df.select(*kept[t]) for t, df in fits.items()},
                  {t: df.select(*kept[t], "extra") for t, df in fits.items() if unknown[t]}, rejected)


def load_gtfs(spark: SparkSession, folder: str, require_dependencies: bool = True) -> dict[str, DataFrame]:
    """Typed DataFrames for the known GTFS files of ``folder``: the ``tables`` of :func:`read_feed`."""
    return read_feed(spark, folder, require_dependencies).tables


def write_gtfs(tables: dict[str, DataFrame], folder: str) -> None:
    """Write tables as GTFS CSV (``<table>.txt`` folders with a header)."""
    for t, df in tables.items():
        cols = [c for c, _ in SCHEMAS.get(t, [])] or df.columns
        have = set(df.columns)
        out = df.select(*[F.col(c).cast("string") if c in have else F.lit(None).cast("string").alias(c) for c in cols])
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(os.path.join(folder, f"{t}.txt"))


def _sizes(tables: dict[str, DataFrame], keys: list[tuple[str, str, str, str]]) -> dict[tuple[str, str], tuple[int, int]]:
    """(table, column) -> values, and about how many different ones: one pass over each table, for the plan only."""
    sizes = {}
    for t in tables:
        columns = sorted({c for a, c, _, _ in keys if a == t} | {c for _, _, a, c in keys if a == t})
        if columns:
            n = tables[t].agg(*[F.count(c) for c in columns], *[F.approx_count_distinct(c) for c in columns]).first()
            sizes |= {(t, c): (n[i], n[i + len(columns)]) for i, c in enumerate(columns)}
    return sizes


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Dangling foreign keys: (relation, orphan_rows) for every relation whose tables are
    loaded; null references are not orphans. One anti join per relation, unioned.

    Up to ``BROADCAST_KEYS`` referenced keys are broadcast: the references stay where they are. More are dealt
    with their references over tasks of about ``ROWS_PER_TASK`` rows. Left alone, Spark merges the
    partitions of keys, which compress well, until one task sorts tens of millions of them."""
    spark = next(iter(tables.values())).sparkSession
    keys = [(t, c, rt, rc) for t, c, rt, rc in FOREIGN_KEYS if t in tables and rt in tables and c in tables[t].columns]
    if not keys:
        return spark.createDataFrame([], "relation string, orphan_rows long")
    sizes = _sizes(tables, keys)
    parts = []
    for t, c, rt, rc in keys:
        ref = tables[rt].select(F.col(rc).alias("_ref")).where(F.col("_ref").isNotNull())
        src = tables[t].select(F.col(c).alias("_ref")).where(F.col("_ref").isNotNull())
        (known, different), rows = sizes[rt, rc], sizes[t, c][0]
        if different <= BROADCAST_KEYS:
            ref = F.broadcast(ref.distinct())
        else:
            tasks = -(-(known + rows) // ROWS_PER_TASK)
            ref, src = ref.repartition(tasks, "_ref"), src.repartition(tasks, "_ref")
        parts.append(src.join(ref, "_ref", "left_anti").select(F.lit(f"{t}.{c}->{rt}.{rc}").alias("relation")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counts = u.groupBy("relation").agg(F.count(F.lit(1)).alias("orphan_rows"))
    all_rel = spark.createDataFrame([(f"{t}.{c}->{rt}.{rc}",) for t, c, rt, rc in keys], "relation string")
    return all_rel.join(counts, "relation", "left").select(
        "relation", F.coalesce(F.col("orphan_rows"), F.lit(0)).cast("long").alias("orphan_rows"))
