"""Merge one GTFS schema into another with id remapping, as set-based DataFrame steps.

A schema is a ``dict[str, DataFrame]`` keyed by GTFS table name. The merge is a pure
function ``(source, target, run_ms, salt) -> (new target tables, report)``:

1. target agencies whose name also exists in the source are duplicates; everything
   under them (routes, trips, stop_times, frequencies, transfers) is removed from the
   target with anti joins (one equi anti join per OR-ed side, never an OR join);
2. every distinct source id of agency, routes, stops, calendar, shapes and trips gets a
   new id ``first two letters of table + "_" + 10 hex of md5(table || old || salt) + "_" + run_ms``;
3. source rows are remapped through the mapping (inner joins where the reference
   inner-joins, so unmapped rows drop; left joins where it left-joins) and appended.

Stops, calendars and shapes of removed agencies stay (the reference keeps orphans).
Nothing is applied unless every step validates (enum labels, id uniqueness); the
report then carries status ``error``.
"""

from __future__ import annotations

from collections.abc import Mapping as AbcMapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sinks.versions import Conflict, VersionLog

# GTFS table columns in insert order.
COLUMNS: dict[str, list[str]] = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang", "agency_phone",
               "agency_fare_url", "agency_email"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_desc", "route_type",
               "route_url", "route_color", "route_text_color", "route_sort_order"],
    "stops": ["stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id", "stop_url",
              "location_type", "parent_station", "stop_timezone", "wheelchair_boarding", "level_id", "platform_code"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
                 "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "shapes": ["id", "shape_id", "shape_pt_sequence", "lat", "lon", "shape_dist_traveled"],
    "trips": ["trip_id", "route_id", "service_id", "trip_headsign", "trip_short_name", "direction_id", "block_id",
              "shape_id", "wheelchair_accessible", "bikes_allowed"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence", "stop_sequence_consec",
                   "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled", "timepoint",
                   "trip_start_time"],
    "frequencies": ["frequencies_row", "trip_id", "start_time", "end_time", "headway_secs", "exact_times"],
    "transfers": ["id", "from_stop_id", "to_stop_id", "transfer_type", "min_transfer_time", "from_route_id",
                  "to_route_id", "from_trip_id", "to_trip_id"],
}

# Tables whose ids are remapped, with their id column, in mapping order.
MAPPED = [("agency", "agency_id"), ("routes", "route_id"), ("stops", "stop_id"), ("calendar", "service_id"),
          ("shapes", "shape_id"), ("trips", "trip_id")]

# Enum columns and the target enum type each is cast to.
ENUM_COLUMNS: dict[str, dict[str, str]] = {
    "routes": {"route_type": "route_type_val"},
    "stops": {"location_type": "location_type_val", "wheelchair_boarding": "wheelchair_boarding_val"},
    "calendar": {d: "availability" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
                                              "sunday")},
    "calendar_dates": {"exception_type": "exception_type_v"},
    "trips": {"wheelchair_accessible": "wheelchair_accessibility", "bikes_allowed": "bikes_allowance"},
    "stop_times": {"pickup_type": "pickup_drop_off_type", "drop_off_type": "pickup_drop_off_type",
                   "timepoint": "timepoint_v"},
    "frequencies": {"exact_times": "exact_times_v"},
    "transfers": {"transfer_type": "transfer_type_v"},
}

# Default enum labels, from the GTFS reference (the target database defines the real sets;
# pass ``enum_labels`` to override).
DEFAULT_ENUM_LABELS: dict[str, list[str]] = {
    "route_type_val": ["0", "1", "2", "3", "4", "5", "6", "7", "11", "12"],
    "location_type_val": ["0", "1", "2", "3", "4"],
    "wheelchair_boarding_val": ["0", "1", "2"],
    "availability": ["0", "1"],
    "exception_type_v": ["1", "2"],
    "wheelchair_accessibility": ["0", "1", "2"],
    "bikes_allowance": ["0", "1", "2"],
    "pickup_drop_off_type": ["0", "1", "2", "3"],
    "timepoint_v": ["0", "1"],
    "exact_times_v": ["0", "1"],
    "transfer_type_v": ["0", "1", "2", "3", "4", "5"],
}

TABLES_PROCESSED = 11

# Column names of the static files where the tables' differ.
FILE_NAMES = {"shapes": {"shape_pt_lat": "lat", "shape_pt_lon": "lon"}}
HEX_CHARS = 10
MOST_TRIES = 2_000_000
TRIES_GROW = 4
MAX_LABELS = 10_000
NULL_SPREAD = 4096

Schema = dict[str, DataFrame]


class MergeError(Exception):
    def __init__(self, message: str, code: str):
        super().__init__(message)
        self.code = code


def conform(table: str, df: DataFrame) -> DataFrame:
    """The table's columns in order; absent ones become null strings. Names that the static files
    use are mapped to the table's, and columns beyond the list follow unchanged."""
    cols = COLUMNS.get(table)
    if cols is None:
        return df
    for name, ours in FILE_NAMES.get(table, {}).items():
        if name in df.columns and ours not in df.columns:
            df = df.withColumnRenamed(name, ours)
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in cols],
                     *[F.col(c) for c in df.columns if c not in cols])


# --- step 0: surrogate maxima --------------------------------------------------------------------

def max_surrogates(target: Schema) -> DataFrame:
    """One row: current max of shapes.id, frequencies.frequencies_row, transfers.id (0 if absent/empty)."""
    parts = []
    for name, t, c in (("max_shapes_id", "shapes", "id"), ("max_frequencies_row", "frequencies", "frequencies_row"),
                       ("max_transfers_id", "transfers", "id")):
        if t in target:
            parts.append(target[t].select(F.lit(name).alias("k"), F.col(c).cast("long").alias("v")))
    if not parts:
        raise MergeError("no surrogate tables", "42P01")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy().agg(*[F.coalesce(F.max(F.when(F.col("k") == n, F.col("v"))), F.lit(0)).alias(n)
                             for n in ("max_shapes_id", "max_frequencies_row", "max_transfers_id")])


# --- step 1: duplicate agencies and dependent deletes ---------------------------------------------

def duplicate_agencies(source: Schema, target: Schema) -> DataFrame:
    """Target agencies whose name also exists among the source agencies."""
    names = source["agency"].select("agency_name").where(F.col("agency_name").isNotNull())
    return target["agency"].join(names, "agency_name", "left_semi").select("agency_id", "agency_name").distinct()


def _dup_routes(target: Schema, dup: DataFrame) -> DataFrame:
    return target["routes"].join(dup.select("agency_id"), "agency_id", "left_semi").select("route_id")


def _dup_trips(target: Schema, dup: DataFrame) -> DataFrame:
    return target["trips"].join(_dup_routes(target, dup), "route_id", "left_semi").select("trip_id")


def _anti(df: DataFrame, col: str, ids: DataFrame, id_col: str) -> DataFrame:
    # Null sides never match an equi join, so they survive the anti join as in SQL DELETE ... USING.
    return df.join(ids.withColumnRenamed(id_col, col), col, "left_anti")


def delete_transfers(target: Schema, dup: DataFrame) -> DataFrame:
    r, t = _dup_routes(target, dup), _dup_trips(target, dup)
    tr = target["transfers"]
    for col, ids, idc in (("from_route_id", r, "route_id"), ("to_route_id", r, "route_id"),
                          ("from_trip_id", t, "trip_id"), ("to_trip_id", t, "trip_id")):
        tr = _anti(tr, col, ids, idc)
    return tr


def delete_stop_times(target: Schema, dup: DataFrame) -> DataFrame:
    return _anti(target["stop_times"], "trip_id", _dup_trips(target, dup), "trip_id")


def delete_frequencies(target: Schema, dup: DataFrame) -> DataFrame:
    return _anti(target["frequencies"], "trip_id", _dup_trips(target, dup), "trip_id")


def delete_trips(target: Schema, dup: DataFrame) -> DataFrame:
    return _anti(target["trips"], "route_id", _dup_routes(target, dup), "route_id")


def delete_routes(target: Schema, dup: DataFrame) -> DataFrame:
    return _anti(target["routes"], "agency_id", dup.select("agency_id"), "agency_id")


def delete_agencies(target: Schema, dup: DataFrame) -> DataFrame:
    return _anti(target["agency"], "agency_id", dup.select("agency_id"), "agency_id")


def apply_deletes(target: Schema, dup: DataFrame) -> Schema:
    out = dict(target)
    steps = {"transfers": delete_transfers, "stop_times": delete_stop_times, "frequencies": delete_frequencies,
             "trips": delete_trips, "routes": delete_routes, "agency": delete_agencies}
    for t, fn in steps.items():
        if t in target:
            out[t] = fn(target, dup)
    return out


# --- step 2: id mapping ----------------------------------------------------------------------------

def new_id(table: Column, old: Column, salt: str, run_ms: int, again: int | Column = 0, hex_chars: int = HEX_CHARS) -> Column:
    """``ta_<hex of md5(table, old id, salt)>_<run>``; ``again``: number of the try after a collision."""
    if isinstance(again, Column):
        salted = F.concat(F.lit(salt), F.when(again == 0, "").otherwise(F.concat(F.lit("#"), again.cast("string"))))
    else:
        salted = F.lit(salt + (f"#{again}" if again else ""))
    h = F.substring(F.md5(F.concat(table, old, salted)), 1, hex_chars)
    return F.concat(F.substring(table, 1, 2), F.lit("_"), h, F.lit("_"), F.lit(str(int(run_ms))))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _check_room(ids: DataFrame, used: DataFrame | None, run_ms: int, hex_chars: int) -> None:
    """Fail if there are more ids of a prefix than new ids that are not taken: no number of tries could tell them apart."""
    places = 16 ** min(hex_chars, 32)
    form = f"^(.{{0,2}})_[0-9a-f]{{{min(hex_chars, 32)}}}_{int(run_ms)}\\z"
    gone = {}
    if used is not None:
        gone = {r._p: r["count"] for r in used.where(F.col("_taken").rlike(form)).groupBy(F.regexp_extract("_taken", form, 1).alias("_p")).count().collect()}
    for r in ids.where("new_id IS NOT NULL").groupBy(F.substring("table_name", 1, 2).alias("_p")).count().collect():
        if r["count"] > (room := places - gone.get(r._p, 0)):
            raise MergeError(f"new ids collide whatever the tries: {r['count']} ids {r._p}_, {hex_chars} hexadecimal digits leave {room}", "23505")


def _settle(tries: DataFrame, store) -> DataFrame:
    """The tries that count, of tries of several rounds (``_try``) that ids (``_row``) make on free new ids: one per id and new id.

    A try that is the first left of its id and the first left of its new id counts whatever becomes of the others, and
    ends all others of both. The earliest of all is such a try, so every pass settles some."""
    by_id, by_new = Window.partitionBy("_row"), Window.partitionBy("new_id")
    settled = []
    while True:
        first = F.row_number().over(by_id.orderBy("_try")) == 1
        tries = tries.withColumn("_ok", first).withColumn("_ok", F.col("_ok") & (F.row_number().over(by_new.orderBy("_try", "table_name", "old_id")) == 1))
        tries = store(tries.withColumn("_over", F.max("_ok").over(by_new)).withColumn("_over", F.col("_over") | F.max("_ok").over(by_id)))
        settled.append(tries.where("_ok").select("_row", "table_name", "old_id", "new_id"))
        tries = tries.where("NOT _over").drop("_ok", "_over")
        if tries.isEmpty():
            return _union(settled)


def unique_ids(ids: DataFrame, salt: str, run_ms: int, *, taken: DataFrame | None = None, hex_chars: int = HEX_CHARS,
               store=cut_lineage) -> DataFrame:
    """(table_name, old_id, new_id) for distinct (table_name, old_id), every new id unique and none of ``taken`` (column ``id``).

    Ids are tried in rounds. Of the ids that get the same new id in a round the first (by table, old id) keeps it, unless an
    earlier round or ``taken`` has it; the others are hashed again with the round's number. Only those
    go on, so a round after the first is small: at 40 bits 3,000,000 ids leave a handful for the second.
    Where few new ids are free, hundreds of rounds may be needed: tries of several rounds are made at once, more each time,
    and those that meet an earlier new id leave before the rest are settled. There is no last round; only more ids
    than there are new ids are an error. What a step settles is stored before the next one looks at it."""
    used = taken.select(F.col("id").cast("string").alias("_taken")).distinct() if taken is not None else None

    def lost(tries: DataFrame, before: list[DataFrame]) -> DataFrame:
        """The tried new ids that an earlier round or ``taken`` has."""
        return _union(before).join(tries.select(F.col("new_id").alias("_taken")).distinct(), "_taken", "left_semi")

    tried = ids.select("table_name", "old_id").withColumn("new_id", new_id(F.col("table_name"), F.col("old_id"), salt, run_ms, 0, hex_chars))
    order = Window.partitionBy("new_id").orderBy("table_name", "old_id")
    out = tried.withColumn("_ok", F.row_number().over(order) == 1)
    if used is not None:
        mine = lost(tried, [used]).withColumn("_free", F.lit(False))
        out = (out.join(mine, out["new_id"] == mine["_taken"], "left")
               .withColumn("_ok", F.col("_ok") & F.coalesce(F.col("_free"), F.lit(True))).drop("_taken", "_free"))
    out = store(out)
    settled, pending = [out.where("_ok").drop("_ok")], out.where("NOT _ok").select("table_name", "old_id")
    again, many, left = 1, 1, pending.count()
    if left:
        used = store(used) if used is not None else None
        _check_room(out, used, run_ms, hex_chars)
        pending = store(pending.withColumn("_row", F.monotonically_increasing_id()))
    while left:
        many = max(1, min(many * TRIES_GROW, MOST_TRIES // left))
        tries = pending.withColumn("_try", F.explode(F.sequence(F.lit(again), F.lit(again + many - 1))))
        tries = tries.withColumn("new_id", new_id(F.col("table_name"), F.col("old_id"), salt, run_ms, F.col("_try"), hex_chars))
        mine = lost(tries, [d.select(F.col("new_id").alias("_taken")) for d in settled] + ([used] if used is not None else []))
        now = store(_settle(store(tries.join(mine, tries["new_id"] == mine["_taken"], "left_anti")), store))
        settled.append(now.drop("_row"))
        pending = store(pending.join(now.select("_row"), "_row", "left_anti"))
        again, left = again + many, pending.count()
    return _union(settled)


def taken_ids(target: Schema, run_ms: int) -> DataFrame | None:
    """Ids of the target that a new id of this run could equal (column ``id``): those that end in the run's time."""
    parts = [target[t].select(F.col(c).cast("string").alias("id")).where(F.col("id").endswith(f"_{int(run_ms)}")) for t, c in MAPPED if t in target]
    out = parts[0] if parts else None
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class LazySchema(AbcMapping):
    """A schema whose tables are built on first use (planning a table costs driver time)."""

    def __init__(self, builders: dict):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Mapping:
    """Id mapping of a source schema, kept per table so a lookup reads only its own table.

    Without ``materialize`` it is a lazy plan of first tries (a collision shows in :func:`validate`). With it, all tables are mapped
    by :func:`unique_ids` and stored once; ``taken`` names ids that must not come up again."""

    def __init__(self, source: Schema, salt: str, run_ms: int, materialize=None, taken: DataFrame | None = None, hex_chars: int = HEX_CHARS):
        self.source, self.salt, self.run_ms = source, salt, run_ms
        self.materialize, self.taken, self.hex_chars = materialize, taken, hex_chars
        self.id_cols = {t: c for t, c in MAPPED if t in source}
        self._tables: dict[str, DataFrame] = {}
        self._all: DataFrame | None = None

    def _ids(self, t: str) -> DataFrame:
        ids = self.source[t].select(F.col(self.id_cols[t]).cast("string").alias("old_id")).where(F.col("old_id").isNotNull())
        return ids.distinct().select(F.lit(t).alias("table_name"), "old_id")

    def table(self, t: str) -> DataFrame:
        """One table's mapping: built on its own (lazy plans), or a filter of the stored
        whole mapping when materialised (one job for all tables)."""
        if t not in self._tables:
            self._tables[t] = (self.all().where(F.col("table_name") == t) if self.materialize
                               else self._ids(t).withColumn("new_id", new_id(F.lit(t), F.col("old_id"), self.salt, self.run_ms, 0, self.hex_chars)))
        return self._tables[t]

    def all(self) -> DataFrame:
        """(table_name, old_id, new_id) for every mapped table."""
        if self._all is None:
            parts = [self._ids(t) if self.materialize else self.table(t) for t in self.id_cols]
            m = parts[0]
            for p in parts[1:]:
                m = m.unionByName(p)
            self._all = unique_ids(m, self.salt, self.run_ms, taken=self.taken, hex_chars=self.hex_chars, store=self.materialize) if self.materialize else m
        return self._all

    def lookup(self, table: str) -> DataFrame | None:
        if table not in self.id_cols:
            return None
        return self.table(table).select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new"))


def id_mapping(source: Schema, salt: str, run_ms: int, *, taken: DataFrame | None = None, hex_chars: int = HEX_CHARS) -> DataFrame:
    """(table_name, old_id, new_id), one row per distinct non-null source id; new ids are unique."""
    return Mapping(source, salt, run_ms, cut_lineage, taken, hex_chars).all()


def _remap(df: DataFrame, mapping: Mapping, table: str, col: str, how: str) -> DataFrame:
    """Replace ``col`` by its new id through the ``table`` mapping (inner: unmapped rows drop;
    left: unmapped become null). A mapping the source lacks maps nothing."""
    m = mapping.lookup(table)
    if m is None:
        m = df.sparkSession.createDataFrame([], "_old string, _new string")
    if how == "left":
        # Null keys match nothing; spread over many values that match nothing either, they do not meet in one task.
        spread = F.concat(F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SPREAD)).cast("string"))
        df = df.withColumn("_find", F.coalesce(F.col(col).cast("string"), spread))
    else:
        df = df.withColumn("_find", F.col(col))
    j = df.join(m, df["_find"] == m["_old"], how)
    return j.drop(col, "_old", "_find").withColumnRenamed("_new", col)


# --- step 3: per-table remaps ----------------------------------------------------------------------

def remap_agency(src: DataFrame, mapping: Mapping) -> DataFrame:
    return conform("agency", _remap(conform("agency", src), mapping, "agency", "agency_id", "inner"))


def remap_routes(src: DataFrame, mapping: Mapping) -> DataFrame:
    d = _remap(conform("routes", src), mapping, "routes", "route_id", "inner")
    return conform("routes", _remap(d, mapping, "agency", "agency_id", "left"))


def remap_stops(src: DataFrame, mapping: Mapping) -> DataFrame:
    d = _remap(conform("stops", src), mapping, "stops", "stop_id", "inner")
    return conform("stops", _remap(d, mapping, "stops", "parent_station", "left"))


def remap_calendar(src: DataFrame, mapping: Mapping) -> DataFrame:
    return conform("calendar", _remap(conform("calendar", src), mapping, "calendar", "service_id", "inner"))


def remap_calendar_dates(src: DataFrame, mapping: Mapping) -> DataFrame:
    # Through the calendar mapping: services that exist only in calendar_dates drop.
    d = _remap(conform("calendar_dates", src), mapping, "calendar", "service_id", "inner")
    return conform("calendar_dates", d)


def remap_shapes(src: DataFrame, mapping: Mapping, max_id: DataFrame | int) -> DataFrame:
    d = _remap(conform("shapes", src), mapping, "shapes", "shape_id", "inner").drop("id")
    d = surrogate_ids(d, "id", ["shape_id", "shape_pt_sequence", "lat", "lon", "shape_dist_traveled"], max_id)
    return conform("shapes", d)


def remap_trips(src: DataFrame, mapping: Mapping) -> DataFrame:
    d = _remap(conform("trips", src), mapping, "trips", "trip_id", "inner")
    d = _remap(d, mapping, "routes", "route_id", "inner")
    d = _remap(d, mapping, "calendar", "service_id", "inner")
    return conform("trips", _remap(d, mapping, "shapes", "shape_id", "left"))


def remap_stop_times(src: DataFrame, mapping: Mapping) -> DataFrame:
    d = _remap(conform("stop_times", src), mapping, "trips", "trip_id", "inner")
    return conform("stop_times", _remap(d, mapping, "stops", "stop_id", "inner"))


def remap_frequencies(src: DataFrame, mapping: Mapping, max_row: DataFrame | int) -> DataFrame:
    d = _remap(conform("frequencies", src), mapping, "trips", "trip_id", "inner").drop("frequencies_row")
    d = surrogate_ids(d, "frequencies_row", ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"],
                      max_row)
    return conform("frequencies", d)


def remap_transfers(src: DataFrame, mapping: Mapping, max_id: DataFrame | int) -> DataFrame:
    d = conform("transfers", src).drop("id")
    for col, table in (("from_stop_id", "stops"), ("to_stop_id", "stops"), ("from_route_id", "routes"),
                       ("to_route_id", "routes"), ("from_trip_id", "trips"), ("to_trip_id", "trips")):
        d = _remap(d, mapping, table, col, "left")
    order = ["from_stop_id", "to_stop_id", "transfer_type", "min_transfer_time", "from_route_id", "to_route_id",
             "from_trip_id", "to_trip_id"]
    return conform("transfers", surrogate_ids(d, "id", order, max_id))


def merge_feed_info(src: DataFrame, tgt: DataFrame, key: list[str]) -> DataFrame:
    """Source rows whose key is not already in the target (insert ... on conflict do nothing).

    Columns that only one side has stay, null in the other's rows. Of source rows with one key the smallest (by all its
    columns in name order) is kept; rows with a null in the key conflict with nothing."""
    lost = [k for k in key if k not in src.columns or k not in tgt.columns]
    if lost:
        raise MergeError(f"feed_info key column {lost[0]} is missing", "42703")
    s = src.join(tgt.select(*key), key, "left_anti")
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    rest = sorted(c for c in src.columns if c not in key)
    one = s.where(~null_key)
    if rest:
        one = one.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    else:
        one = one.distinct()
    out = one.unionByName(s.where(null_key))
    return out.select(*[F.col(c) if c in src.columns else F.lit(None).cast(tgt.schema[c].dataType).alias(c) for c in tgt.columns],
                      *[c for c in src.columns if c not in tgt.columns])


# --- surrogate keys --------------------------------------------------------------------------------

def surrogate_ids(df: DataFrame, name: str, order: list[str], offset: DataFrame | int,
                  partitions: int | None = None) -> DataFrame:
    """``name`` = 1-based rank in ``order`` + ``offset``, without a single-task global window.

    Rows are range-partitioned and sorted by ``order``; ``monotonically_increasing_id``
    then holds (partition id, position in partition). Per-partition counts (one row per
    partition, a bound fixed by the partition count) give each partition its start.
    Rows equal in ``order`` are told apart by a random number, in the ranging too, so that any number of them
    spreads over tasks (they get ids in an arbitrary but single run order).
    The ranged rows are materialised once: counts and ids taken from two runs of the range
    partitioning could be cut at different, separately sampled borders.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    ranged = tied.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    mid = F.monotonically_increasing_id()
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_pos", mid - F.shiftleft(F.col("_pid").cast("long"), 33))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    out = ranged.join(F.broadcast(starts), "_pid")
    out = out.withColumn(name, (F.col("_start") + F.col("_pos") + 1).cast("long")).drop("_pid", "_pos", "_start")
    if isinstance(offset, DataFrame):
        # A one-row aggregate (the current max) as a scalar subquery: no join, nothing via the driver.
        off = offset.select(F.col(offset.columns[0]).cast("long")).scalar()
        return out.withColumn(name, F.col(name) + off)
    return out.withColumn(name, F.col(name) + F.lit(int(offset)))


# --- enum validation -------------------------------------------------------------------------------

def target_labels(target: Schema, labels: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Label sets by enum type: ``labels`` (the defaults when None) and whatever the target's own rows use, so that a target with
    extended route types takes more of them. One distinct value per label reaches the driver; a column
    with more than ``MAX_LABELS`` values is no enum and fails."""
    out = {k: list(v) for k, v in (labels or DEFAULT_ENUM_LABELS).items()}
    parts = [target[t].select(F.lit(e).alias("e"), F.col(c).cast("string").alias("v")) for t, cols in ENUM_COLUMNS.items() if t in target
             for c, e in cols.items() if c in target[t].columns]
    if parts:
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        for e, n in u.where("v IS NOT NULL").groupBy("e").agg(F.countDistinct("v")).collect():
            if n > MAX_LABELS:
                raise MergeError(f"enum {e} has {n} labels in the target", "22P02")
        for e, v in u.where("v IS NOT NULL").distinct().collect():
            if v not in out.setdefault(e, []):
                out[e].append(v)
    return out


def enum_check(df: DataFrame, table: str, labels: dict[str, list[str]] | None = None) -> DataFrame:
    """Add ``_enum_bad``: names of enum columns whose non-null value is not a label (empty = valid).
    A type that ``labels`` does not name takes the default labels."""
    labels = DEFAULT_ENUM_LABELS | (labels or {})
    cols = ENUM_COLUMNS.get(table, {})
    bad = [F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(labels[t]), F.lit(c))
           for c, t in cols.items() if c in df.columns]
    arr = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<string>")
    return df.withColumn("_enum_bad", arr)


def enum_cast(df: DataFrame, table: str, labels: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows with enum columns as label strings, rejected rows with the failing columns)."""
    chk = enum_check(df, table, labels)
    ok = chk.where(F.size("_enum_bad") == 0).drop("_enum_bad")
    for c in ENUM_COLUMNS.get(table, {}):
        if c in ok.columns:
            ok = ok.withColumn(c, F.col(c).cast("string"))
    return ok, chk.where(F.size("_enum_bad") > 0)


# --- whole merge -----------------------------------------------------------------------------------

@dataclass
class MergeResult:
    tables: Schema                 # new target tables (kept target rows + remapped source rows)
    inserted: Schema               # remapped source rows per table
    kept: Schema                   # target rows after the deletes
    mapping: DataFrame
    duplicates: DataFrame
    report: DataFrame
    extras: dict = field(default_factory=dict)


def plan_merge(spark: SparkSession, source: Schema, target: Schema, *, source_schema: str, target_schema: str,
               run_ms: int, salt: str, feed_info_key: list[str] | None = None,
               enum_labels: dict[str, list[str]] | None = None, materialize=None) -> MergeResult:
    """Lazy merge plan. Validation that needs data (enums, id collisions) is in :func:`validate`."""
    if source_schema is None or target_schema is None:
        raise MergeError("source_schema and target_schema must not be NULL", "P0001")
    if source_schema == target_schema:
        raise MergeError(f"source_schema and target_schema must differ ({source_schema})", "P0001")

    both = lambda t: t in source and t in target
    kept = dict(target)
    dup = spark.createDataFrame([], "agency_id string, agency_name string")
    if both("agency"):
        dup = duplicate_agencies(source, target)
        kept = apply_deletes(target, dup)
    mapping = Mapping(source, salt, run_ms, materialize, taken_ids(target, run_ms) if materialize else None)
    maxes = max_surrogates(target) if any(t in target for t in ("shapes", "frequencies", "transfers")) else None
    mx = lambda c: maxes.select(c) if maxes is not None else 0

    ins: Schema = {}
    if both("agency"):
        ins["agency"] = remap_agency(source["agency"], mapping)
    if both("routes"):
        ins["routes"] = remap_routes(source["routes"], mapping)
    if both("stops"):
        ins["stops"] = remap_stops(source["stops"], mapping)
    if both("calendar"):
        ins["calendar"] = remap_calendar(source["calendar"], mapping)
    if both("calendar_dates"):
        ins["calendar_dates"] = remap_calendar_dates(source["calendar_dates"], mapping)
    if both("shapes"):
        ins["shapes"] = remap_shapes(source["shapes"], mapping, mx("max_shapes_id"))
    if both("trips"):
        ins["trips"] = remap_trips(source["trips"], mapping)
    if both("stop_times"):
        ins["stop_times"] = remap_stop_times(source["stop_times"], mapping)
    if both("frequencies"):
        ins["frequencies"] = remap_frequencies(source["frequencies"], mapping, mx("max_frequencies_row"))
    if both("transfers"):
        ins["transfers"] = remap_transfers(source["transfers"], mapping, mx("max_transfers_id"))
    if both("feed_info"):
        key = feed_info_key or target["feed_info"].columns[:1]
        ins["feed_info"] = merge_feed_info(source["feed_info"], kept["feed_info"], key)

    tables = dict(kept)
    for t, d in ins.items():
        # Neither side loses columns: what only one side has is null in the other's rows.
        tables[t] = (conform(t, kept[t]) if t in COLUMNS else kept[t]).unionByName(d, allowMissingColumns=True)

    report = merge_report(spark, ins, target, dup, mapping.all(), source_schema, target_schema,
                          source_trips=source["trips"] if both("trips") else None)
    return MergeResult(tables=tables, inserted=ins, kept=kept, mapping=mapping.all(), duplicates=dup, report=report)


def merge_report(spark: SparkSession, inserted: Schema, target: Schema, dup: DataFrame, mapping: DataFrame,
                 source_schema: str, target_schema: str, source_trips: DataFrame | None = None) -> DataFrame:
    """One-row report: status, totals, counts, schema names (a global aggregate of a small union).

    Extra field ``trips_dropped``: source trips the inner joins left out (unmapped route or
    service); their stop times and frequencies are still inserted, as in the reference.
    """
    parts = [d.select(F.lit("migrated").alias("k")) for d in inserted.values()]
    if source_trips is not None and "trips" in inserted:
        parts.append(source_trips.select(F.lit("src_trips").alias("k")))
        parts.append(inserted["trips"].select(F.lit("ins_trips").alias("k")))
    if "agency" in target and "agency" in inserted:
        parts.append(target["agency"].join(dup.select("agency_id"), "agency_id", "left_semi")
                     .select(F.lit("deleted").alias("k")))
    parts.append(mapping.select(F.lit("mapping").alias("k")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    cnt = lambda k: F.count(F.when(F.col("k") == k, 1)).cast("long")
    return u.groupBy().agg(
        F.lit("success").alias("status"),
        cnt("migrated").alias("total_rows_migrated"),
        cnt("deleted").cast("int").alias("duplicate_agencies_removed"),
        F.lit(TABLES_PROCESSED).alias("tables_processed"),
        cnt("mapping").alias("id_mappings_created"),
        F.lit(source_schema).alias("source_schema"),
        F.lit(target_schema).alias("target_schema"),
        (cnt("src_trips") - cnt("ins_trips")).alias("trips_dropped"),
    )


def error_report(spark: SparkSession, message: str, code: str, source_schema: str | None,
                 target_schema: str | None) -> DataFrame:
    return spark.createDataFrame([("error", message, code, source_schema, target_schema)],
                                 "status string, error_message string, error_detail string, "
                                 "source_schema string, target_schema string")


def validate(result: MergeResult, enum_labels: dict[str, list[str]] | None = None,
             inserted: Schema | None = None) -> list[str]:
    """Data checks run as one distributed job: enum labels of inserted rows and new-id uniqueness.

    ``inserted`` replaces the planned inserted rows (e.g. their staged copies). Returns a
    list of problems (empty = valid); only the problem kinds reach the driver.
    """
    checks = []
    for t, d in (inserted or result.inserted).items():
        if ENUM_COLUMNS.get(t):
            _, bad = enum_cast(d, t, enum_labels)
            checks.append(bad.select(F.lit(f"invalid enum label in {t}").alias("problem")))
    dup_new = (result.mapping.groupBy("new_id").agg(F.countDistinct("table_name", "old_id").alias("n"))
               .where(F.col("n") > 1).select(F.lit("new id collision").alias("problem")))
    checks.append(dup_new)
    u = checks[0]
    for c in checks[1:]:
        u = u.unionByName(c)
    return [r["problem"] for r in u.groupBy("problem").count().collect()]


ORIGIN = "_origin"


def stage(spark: SparkSession, res: MergeResult, staging_dir: str, parallel_jobs: int = 4) -> tuple[Schema, Schema]:
    """Write every new table once under ``staging_dir`` (kept and inserted rows tagged by
    origin, partitioned by it). The writes are independent Spark jobs, submitted from a few
    driver threads so small tables share the cluster. Returns (staged tables, staged
    inserted rows); the staged frames with their origin column are kept in
    ``res.extras["staged"]``."""
    def write(t: str) -> tuple[str, DataFrame]:
        path = f"{staging_dir.rstrip('/')}/{t}"
        kept = res.kept[t]
        k = conform(t, kept) if t in res.inserted and t in COLUMNS else kept
        d = k.withColumn(ORIGIN, F.lit("kept"))
        if t in res.inserted:
            d = d.unionByName(res.inserted[t].withColumn(ORIGIN, F.lit("inserted")), allowMissingColumns=True)
        d.write.mode("overwrite").partitionBy(ORIGIN).parquet(path)
        return t, spark.read.parquet(path)

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        staged = dict(pool.map(write, list(res.kept)))
    res.extras["staged"] = staged
    tables = {t: d.drop(ORIGIN) for t, d in staged.items()}
    inserted = {t: d.where(F.col(ORIGIN) == "inserted").drop(ORIGIN) for t, d in staged.items() if t in res.inserted}
    return tables, inserted


def run_merge(spark: SparkSession, source: Schema, target: Schema, *, source_schema: str, target_schema: str,
              run_ms: int, salt: str, staging_dir: str | None = None, feed_info_key: list[str] | None = None,
              enum_labels: dict[str, list[str]] | None = None, result: list | None = None
              ) -> tuple[Schema, DataFrame]:
    """Plan, stage every table (with ``staging_dir``), validate, then hand them out (all or nothing).

    The id mapping is made unique and stored once (all remaps read it). With a staging folder
    each new table is written once; validation reads the staged rows. Returns ``(tables,
    report)``. On any failure the target tables come back unchanged and the report has
    status ``error``; staged files are left for inspection. ``result`` receives the plan.
    """
    try:
        res = plan_merge(spark, source, target, source_schema=source_schema, target_schema=target_schema,
                         run_ms=run_ms, salt=salt, feed_info_key=feed_info_key, enum_labels=enum_labels,
                         materialize=cut_lineage)
        if result is not None:
            result.append(res)
        if staging_dir:
            # each table computed once: staged first, then checked on the stored rows
            tables, staged_ins = stage(spark, res, staging_dir)
            problems = validate(res, enum_labels, staged_ins)
            # counted from the staged rows, so no remap runs twice
            res.report = merge_report(spark, staged_ins, target, res.duplicates, res.mapping, source_schema, target_schema,
                                      source_trips=source["trips"] if "trips" in source and "trips" in target else None)
        else:
            tables, problems = res.tables, validate(res, enum_labels)
        if problems:
            raise MergeError("; ".join(sorted(problems)), "22P02")
        return tables, res.report
    except MergeError as e:
        return dict(target), error_report(spark, str(e), e.code, source_schema, target_schema)
    except Exception as e:  # noqa: BLE001 - like the reference, any failure becomes an error report
        return dict(target), error_report(spark, f"{type(e).__name__}: {e}", "XX000", source_schema, target_schema)


# --- publishing ------------------------------------------------------------------------------------

def publish(spark: SparkSession, pointer: str, run_ms: int, staging_dir: str, tables: list[str], expected: int | None = None) -> int:
    """Make a staged merge the current version, if the current one is still ``expected`` (the version the merge read;
    0: none yet; None: whatever is there now). Returns the new version, raises :class:`Conflict` for the writer that came second.

    The version's manifest appears in one step, so readers see either all tables of the old version
    or all of the new one; older versions stay readable."""
    log = VersionLog(spark, pointer)
    base = (log.latest() or 0) if expected is None else expected
    return log.commit(base + 1, {"run_ms": run_ms, "staging_dir": staging_dir, "tables": list(tables), "previous": base})


def published(spark: SparkSession, pointer: str, version: int | None = None) -> Schema:
    """The tables of a published version (the latest when None)."""
    v = VersionLog(spark, pointer).read(version)
    if v is None:
        raise KeyError(f"nothing is published in {pointer}")
    return {t: spark.read.parquet(f"{v['staging_dir'].rstrip('/')}/{t}").drop(ORIGIN) for t in v["tables"]}


def merge_into_published(spark: SparkSession, source: Schema, pointer: str, *, staging_dir: str, run_ms: int, **kw) -> tuple[Schema, DataFrame]:
    """Merge ``source`` into the latest published version and publish the result: one transaction.

    When another writer published meanwhile, nothing is applied: the current tables come back with an error report
    (code 40001), and the merge may be run again on them."""
    base = VersionLog(spark, pointer).latest() or 0
    target = published(spark, pointer, base) if base else {}
    tables, report = run_merge(spark, source, target, run_ms=run_ms, staging_dir=staging_dir, **kw)
    if report.first()["status"] != "success":
        return tables, report
    try:
        publish(spark, pointer, run_ms, staging_dir, list(tables), expected=base)
    except Conflict as e:
        message = f"version {e.version} was published by another writer"
        return published(spark, pointer), error_report(spark, message, "40001", kw.get("source_schema"), kw.get("target_schema"))
    return tables, report
