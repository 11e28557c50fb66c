"""Domain tables derived from the driver's parquet tables (see FIXTURES.md section 3).

Each builder reads the given tables, so its work grows with the scale factor. The
same definitions exist as SQL text in ``plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.scan import ordered_prefix
from .functions.timecols import epoch_millis
from .operators.merge import LazySchema
from .session import table_path


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _s(c: Column) -> Column:
    return c.cast("string")


def _ts_ms(df: DataFrame, col: str = "ts") -> Column:
    return epoch_millis(col, df.schema[col].dataType)


def _events_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``i`` = 1-based position within the user (row_number over user_id by
    event_id), computed with the block-split scan so one busy user is not one task."""
    e = _read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ordered_prefix(e, ["user_id"], "event_id", dense=True).withColumnRenamed("row_no", "i")


def _keys_below(spark, sf_dir, name: str, key: str) -> Column:
    """One more than the table's largest key (keys are dense from 0), as a scalar subquery."""
    return _read(spark, sf_dir, name).agg((F.max(key) + 1).cast("long").alias("n")).scalar()


def _trip_for(spark, sf_dir, user: Column, run: Column) -> Column:
    """A trip of ``orders`` for a user's run number; spreads over all orders."""
    return F.concat(F.lit("T"), _s((user * 97 + run) % _keys_below(spark, sf_dir, "orders", "o_orderkey")))


def agency(spark, sf_dir):
    r = _read(spark, sf_dir, "region")
    return r.select(F.concat(F.lit("A"), _s(F.col("r_regionkey"))).alias("agency_id"),
                    F.col("r_name").alias("agency_name"))


def routes(spark, sf_dir):
    n = _read(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("R"), _s(F.col("n_nationkey"))).alias("route_id"),
                    F.concat(F.lit("A"), _s(F.col("n_regionkey"))).alias("agency_id"),
                    F.col("n_name").alias("route_short_name"),
                    _s(F.col("n_nationkey") % 4).alias("route_type"))


def stops(spark, sf_dir):
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.concat(F.lit("S"), _s(k)).alias("stop_id"),
                    F.col("s_name").alias("stop_name"),
                    (F.lit(59.0) + (k % 97).cast("double") / 128).alias("stop_lat"),
                    (F.lit(18.0) + (k % 89).cast("double") / 128).alias("stop_lon"),
                    F.when(k % 5 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("S"), _s(k - k % 5))).alias("parent_station"))


def calendar(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    return o.where(p != "5").select(F.concat(F.lit("C"), p).alias("service_id")).distinct()


def shapes(spark, sf_dir):
    """Every customer is a point; twenty in a row make a shape, so shapes grow with the table."""
    k = F.col("c_custkey")
    line, at = F.floor(k / 20).cast("long"), k % 20
    return _read(spark, sf_dir, "customer").select(
        (k + 1).alias("id"), F.concat(F.lit("H"), _s(line)).alias("shape_id"), at.cast("int").alias("shape_pt_sequence"),
        (F.lit(59.0) + (line % 25).cast("double") / 32 + at.cast("double") / 1024).alias("lat"),
        (F.lit(18.0) + at.cast("double") / 2048).alias("lon"))


def trips(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    ck = F.col("o_custkey")
    return o.select(F.concat(F.lit("T"), _s(F.col("o_orderkey"))).alias("trip_id"),
                    F.concat(F.lit("R"), _s(ck % 25)).alias("route_id"),
                    F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("service_id"),
                    F.when(ck % 10 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("H"), _s(F.floor(ck / 20).cast("long")))).alias("shape_id"))


def stop_times(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                                 "l_quantity", "l_shipdate", "l_discount", "l_tax")
    ok = F.col("l_orderkey")
    return li.select(F.concat(F.lit("T"), _s(ok)).alias("trip_id"),
                     F.concat(F.lit("S"), _s(F.col("l_suppkey"))).alias("stop_id"),
                     F.row_number().over(w).cast("int").alias("stop_sequence"),
                     (F.lit(21600) + (ok % 1000) * 60 + F.col("l_linenumber") * 120).cast("int").alias("arrival_seconds"))


def frequencies(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    return o.select((F.col("o_orderkey") + 1).alias("frequencies_row"),
                    F.concat(F.lit("T"), _s(F.col("o_orderkey"))).alias("trip_id"),
                    (F.lit(600) + F.col("o_custkey") % 5 * 60).cast("int").alias("headway_secs"))


def transfers(spark, sf_dir):
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    null_s = F.lit(None).cast("string")
    n = _keys_below(spark, sf_dir, "supplier", "s_suppkey")
    return p.select((k + 1).alias("id"),
                    F.concat(F.lit("S"), _s(k % n)).alias("from_stop_id"),
                    F.when(k % 7 == 0, null_s).otherwise(F.concat(F.lit("S"), _s((k + 1) % n))).alias("to_stop_id"),
                    F.concat(F.lit("R"), _s(k % 25)).alias("from_route_id"),
                    F.when(k % 3 == 0, null_s).otherwise(F.concat(F.lit("R"), _s((k + 6) % 25))).alias("to_route_id"),
                    F.when(k % 4 == 0, F.concat(F.lit("T"), _s(k))).alias("from_trip_id"),
                    F.when(k % 6 == 0, F.concat(F.lit("T"), _s(k + 1))).alias("to_trip_id"))


def positions(spark, sf_dir):
    e = _events_numbered(spark, sf_dir)
    u, ev, i = F.col("user_id"), F.col("event_id"), F.col("i")
    return e.select(
        F.concat(F.lit("A"), _s(u % 5)).alias("agency"),
        F.when(ev % 41 == 0, F.lit("")).otherwise(F.concat(F.lit("V"), _s(u))).alias("vehicle_id"),
        F.when(ev % 37 == 0, F.lit("")).otherwise(_trip_for(spark, sf_dir, u, F.floor((i - 1) / 10))).alias("trip_id"),
        (F.lit(59.0) + (u % 25).cast("double") / 32 + ((i - 1) % 10).cast("double") / 512
         + (ev % 7).cast("double") / 2048).alias("latitude"),
        (F.lit(18.0) + ((i - 1) % 10).cast("double") / 1024).alias("longitude"),
        _ts_ms(e).alias("ts_ms"),
        ev.alias("seq"))


def sample_progress(spark, sf_dir):
    e = _events_numbered(spark, sf_dir)
    u, ev, i = F.col("user_id"), F.col("event_id"), F.col("i")
    return e.select(
        F.concat(F.lit("V"), _s(u)).alias("vehicle_id"),
        F.floor((i - 1) / 10).cast("int").alias("trip_no"),
        _trip_for(spark, sf_dir, u, F.floor((i - 1) / 10)).alias("trip_id"),
        ((i - 1) % 10 * 200 + ev % 7 * 50).cast("double").alias("s_now"),
        _ts_ms(e).alias("ts_ms"),
        ev.alias("seq"))


def stop_progress(spark, sf_dir):
    """Stops of every trip with their distance along its line (not always ascending)."""
    st = stop_times(spark, sf_dir)
    k = F.substring("stop_id", 2, 20).cast("long")
    return st.select("trip_id", F.concat(F.col("stop_id"), F.lit("/"), _s(F.col("stop_sequence"))).alias("stop_id"), "stop_sequence",
                     (F.col("stop_sequence") * 175 + k % 3 * 250).cast("double").alias("stop_s"))


def sample_schedule(spark, sf_dir):
    """Scheduled start of every third sampled trip: up to 49 minutes before its first sample, so
    some lie inside and some outside the anchor limit."""
    k = F.substring("trip_id", 2, 20).cast("long")
    return (sample_progress(spark, sf_dir).where(k % 3 == 0).groupBy("trip_id")
            .agg(F.min("ts_ms").alias("first_ms")).select("trip_id", (F.col("first_ms") - k % 50 * 60000).alias("sched_start_ms")))


def feed_entities(spark, sf_dir):
    """Entities of feed snapshots. Extra columns beyond FIXTURES.md: lon and trip_id
    (constants and a simple rule), needed by the position record."""
    e = _read(spark, sf_dir, "events").select("event_id", "user_id")
    ev, u = F.col("event_id"), F.col("user_id")
    snap = F.floor(ev / 20)
    has = ev % 31 != 0      # the other entities carry no vehicle, so nothing of it
    lat = F.when(ev % 11 == 0, F.lit(None).cast("double")).otherwise(F.lit(59.0) + u.cast("double") / 1024)
    return e.select(
        F.lit("vehicle-positions").alias("feed"),
        snap.cast("long").alias("snapshot_no"),
        F.when(snap % 9 == 8, F.lit(0).cast("long"))
         .otherwise((F.lit(1704067200) + F.floor(ev / 40) * 10).cast("long")).alias("header_ts"),
        (ev % 20).cast("int").alias("entity_idx"),
        F.concat(F.lit("E"), _s(ev)).alias("entity_id"),
        F.when(ev % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("V"), _s(u))).alias("vehicle_id"),
        F.when(ev % 13 == 0, F.lit(None).cast("long"))
         .when(ev % 29 == 0, F.lit(0).cast("long"))
         .otherwise((F.lit(1704067200) + F.floor(ev / 60) * 30).cast("long")).alias("entity_ts"),
        lat.alias("lat"),
        F.when(lat.isNull(), F.lit(None).cast("double"))
         .otherwise(F.lit(18.0) + (ev % 20).cast("double") / 1024).alias("lon"),
        F.when(ev % 23 == 0, F.lit(None).cast("string")).otherwise(_trip_for(spark, sf_dir, u, snap)).alias("trip_id"),
        has.alias("has_vehicle"),
    ).select("feed", "snapshot_no", "header_ts", "entity_idx", "entity_id",
             *[F.when(F.col("has_vehicle"), F.col(c)).alias(c) for c in ("vehicle_id", "entity_ts", "lat", "lon", "trip_id")],
             "has_vehicle")





# --- merge split (FIXTURES.md "Merge split") ---------------------------------------------------------
SOURCE_AGENCIES = ["A0", "A1"]
TARGET_AGENCIES = ["A1", "A2", "A3", "A4"]


def calendar_dates(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("service_id")).distinct() \
            .select("service_id", F.lit("20240101").alias("date"), F.lit("1").alias("exception_type"))


def feed_info(spark, sf_dir, table: str, key: str):
    """A publisher per region or nation; small keys are in both tables, larger ones in one."""
    t = _read(spark, sf_dir, table)
    return t.select(F.concat(F.lit("publisher-"), _s(F.col(key) * 3 % 7), F.lit("-"), _s(F.col(key))).alias("feed_publisher_name"),
                    F.lit("en").alias("feed_lang"), F.concat(F.lit(table + "-"), _s(F.col(key))).alias("feed_version"))


def _gtfs_side(spark, sf_dir, agencies: list[str]) -> dict:
    """Builders (name -> zero-argument function) of one side of the split."""
    b: dict = {}
    b["agency"] = lambda: agency(spark, sf_dir).where(F.col("agency_id").isin(agencies))
    b["routes"] = lambda: routes(spark, sf_dir).join(side["agency"].select("agency_id"), "agency_id", "left_semi")
    b["trips"] = lambda: trips(spark, sf_dir).join(side["routes"].select("route_id"), "route_id", "left_semi")
    b["stop_times"] = lambda: (stop_times(spark, sf_dir).join(side["trips"].select("trip_id"), "trip_id", "left_semi")
                               .withColumn("arrival_time", F.col("arrival_seconds")).drop("arrival_seconds"))
    b["frequencies"] = lambda: frequencies(spark, sf_dir).join(side["trips"].select("trip_id"), "trip_id", "left_semi")
    b["stops"] = lambda: stops(spark, sf_dir)
    b["calendar"] = lambda: calendar(spark, sf_dir)
    b["shapes"] = lambda: shapes(spark, sf_dir)
    b["calendar_dates"] = lambda: calendar_dates(spark, sf_dir)
    side = LazySchema(b)
    return b, side


def gtfs_split(spark, sf_dir):
    """(source, target) schemas: source = agencies A0, A1 and what hangs off them, target
    = A1..A4 likewise; stops, calendar, shapes, calendar_dates in both; transfers split
    by id parity; feed_info rows of which some publishers are in both. Tables are built lazily."""
    (sb, src), (tb, tgt) = _gtfs_side(spark, sf_dir, SOURCE_AGENCIES), _gtfs_side(spark, sf_dir, TARGET_AGENCIES)
    sb["transfers"] = lambda: transfers(spark, sf_dir).where(F.col("id") % 2 == 0)
    tb["transfers"] = lambda: transfers(spark, sf_dir).where(F.col("id") % 2 == 1)
    sb["feed_info"] = lambda: feed_info(spark, sf_dir, "nation", "n_nationkey")
    tb["feed_info"] = lambda: feed_info(spark, sf_dir, "region", "r_regionkey")
    src._builders.update(sb)
    tgt._builders.update(tb)
    return src, tgt


def schedule(spark, sf_dir):
    """Scheduled trip starts for every third trip: first stop time on 2024-01-01 (UTC+1), epoch ms."""
    st = stop_times(spark, sf_dir)
    k = F.substring("trip_id", 2, 20).cast("long")
    return (st.where(k % 3 == 0).groupBy("trip_id")
              .agg((F.lit(1704063600000) + F.min("arrival_seconds").cast("long") * 1000).alias("sched_start_ms")))
