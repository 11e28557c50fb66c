"""Merge invariants: failures change nothing, ids stay consistent, counts add up."""

from hashlib import md5

import pytest
from pyspark.sql import functions as F

from stopwise import fixtures as fx
from stopwise.operators import merge as mg

from .conftest import SF_SMALL

SALT, RUN = "t", 1700000000000


def _split(spark):
    return fx.gtfs_split(spark, SF_SMALL)


@pytest.mark.parametrize("src_name,tgt_name", [(None, "gtfs"), ("gtfs", None), ("gtfs", "gtfs")])
def test_bad_schema_names_fail_and_change_nothing(spark, src_name, tgt_name):
    src, tgt = _split(spark)
    tables, report = mg.run_merge(spark, src, tgt, source_schema=src_name, target_schema=tgt_name,
                                  run_ms=RUN, salt=SALT, feed_info_key=["feed_publisher_name"])
    r = report.collect()[0]
    assert r.status == "error"
    assert all(tables[t] is tgt[t] for t in tgt)


def test_unknown_enum_label_fails_whole_merge(spark):
    src, tgt = _split(spark)
    src = dict(src)
    src["routes"] = src["routes"].withColumn("route_type", F.when(F.col("route_id") == "R0", "99")
                                             .otherwise(F.col("route_type")))
    tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT,
                                  feed_info_key=["feed_publisher_name"])
    r = report.collect()[0]
    assert r.status == "error" and "routes" in r.error_message
    assert tables["routes"] is tgt["routes"]


def test_successful_merge_invariants(spark, tmp_path):
    src, tgt = _split(spark)
    res = mg.plan_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT,
                        feed_info_key=["feed_publisher_name"])
    assert mg.validate(res) == []
    ins, kept, tables = res.inserted, res.kept, res.tables
    # inserted trips reference inserted routes and calendars (inner joins); no dangling ids
    assert ins["trips"].join(ins["routes"], "route_id", "left_anti").count() == 0
    # stop times of trips dropped by the inner joins (service C5 has no calendar) stay as
    # orphans, exactly as the reference's insert does; the report counts the dropped trips
    orphans = ins["stop_times"].join(ins["trips"], "trip_id", "left_anti")
    dropped_src = src["trips"].where(F.col("service_id") == "C5").select("trip_id")
    want = src["stop_times"].join(dropped_src, "trip_id", "left_semi").count()
    assert orphans.count() == want > 0
    assert res.report.first().trips_dropped == dropped_src.count()
    assert ins["stop_times"].join(ins["stops"], "stop_id", "left_anti").count() == 0
    # the duplicate agency and everything under it left the target
    dup = [r.agency_id for r in res.duplicates.collect()]
    assert dup == ["A1"]
    assert kept["routes"].where(F.col("agency_id") == "A1").count() == 0
    # counts add up
    for t in ("trips", "stop_times", "transfers"):
        assert tables[t].count() == kept[t].count() + ins[t].count()
    rep = res.report.collect()[0]
    assert rep.status == "success" and rep.tables_processed == 11
    assert rep.total_rows_migrated == sum(d.count() for d in ins.values())
    assert rep.id_mappings_created == res.mapping.count()
    # surrogates continue after the target's maximum, consecutively
    mx = tgt["transfers"].agg(F.max("id")).first()[0]
    ids = sorted(r.id for r in ins["transfers"].select("id").collect())
    assert ids == list(range(mx + 1, mx + 1 + len(ids)))
    # new ids have the documented shape
    nid = res.mapping.where("table_name = 'trips'").first().new_id
    assert nid.startswith("tr_") and nid.endswith(f"_{RUN}") and len(nid.split("_")[1]) == 10


def test_staged_merge_reads_back(spark, tmp_path):
    src, tgt = _split(spark)
    tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT,
                                  staging_dir=str(tmp_path / "stage"), feed_info_key=["feed_publisher_name"])
    assert report.collect()[0].status == "success"
    assert (tmp_path / "stage" / "stop_times").exists()
    assert tables["agency"].count() == 5  # A2..A4 kept + A0, A1 inserted


def test_surrogate_ids_are_a_dense_rank(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = mg.surrogate_ids(df, "sid", ["k"], 10, partitions=7)
    got = sorted((r.k, r.sid) for r in out.collect())
    assert got == [(k, k + 11) for k in range(1000)]


def test_missing_optional_table_still_merges(spark, tmp_path):
    src, tgt = _split(spark)
    src = {k: src[k] for k in src if k != "frequencies"}
    tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT,
                                  feed_info_key=["feed_publisher_name"])
    assert report.first().status == "success"
    assert "frequencies" in tables  # the target's table stays, with its kept rows


def test_any_failure_is_an_error_report(spark):
    src, tgt = _split(spark)
    tgt = {k: tgt[k] for k in tgt if k != "routes"}  # the dependent deletes need the routes
    tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT,
                                  feed_info_key=["feed_publisher_name"])
    r = report.first()
    assert r.status == "error" and r.source_schema == "a" and r.target_schema == "b"
    assert all(tables[t] is tgt[t] for t in tgt)


def test_surrogate_ids_are_dense_with_a_payload_outside_the_order(spark):
    df = spark.range(0, 200_000, 1, 7).select((F.xxhash64("id") % 10**9).alias("k"), F.col("id"), F.concat(F.lit("p"), F.col("id")).alias("payload"))
    r = mg.surrogate_ids(df, "sid", ["k", "id"], 5, partitions=9).agg(
        F.min("sid"), F.max("sid"), F.countDistinct("sid"), F.count(F.lit(1))).first()
    assert tuple(r) == (6, 200_005, 200_000, 200_000)


def test_merge_keeps_columns_of_both_sides_and_reads_file_names(spark):
    kept = mg.conform("shapes", spark.createDataFrame([("H1", 0, 1.5, 2.5, "loc")], "shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double, shape_pt_loc string"))
    r = kept.first()
    assert (r.lat, r.lon, r.shape_pt_loc) == (1.5, 2.5, "loc")


def test_null_keys_stay_null_after_a_left_remap(spark):
    src = {"routes": spark.createDataFrame([("R1", "A1")], "route_id string, agency_id string")}
    mapping = mg.Mapping(src, SALT, RUN)
    df = spark.createDataFrame([(1, "R1"), (2, None), (3, "R9")], "n int, route_id string")
    got = {r.n: r.route_id for r in mg._remap(df, mapping, "routes", "route_id", "left").collect()}
    assert got[2] is None and got[3] is None and got[1].startswith("ro_")


def test_publish_swaps_all_tables_at_once(spark, tmp_path):
    src, tgt = _split(spark)
    pointer = f"{tmp_path}/pointer"
    for run in (RUN, RUN + 1):
        staging = f"{tmp_path}/stage-{run}"
        tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=run, salt=SALT,
                                      staging_dir=staging, feed_info_key=["feed_publisher_name"])
        assert report.first().status != "error"
        mg.publish(spark, pointer, run, staging, list(tables))
    now = mg.published(spark, pointer)
    assert now.keys() == tables.keys()
    assert now["agency"].where(F.col("agency_id").endswith(f"_{RUN + 1}")).count() == 2
    # a failing merge publishes nothing, so the current version stays
    _, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="a", run_ms=RUN + 2, salt=SALT)
    assert report.first().status == "error" and mg.published(spark, pointer)["trips"].count() == tables["trips"].count()


def test_colliding_ids_are_hashed_again(spark):
    ids = spark.range(0, 900).select(F.lit("trips").alias("table_name"), F.concat(F.lit("T"), F.col("id")).alias("old_id"))
    taken = ids.limit(0).select(F.lit("x").alias("id")).unionByName(
        ids.where("old_id IN ('T1', 'T2')").select(mg.new_id(F.lit("trips"), F.col("old_id"), SALT, RUN, 0, 3).alias("id")))
    rows = mg.unique_ids(ids, SALT, RUN, taken=taken, hex_chars=3).collect()
    new = {r.old_id: r.new_id for r in rows}
    assert len(rows) == 900 and len(set(new.values())) == 900            # 900 ids in 4096 places
    assert not set(new.values()) & {r.id for r in taken.collect()}
    again = {r.old_id: r.new_id for r in mg.unique_ids(ids, SALT, RUN, taken=taken, hex_chars=3).collect()}
    assert again == new
    # ids that do not collide keep their first try
    first = {r.old_id: r.n for r in ids.select("old_id", mg.new_id(F.lit("trips"), F.col("old_id"), SALT, RUN, 0, 3).alias("n")).collect()}
    assert sum(first[k] == new[k] for k in new) > 650
    with pytest.raises(mg.MergeError, match="collide"):
        mg.unique_ids(ids.limit(20), SALT, RUN, hex_chars=1)              # 20 ids in 16 places


def test_ids_are_hashed_again_until_all_are_settled(spark):
    ids = spark.range(0, 250).select(F.when(F.col("id") % 3 == 0, "stops").otherwise("stop_areas").alias("table_name"), F.concat(F.lit("S"), F.col("id")).alias("old_id"))
    taken = spark.createDataFrame([(f"st_{k:02x}_{RUN}",) for k in (0, 17, 255)] + [("st_zz_1",), (None,)], "id string")

    def tried(table, old, again):
        return f"st_{md5((table + old + SALT + (f'#{again}' if again else '')).encode()).hexdigest()[:2]}_{RUN}"
    want, gone, pending, again = {}, {r.id for r in taken.collect()}, sorted(map(tuple, ids.collect())), 0
    while pending:                                                          # 250 ids in 253 places, round by round
        for k in pending:
            if (new := tried(*k, again)) not in gone:
                want[k] = new
                gone.add(new)
        pending, again = [k for k in pending if k not in want], again + 1
    assert again > 100
    got = mg.unique_ids(ids, SALT, RUN, taken=taken, hex_chars=2).collect()
    assert len(got) == 250 and {(r.table_name, r.old_id): r.new_id for r in got} == want
    # an id more than there are new ids: no number of tries can do
    full = spark.range(0, 16).select(F.lit("trips").alias("table_name"), F.concat(F.lit("T"), F.col("id")).alias("old_id"))
    assert mg.unique_ids(full, SALT, RUN, hex_chars=1).select("new_id").distinct().count() == 16
    with pytest.raises(mg.MergeError, match="16 ids tr_, 1 hexadecimal digits leave 15"):
        mg.unique_ids(full, SALT, RUN, taken=spark.createDataFrame([(f"tr_a_{RUN}",)], "id string"), hex_chars=1)


def test_a_merge_with_collisions_succeeds(spark, monkeypatch):
    monkeypatch.setattr(mg.Mapping.__init__, "__defaults__", (None, None, 4))
    src, tgt = _split(spark)
    tables, report = mg.run_merge(spark, src, tgt, source_schema="a", target_schema="b", run_ms=RUN, salt=SALT, feed_info_key=["feed_publisher_name"])
    assert report.first().status == "success"
    assert tables["trips"].groupBy("trip_id").count().where("count > 1").isEmpty()


def test_second_writer_gets_a_conflict(spark, tmp_path):
    src, _ = _split(spark)
    pointer = f"{tmp_path}/log"
    base = {t: src[t] for t in ("agency", "routes")}
    for t, d in base.items():
        d.withColumn(mg.ORIGIN, F.lit("kept")).write.parquet(f"{tmp_path}/v1/{t}")
    assert mg.publish(spark, pointer, RUN, f"{tmp_path}/v1", list(base), expected=0) == 1
    new = {"agency": spark.createDataFrame([("Z", "Zed")], "agency_id string, agency_name string"),
           "routes": spark.createDataFrame([("RZ", "Z", "1700")], "route_id string, agency_id string, route_type string")}
    kw = dict(source_schema="a", target_schema="b", salt=SALT, enum_labels={"route_type_val": ["0", "1", "2", "3", "1700"]})
    # another writer publishes between this merge's read and its own publish
    original = mg.run_merge

    def slow(*args, **kwargs):
        out = original(*args, **kwargs)
        mg.publish(spark, pointer, RUN + 5, f"{tmp_path}/v1", list(base), expected=1)
        return out
    mg.run_merge = slow
    try:
        tables, report = mg.merge_into_published(spark, new, pointer, staging_dir=f"{tmp_path}/lost", run_ms=RUN + 1, **kw)
    finally:
        mg.run_merge = original
    r = report.first()
    assert r.status == "error" and r.error_detail == "40001" and tables["agency"].count() == base["agency"].count()
    # run again on the version that won
    tables, report = mg.merge_into_published(spark, new, pointer, staging_dir=f"{tmp_path}/v3", run_ms=RUN + 2, **kw)
    assert report.first().status == "success"
    assert mg.published(spark, pointer)["agency"].count() == base["agency"].count() + 1
    assert mg.published(spark, pointer, 1)["agency"].count() == base["agency"].count()
    with pytest.raises(KeyError):
        mg.published(spark, pointer, 9)


def test_feed_info_keeps_columns_of_both_sides(spark):
    src = spark.createDataFrame([("p", "1", "x"), ("p", "2", "a"), (None, "3", "n"), (None, "3", "n"), ("q", "4", "y")], "feed_publisher_name string, feed_version string, feed_contact string")
    tgt = spark.createDataFrame([("q", "en")], "feed_publisher_name string, feed_lang string")
    got = mg.merge_feed_info(src, tgt, ["feed_publisher_name"])
    assert got.columns == ["feed_publisher_name", "feed_lang", "feed_version", "feed_contact"]
    assert sorted(map(tuple, got.collect()), key=str) == [("p", None, "2", "a"), (None, None, "3", "n"), (None, None, "3", "n")]
    with pytest.raises(mg.MergeError, match="missing"):
        mg.merge_feed_info(src.drop("feed_publisher_name"), tgt, ["feed_publisher_name"])


def test_labels_come_from_the_target_too(spark):
    tgt = {"routes": spark.createDataFrame([("R1", "1702"), ("R2", None)], "route_id string, route_type string")}
    labels = mg.target_labels(tgt)
    src = spark.createDataFrame([("A", "1702"), ("B", "1703"), ("C", "3"), ("D", None)], "route_id string, route_type string")
    ok, bad = mg.enum_cast(src, "routes", labels)
    assert {r.route_id for r in ok.collect()} == {"A", "C", "D"} and [r._enum_bad for r in bad.collect()] == [["route_type"]]


def test_surrogates_of_equal_rows_are_dense_and_spread(spark):
    df = spark.range(0, 60_000, 1, 6).select(F.lit("same").alias("k"), F.lit(1).alias("n"))
    out = mg.surrogate_ids(df, "sid", ["k", "n"], 100, partitions=8).withColumn("pid", F.spark_partition_id())
    assert tuple(out.agg(F.min("sid"), F.max("sid"), F.countDistinct("sid")).first()) == (101, 60_100, 60_000)
    sizes = [r["count"] for r in mg.surrogate_ids(df, "sid", ["k", "n"], 0, partitions=8).withColumn("b", F.floor((F.col("sid") - 1) / 7500)).groupBy("b").count().collect()]
    assert len(sizes) == 8
    pieces = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(8, "k", "n", "_tie").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(pieces) >= 6 and max(r["count"] for r in pieces) < 60_000 / 3
