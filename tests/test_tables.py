"""Versioned tables: the log's compare-and-swap, the latest-position upsert, schema growth, expiries in event time."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from stopwise.sinks.lake_schema import SchemaRefused, SchemaTable, merged_schema
from stopwise.sinks.latest import latest_positions
from stopwise.sinks.latest_table import LatestTable
from stopwise.sinks.versions import Conflict, VersionLog
from stopwise.streaming import runner
from stopwise.streaming.latest_stream import latest_in_event_time

SCHEMA = "agency string, vehicle_id string, trip_id string, ts_ms long, seq long"


def test_one_of_many_writers_commits_a_version(spark, tmp_path):
    log = VersionLog(spark, f"{tmp_path}/log")
    assert log.latest() is None and log.read() is None

    def write(i):
        try:
            return VersionLog(spark, f"{tmp_path}/log").commit(1, {"by": i}) and i
        except Conflict:
            return None
    with ThreadPoolExecutor(4) as pool:
        won = [x for x in pool.map(write, range(1, 9)) if x]
    assert len(won) == 1 and log.read() == {"by": won[0]} and log.versions() == [1]


def records(rng, n, first):
    return [("A", f"V{rng.randint(0, 5)}", rng.choice([None, "", *[f"T{k}" for k in range(12)]]), rng.randint(0, 10**6), first + i) for i in range(n)]


def test_upserts_equal_the_batch_result_and_rewrite_touched_buckets_only(spark, tmp_path):
    rng = random.Random(1)
    table = LatestTable(spark, str(tmp_path), buckets=5)
    assert table.read() is None
    seen = []
    for i, n in enumerate([40, 3, 1, 0, 25]):
        batch = records(rng, n, len(seen))
        rng.shuffle(batch)
        seen += batch
        df = spark.createDataFrame(batch, SCHEMA)
        before = table.log.read()
        assert table.upsert(df, i)
        now = table.log.read()
        if before:
            kept = [b for b in before["files"] if int(b) not in now["touched"]]
            assert all(now["files"][b] == before["files"][b] for b in kept)
        assert not table.upsert(spark.createDataFrame([("A", "V9", "T1", 5, 10**9)], SCHEMA), i)          # the same batch id again
        want = sorted(map(str, latest_positions(spark.createDataFrame(seen, SCHEMA)).collect()))
        assert sorted(map(str, table.read().collect())) == want
    assert table.read(1).count() <= table.read().count()
    assert table.upsert(spark.createDataFrame([("A", "V9", "T1", 5, 10**9)], SCHEMA), 0, stream="other")  # another stream counts its own batches


def test_an_upsert_on_an_old_version_conflicts(spark, tmp_path):
    a, b = LatestTable(spark, str(tmp_path)), LatestTable(spark, str(tmp_path))
    df = spark.createDataFrame([("A", "V1", "T1", 1, 1)], SCHEMA)
    original = b.log.latest
    b.log.latest = lambda: None                      # b looked before a committed
    assert a.upsert(df, 0, "a")
    with pytest.raises(Conflict):
        b.upsert(df, 0, "b")
    b.log.latest = original
    assert b.upsert(df, 0, "b") and b.read().count() == 1


def test_schema_grows_and_widens_and_refuses_the_rest(spark, tmp_path):
    t = SchemaTable(spark, str(tmp_path))
    t.append(spark.createDataFrame([(1, 1.5)], "n int, x float"))
    t.append(spark.createDataFrame([(2**40, "a")], "n long, s string"))
    t.append(spark.createDataFrame([(3, 2.25, None)], "n int, x double, s string"))
    assert t.schema().simpleString() == "struct<n:bigint,x:double,s:string>" and t.schema(1).simpleString() == "struct<n:int,x:float>"
    assert sorted(map(tuple, t.read().collect())) == [(1, 1.5, None), (3, 2.25, None), (2**40, None, "a")]
    assert t.log.versions() == [1, 2, 3]
    for ddl, row in (("s int", (1,)), ("x string", ("y",)), ("n string", ("1",))):
        with pytest.raises(SchemaRefused):
            t.append(spark.createDataFrame([row], ddl))
    assert t.read().count() == 3 and t.log.versions() == [1, 2, 3]
    int_schema = spark.createDataFrame([], "n int").schema
    assert merged_schema(t.schema(), int_schema) == t.schema()                # a narrower value is cast up


def test_expiries_do_not_depend_on_the_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted(("A", "V", f"T{rng.randint(0, 6)}", rng.randint(0, 3_000_000), i) for i in range(120))
    rows.sort(key=lambda r: r[3])
    df = spark.createDataFrame(rows, SCHEMA)
    results = []
    for parts in (1, 3):
        root = f"{tmp_path}/{parts}"
        for p in range(parts):
            runner.append_in_order(df, f"{root}/in", "ts_ms", parts, range(p, p + 1))
            stream = latest_in_event_time(runner.read_files(spark, f"{root}/in", df.schema))
            runner.run_available_now(stream, f"{root}/out", f"{root}/ckpt")
        results.append(sorted(map(tuple, spark.read.parquet(f"{root}/out").collect())))
    newest, want = max(r[3] for r in rows), []
    for k in {r[2] for r in rows}:
        ts = [r[3] for r in rows if r[2] == k]
        want += [(f"vehpos:SL:{k}", a, a + 120_000) for a, b in zip(ts, [*ts[1:], None], strict=True) if (b is None and a + 120_000 <= newest) or (b is not None and b - a > 120_000)]
    assert results[0] == results[1] == sorted(want) and len(want) > 20


