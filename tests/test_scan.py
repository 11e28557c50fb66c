"""The block-split running scan equals plain per-key windows, hot and null keys included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stopwise.functions.scan import ordered_prefix, previous_in_order, with_blocks_of


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("block", [1, 3, 16, 1 << 20])
def test_ordered_prefix_equals_windows(spark, block, dense):
    rng = random.Random(block)
    rows = []
    for seq in range(600):
        k = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        rows.append((k, rng.choice([None, "x"]), seq * 2 + rng.randint(0, 1), rng.uniform(-5, 50), rng.randint(0, 9)))
    df = spark.createDataFrame(rows, "k1 string, k2 string, seq long, v double, t long")
    got = ordered_prefix(df, ["k1", "k2"], "seq", max_of=["v"], lag_of=["t"], block_size=block, dense=dense)
    w = Window.partitionBy("k1", "k2").orderBy("seq")
    want = df.select("k1", "k2", "seq", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v_run_max"),
                     F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("v_prev_max"),
                     F.lag("t").over(w).alias("t_prev"), F.row_number().over(w).cast("long").alias("row_no"))
    cols = ["k1", "k2", "seq", "v_run_max", "v_prev_max", "t_prev", "row_no"]
    a = sorted(tuple(r) for r in got.select(*cols).fillna("~", ["k1", "k2"]).collect())
    b = sorted(tuple(r) for r in want.select(*cols).fillna("~", ["k1", "k2"]).collect())
    assert a == b


def test_rows_without_an_order_value_are_kept_first(spark):
    rows = [("a", None, 1.0, 7), ("a", 5, 2.0, 8), ("a", 1, 3.0, 9), ("b", None, 4.0, 1), (None, 2, 5.0, 2)]
    df = spark.createDataFrame(rows, "k string, seq long, v double, t long")
    got = {(r.k, r.seq): (r.row_no, r.v_run_max, r.t_prev) for r in ordered_prefix(df, ["k"], "seq", max_of=["v"], lag_of=["t"], block_size=2).collect()}
    assert got == {("a", None): (1, 1.0, None), ("a", 1): (2, 3.0, 7), ("a", 5): (3, 3.0, 9), ("b", None): (1, 4.0, None), (None, 2): (1, 5.0, None)}


@pytest.mark.parametrize("names", ["dense", "ten seconds", "milliseconds", "bursts", "negative"])
def test_blocks_follow_the_rows_not_the_values(spark, names):
    """10^6 snapshots of one feed, named any way, make about rows / block blocks, none of them crowded."""
    n, block = 1_000_000, 1 << 16
    i = F.col("id")
    name = {"dense": i, "ten seconds": 1_700_000_000 + i * 10, "milliseconds": 1_700_000_000_000 + i * 10_000,
            "bursts": F.when(i < n // 2, i * 1000).otherwise(2_000_000_000_000 + i), "negative": -i * 7}[names].cast("long")
    df = spark.range(0, n, 1, 4).select(F.lit("feed").alias("feed"), name.alias("snapshot_no"))
    sizes = [r["count"] for r in with_blocks_of(df, ["feed"], "snapshot_no", block).groupBy("_blk").count().collect()]
    assert sum(sizes) == n and len(sizes) <= 4 * (n // block + 1) and max(sizes) <= 2 * block + 2


def test_previous_in_order_over_sparse_names(spark):
    rng = random.Random(3)
    names = sorted(rng.sample(range(10**13), 500)) + [10**15, 10**15 + 1]
    rng.shuffle(names)
    df = spark.createDataFrame([("f" if i % 50 else "g", n, i % 7) for i, n in enumerate(names)], "feed string, snapshot_no long, header_ts long")
    got = {(r.feed, r.snapshot_no): (r.header_ts_prev, r.row_no) for r in previous_in_order(df, ["feed"], "snapshot_no", ["header_ts"], block_size=9).collect()}
    w = Window.partitionBy("feed").orderBy("snapshot_no")
    want = {(r.feed, r.snapshot_no): (r.p, r.n) for r in df.select("feed", "snapshot_no", F.lag("header_ts").over(w).alias("p"), F.row_number().over(w).alias("n")).collect()}
    assert got == want
