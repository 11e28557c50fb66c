"""Mixing sources to target weights along a time-varying curriculum.

*Targets.* Sources share the words of the corpus by weight; no source is repeated more than
``CAP`` times, and what capped sources cannot take is shared anew by weight until nobody is
above the cap. The fixed point needs two numbers per round (words and weight still open),
which one aggregate over the per-source table gives.

*Curriculum.* A source's weight is piecewise linear in training time 0 .. 1. Its integral is
the source's cumulative token demand, scaled to the target. A source's documents lie on a
token line in hash order, again and again up to ``CAP`` times; the time at which the demand
reaches a copy's first token (the inverse of the integral, a quadratic per piece) is that
copy's training position. Copies are range-sorted by position.

The running sum along a source never runs over the source alone: a source is cut into hash
ranges of about ``BUCKET_ROWS`` documents, whose sums give each range its start.

Defined results: null text has size 0 and is taken 0 times; a null source is a source of its
own, last in order; equal rows each lie on the token line; an empty table, or one without
words, has targets 0; the last copy that a target reaches is cut to the words still wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import linking
from .shared import stored

CAP = 3
BUCKET_ROWS = 2048
WORDS = r"[^\x20\x09-\x0D]+"
# Piecewise-linear schedules: weight at each knot, as a multiple of the source's mean weight.
KNOTS = (0.0, 0.5, 1.0)
SHAPES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, row, source, size) of every document, stored: later passes read no texts. ``row`` is unique."""
    return stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(source_col).cast("string").alias("source"),
                              F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "sizes")


def source_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: size, rows, place in code-point order (null last) and weight from the repeating cycle."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    return stored(per.withColumn("place", place).withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in cycle]), F.col("place") % len(cycle) + 1)), "sources")


def capped_targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target``: weight shares of all words, capped at ``cap`` times the source, the excess reshared."""
    whole = "decimal(38,0)"
    size, weight = F.col("source_size").cast(whole), F.col("weight").cast(whole)

    def above(words: int, open_weight: int) -> Column:
        return weight * F.lit(words).cast(whole) > size * F.lit(cap * open_weight).cast(whole)

    total, words, open_weight = 0, 0, 0
    first = sources.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    if first.w:
        total = words = int(first.s)
        open_weight = int(first.w)
    while True:
        full = above(words, open_weight)
        r = sources.agg(F.coalesce(F.sum(F.when(full, size)), F.lit(0)).alias("s"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("w")).first()
        state = (total - cap * int(r.s), int(r.w))
        if state == (words, open_weight) or not state[1]:
            break
        words, open_weight = state
    share = (F.col("weight") * F.lit(words).cast("long")).cast("double") / F.lit(float(max(open_weight, 1)))
    return sources.withColumn("target", F.when(above(words, open_weight), (F.col("source_size") * cap).cast("double")).otherwise(share))


def with_schedules(sources: DataFrame, knots: tuple[float, ...] = KNOTS, shapes: tuple[tuple[float, ...], ...] = SHAPES) -> DataFrame:
    """Add each source's weights at the knots and their integral up to each knot (shapes repeat in source order)."""
    pick = F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in shapes]), (F.col("place") % len(shapes)).cast("int") + 1)
    cum = [F.lit(0.0)]
    for i in range(1, len(knots)):
        cum.append(cum[-1] + (F.col("curve")[i] + F.col("curve")[i - 1]) * F.lit((knots[i] - knots[i - 1]) / 2))
    return sources.withColumn("curve", pick).withColumn("demand", F.array(*cum))


def time_of(share: Column, curve: Column, demand: Column, knots: tuple[float, ...] = KNOTS) -> Column:
    """Inverse of the cumulative demand: the time at which ``share`` (0 .. 1) of it is used up."""
    y = share * demand[len(knots) - 1]
    out = F.lit(None).cast("double")
    for i in reversed(range(len(knots) - 1)):
        left = F.greatest(y - demand[i], F.lit(0.0))
        slope = (curve[i + 1] - curve[i]) / F.lit(knots[i + 1] - knots[i])
        root = curve[i] + F.sqrt(F.greatest(curve[i] * curve[i] + 2 * slope * left, F.lit(0.0)))
        tau = F.when(root > 0, 2 * left / root).otherwise(0.0)
        piece = F.lit(float(knots[i])) + F.least(tau, F.lit(knots[i + 1] - knots[i]))
        out = piece if i == len(knots) - 2 else F.when(y < demand[i + 1], piece).otherwise(out)
    return out


def placed(sizes: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Every document with its source's figures, its start on the source's token line and the words each copy gives."""
    per_source = linking.bounded(stored(with_schedules(capped_targets(sources, cap)).withColumn(
        "buckets", F.ceil(F.col("rows") / BUCKET_ROWS)).withColumnRenamed("source", "source_name"), "targets"))
    lot = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    joined = (sizes.join(per_source, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name").withColumn("lot", lot)
              .withColumn("bucket", F.floor(F.conv(F.substring("lot", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(2**32))))
    upto = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (joined.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
              .withColumn("base", F.coalesce(F.sum("words").over(upto), F.lit(0))).drop("words"))
    inside = Window.partitionBy("place", "bucket").orderBy("lot", "size", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    wanted = F.floor("target")
    copy = lambda c: F.greatest(F.lit(0), F.least(F.col("size"), wanted - (F.col("start") + c * F.col("source_size"))))
    return joined.join(starts, ["place", "bucket"]).withColumn("start", start).withColumn("gives", F.array(*[copy(c).cast("long") for c in range(cap)]))


def copies(placed_docs: DataFrame) -> DataFrame:
    """(doc_id, row, copy, size, words, position): one row per copy that gives words, range-sorted by training position."""
    rows = placed_docs.select("doc_id", "row", "size", "start", "source_size", "target", "curve", "demand", F.posexplode("gives").alias("copy", "words")).where("words > 0")
    share = (F.col("start") + F.col("copy") * F.col("source_size")) / F.col("target")
    return (rows.select("doc_id", "row", "copy", "size", "words", time_of(share, F.col("curve"), F.col("demand")).alias("position"))
            .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id", "copy"))


def taken(placed_docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words that the scheduled copies take of each document, repeats counted.

    The schedule (``copies``) is written out, positions and order included; a document that no
    copy takes has 0. Rows meet their copies by ``row``, so null and repeated ids are safe."""
    docs = stored(placed_docs, "placed")
    per_row = stored(copies(docs), "copies").groupBy("row").agg(F.sum("words").alias("taken"))
    return (docs.select("row", "doc_id", "size", "source_size", "target").join(per_row, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
