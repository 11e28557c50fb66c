"""Running aggregates in arrival order that stay parallel when one key is hot.

A window partitioned by the key alone sends every row of that key to one task; if a
single vehicle or trip key holds a third of the rows, that task is a third of the job.
Here each key with more than ``block_size`` rows is cut into blocks along the order. The window runs
inside every (key, block) group, and a per-block summary (one row per block, aggregated map-side) carries the running
state across block borders. The summary's own window sees about ``rows / block_size`` rows
per key, which is small. Both the window and the join back use the same struct key,
so the big side is shuffled once.

Blocks follow the data, not the values' size: a pass over (key, order) counts every key's rows and finds its smallest and
largest order value, and the range between them is cut into as many equal parts as the key has ``block_size`` rows. Parts that
are still crowded (bursts, outliers) are cut once more by their own range. So snapshots named by consecutive numbers, by seconds
or by milliseconds get the same few blocks, and every plan that reads the frame cuts them alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key per block, about (rows with one order value stay together).
DEFAULT_BLOCK = 1 << 20
# Block of rows whose order value is null, when blocks are value ranges: before all others.
NULL_BLOCK = -(1 << 62)
# A part with more than this many blocks' rows is cut again.
CROWDED = 2

KEY = "_key"
BLOCK = "_blk"


def key_struct(cols: Sequence[str]) -> Column:
    """Composite grouping key; struct equality treats null fields as equal (null-safe)."""
    return F.struct(*[F.col(c) for c in cols])


def _cut(d: DataFrame, by: Sequence[str], order: Column, limit: int, block_size: int, name: str) -> DataFrame:
    """Add ``name``: 0, or for groups of ``by`` with more than ``limit`` rows the part of the group's order range.

    Only crowded groups are joined back, by broadcast: there are at most rows / limit of them, a
    million for 10^12 rows and the default block, and usually none. The rows stay where they are."""
    stats = (d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi"))
             .where(F.col("_n") > limit))
    parts = F.ceil(F.col("_n") / F.lit(block_size))
    stats = stats.select(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(by)], "_lo", ((F.col("_hi") - F.col("_lo") + 1) / parts).alias("_width"))
    # A key that is a constant of the plan would leave no equality to join on; this one (0 on both sides) always does.
    stats = stats.withColumn("_zero", F.pmod(F.hash("_lo"), F.lit(1)))
    same = F.pmod(F.hash(order), F.lit(1)) == F.col("_zero")
    for i, c in enumerate(by):
        same = same & (F.col(c) == F.col(f"_of{i}"))
    part = F.floor((order - F.col("_lo")) / F.col("_width"))
    return (d.join(F.broadcast(stats), same, "left").withColumn(name, F.coalesce(part, F.lit(0)).cast("long"))
            .drop("_lo", "_width", "_zero", *[f"_of{i}" for i in range(len(by))]))


def with_blocks_of(df: DataFrame, keys: Sequence[str], order: str, block_size: int, dense: bool = False) -> DataFrame:
    """Add the struct key ``_key`` and the block ``_blk`` (ordered along ``order``; rows without an order value first)."""
    o = F.col(order)
    d = df.withColumn(KEY, key_struct(keys))
    if dense:
        return d.withColumn(BLOCK, F.coalesce(F.floor(o / F.lit(block_size)).cast("long"), F.lit(NULL_BLOCK)))
    d = _cut(d, [KEY], o, block_size, block_size, "_part")
    d = _cut(d, [KEY, "_part"], o, CROWDED * block_size, block_size, "_sub")
    # A null order value has no part: -1, before all others.
    return d.withColumn(BLOCK, F.struct(F.when(o.isNull(), F.lit(-1)).otherwise(F.col("_part")).alias("part"), F.col("_sub").alias("sub"))).drop("_part", "_sub")


def ordered_prefix(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str], *, max_of: Sequence[str] = (),
                   lag_of: Sequence[str] = (), block_size: int = DEFAULT_BLOCK,
                   keep_key: bool = False, with_blocks: bool = False, dense: bool = False):
    """Add per-key running state in ``seq`` order.

    ``seq`` is one numeric column or a list of columns (lexicographic order); blocks are
    cut on the first one, so it must be numeric and non-decreasing along the order. Rows
    with a null ``seq`` are kept: they come before all others.

    For each ``m`` in ``max_of``: ``{m}_run_max`` (rows up to and including this one)
    and ``{m}_prev_max`` (rows before; null for the first row of the key).
    For each ``c`` in ``lag_of``: ``{c}_prev`` (value of the previous row; null for the first).
    Always: ``row_no`` (1-based position within the key).

    ``dense``: order values are dense positions (broker offsets, row numbers), so that a block is a range of ``block_size``
    of them and no pass over the data measures them first.

    ``keep_key`` keeps the struct key and block columns (``_key``, ``_blk``), by which the
    result stays hash-partitioned. ``with_blocks`` also returns the per-block summary's
    (``_key``, ``_blk``) pairs, one row per block, for joins aligned with that partitioning.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    order_key = F.struct(*order)      # a struct is never null itself, so max_by sees every row
    d = with_blocks_of(df, keys, order[0], block_size, dense)
    w_in = Window.partitionBy(KEY, BLOCK).orderBy(*order)
    w_run = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_before = w_in.rowsBetween(Window.unboundedPreceding, -1)

    local = d.withColumn("_lrn", F.row_number().over(w_in))
    for m in max_of:
        local = (local.withColumn(f"_lmax_{m}", F.max(m).over(w_run))
                      .withColumn(f"_lmaxb_{m}", F.max(m).over(w_before)))
    for c in lag_of:
        local = local.withColumn(f"_llag_{c}", F.lag(c).over(w_in))

    aggs = [F.count(F.lit(1)).alias("_ccnt")]
    aggs += [F.max(m).alias(f"_cmax_{m}") for m in max_of]
    aggs += [F.max_by(c, order_key).alias(f"_clast_{c}") for c in lag_of]
    summ = d.groupBy(KEY, BLOCK).agg(*aggs)
    w_blk = Window.partitionBy(KEY).orderBy(BLOCK)
    w_blk_before = w_blk.rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_pcnt", F.sum("_ccnt").over(w_blk_before))
    for m in max_of:
        summ = summ.withColumn(f"_pmax_{m}", F.max(f"_cmax_{m}").over(w_blk_before))
    for c in lag_of:
        summ = summ.withColumn(f"_plast_{c}", F.lag(f"_clast_{c}").over(w_blk))
    summ = summ.drop("_ccnt", *[f"_cmax_{m}" for m in max_of], *[f"_clast_{c}" for c in lag_of])

    out = local.join(summ, [KEY, BLOCK], "inner")
    first_in_block = F.col("_lrn") == 1
    out = out.withColumn("row_no", (F.col("_lrn") + F.coalesce(F.col("_pcnt"), F.lit(0))).cast("long"))
    for m in max_of:
        out = (out.withColumn(f"{m}_run_max", F.greatest(F.col(f"_lmax_{m}"), F.col(f"_pmax_{m}")))
                  .withColumn(f"{m}_prev_max", F.greatest(F.col(f"_lmaxb_{m}"), F.col(f"_pmax_{m}"))))
    for c in lag_of:
        out = out.withColumn(f"{c}_prev", F.when(first_in_block, F.col(f"_plast_{c}")).otherwise(F.col(f"_llag_{c}")))
    drop = ["_lrn", "_pcnt"] + [f"_lmax_{m}" for m in max_of] + [f"_lmaxb_{m}" for m in max_of]
    drop += [f"_pmax_{m}" for m in max_of] + [f"_llag_{c}" for c in lag_of] + [f"_plast_{c}" for c in lag_of]
    if not keep_key:
        drop += [KEY, BLOCK]
    out = out.drop(*drop)
    return (out, summ.select(KEY, BLOCK)) if with_blocks else out


def previous_in_order(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str], cols: Sequence[str],
                      block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Previous row's ``cols`` per key in ``seq`` order (``{c}_prev``), hot-key safe."""
    return ordered_prefix(df, keys, seq, lag_of=cols, block_size=block_size)
