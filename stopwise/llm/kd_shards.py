"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

A node of the tree holds documents that will fill ``k`` shards. It is split along its widest
metadata dimension (range in the node over range in the table) at the weighted quantile
that gives ``k // 2`` shards' bytes to the left; the tree ends when every node is one shard.
All nodes of a level are split together.

*Distributed weighted quantile.* The documents are never sorted. Each pass cuts a node's
value interval into ``BINS`` bins, adds up the bytes per bin (combined map-side; at most
nodes x BINS rows are shuffled) and goes on inside the bin that holds the quantile, until
one value is left. Documents that share that value are cut by doc_id in the same way, and
equal ids by a row number, so a value that a third of all rows hold is split like any other.

Defined results: null text has size 1 (0 bytes plus 1); a null id, language or source is the
smallest value of its dimension; equal rows can land in different shards; an empty table gives
an empty result; extra columns are ignored. Copies of one text are split like other rows, as
a group may be larger than a shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

BINS = 4096
SLOT_ROWS = 1024
NO_ID = -(2**63) + 1
DIMENSIONS = ("place", "origin", "tongue", "length")


def slim(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row, dimensions) of every document, stored; texts are read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    code = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")), F.lit(-1)).cast("long")
    return stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
        F.floor(F.log2(size.cast("double")) * 64).alias("length"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("place"),
        code("source").alias("origin"), code("lang").alias("tongue")), "slim")


@dataclass
class Node:
    """A node of the level being split, and where its quantile is known to lie.

    Rows are ordered by (dimension, place, row); ``found`` holds the cut's values so far."""
    number: int                # also the number of its first shard
    shards: int                # it will fill so many
    dimension: int = -1
    goal: int = 0              # bytes that go left
    lo: int = 0
    hi: int = 0
    below: int = 0             # bytes of the node below ``lo``
    found: list[int] = field(default_factory=list)
    weight: int = 0            # bytes at the value found
    open: bool = True

    @property
    def keeps(self) -> bool:
        """Whether the row at the cut goes left: on the side that is nearer to the goal."""
        return 2 * (self.goal - self.below) >= self.weight

    @property
    def width(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // BINS))


STATE_DDL = "node int, right_node int, dim int, depth int, v0 long, v1 long, v2 long, lo long, hi long, width long, need long, keeps boolean"


def _with_state(rows: DataFrame, nodes: list[Node]) -> DataFrame:
    """Join the nodes' state (one row per node, at most one per shard) and add ``dimval`` and ``searched``."""
    kinds = [c.strip().split(" ") for c in STATE_DDL.split(",")]
    told = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(
        (n.number, n.number + n.shards // 2, n.dimension, len(n.found), *(n.found + [None] * 3)[:3], n.lo, n.hi, n.width, n.goal - n.below, n.keeps), kinds, strict=True)]) for n in nodes]
    state = rows.sparkSession.range(1).select(F.inline(F.array(*told)))        # literals of the plan: no Python on the executors
    dimval = F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), F.col("dim") + 1)
    searched = (F.when(F.col("depth") == 0, F.col("dimval"))
                .when((F.col("depth") == 1) & (F.col("dimval") == F.col("v0")), F.col("place"))
                .when((F.col("depth") == 2) & (F.col("dimval") == F.col("v0")) & (F.col("place") == F.col("v1")), F.col("row")))
    return rows.join(F.broadcast(state), "node").withColumn("dimval", dimval).withColumn("searched", searched)


def _narrow(rows: DataFrame, nodes: list[Node]) -> None:
    """One pass over all nodes in ``nodes``: go on in the bin that holds the quantile."""
    upto = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    # Whole-number division: a rounded quotient could name the bin after the right one.
    inside = F.expr("(cast(searched as decimal(38,0)) - lo) div width")
    sums = (_with_state(rows, nodes).where("searched between lo and hi").groupBy("node", inside.alias("bin"))
            .agg(F.sum("size").alias("b"), F.first("need").alias("need")).withColumn("upto", F.sum("b").over(upto)))
    got = sums.groupBy("node").agg(F.min(F.when(F.col("upto") >= F.col("need"), F.struct("bin", "upto", "b"))).alias("at"),
                                   F.max(F.struct("bin", "upto", "b")).alias("last")).collect()
    at = {r.node: r["at"] or r["last"] for r in got}
    for n in nodes:
        r, width = at[n.number], n.width
        n.lo, n.below, n.weight = n.lo + r["bin"] * width, n.below + r["upto"] - r["b"], r["b"]
        n.hi = min(n.hi, n.lo + width - 1)


def _find_cuts(rows: DataFrame, nodes: list[Node], spread: list[int]) -> None:
    """Choose every node's widest dimension and find its cut."""
    per = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))])
    by_number = {n.number: n for n in nodes}
    for r in per.collect():
        if n := by_number.get(r["node"]):
            wide = [(r[f"hi_{d}"] - r[f"lo_{d}"]) / s for d, s in zip(DIMENSIONS, spread, strict=True)]
            n.dimension = wide.index(max(wide))
            n.lo, n.hi = r[f"lo_{DIMENSIONS[n.dimension]}"], r[f"hi_{DIMENSIONS[n.dimension]}"]
            n.goal = r["bytes"] * (n.shards // 2) // n.shards
    for n in nodes:
        n.open = n.dimension >= 0            # an empty node has nothing to cut
    while todo := [n for n in nodes if n.open]:
        while wide := [n for n in todo if n.lo < n.hi]:
            _narrow(rows, wide)
        for n in todo:
            n.found.append(n.lo)
            n.open = len(n.found) < 3
        # Rows that share the value found: cut them by the next column.
        if todo := [n for n in todo if n.open]:
            held = _with_state(rows, todo).where("searched is not null").groupBy("node").agg(
                F.min("searched").alias("lo"), F.max("searched").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).collect()
            ties = {r["node"]: r for r in held}
            for n in todo:
                r = ties[n.number]
                n.lo, n.hi, n.weight, n.open = r["lo"], r["hi"], r["b"], r["n"] > 1


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` (0 .. shards - 1) to the rows of ``slim``: the leaves of the tree, near-equal in bytes."""
    ends = rows.agg(*[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))]).first()
    rows = rows.withColumn("node", F.lit(0))
    level = [Node(0, shards)]
    spread = [max((ends[f"hi_{d}"] or 0) - (ends[f"lo_{d}"] or 0), 1) for d in DIMENSIONS]
    while parts := [n for n in level if n.shards > 1]:
        _find_cuts(rows, parts, spread)
        # Left: below the cut row in (dimension, place, row) order, and that row itself where it is nearer.
        left = F.col("keeps")
        for value, bound in (("row", "v2"), ("place", "v1"), ("dimval", "v0")):
            left = F.when(F.col(bound).isNull(), left).otherwise((F.col(value) < F.col(bound)) | ((F.col(value) == F.col(bound)) & left))
        keep = [c for c in rows.columns if c != "node"]
        cut = _with_state(rows, parts).select(*keep, F.when(F.coalesce(left, F.lit(True)), F.col("node")).otherwise(F.col("right_node")).alias("node"))
        done = rows.where(~F.col("node").isin([n.number for n in parts])).select(*keep, "node")
        rows = stored(cut.union(done), "kd-level")
        level = [n for n in level if n.shards == 1] + [Node(n.number, n.shards // 2) for n in parts] + [
            Node(n.number + n.shards // 2, n.shards - n.shards // 2) for n in parts]
    return rows.withColumnRenamed("node", "shard")


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """How many leaves reach ``target_bytes`` or less on average."""
    total = rows.agg(F.sum("size").alias("s")).first().s or 0
    return max(1, -(-total // target_bytes))


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard. A shard is numbered in many pieces, by hash of the id."""
    most = stored(rows, "sharded")
    pieces = max(1, -(-(most.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0) // SLOT_ROWS))
    pieced = most.withColumn("piece", F.pmod(F.xxhash64("doc_id", "row"), F.lit(pieces)))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieced.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "row")) - 1
    return pieced.withColumn("at", inside).join(bases, ["shard", "piece"]).withColumn("slot", (F.col("base") + F.col("at")).cast("long"))
