"""Vector codes by exact integer Lloyd rounds over partition-local cover trees.

A vector is cut into ``PARTS`` consecutive parts; each part position has a codebook of up to
``ENTRIES`` entries, refined by ``ROUNDS`` rounds of Lloyd's algorithm on whole numbers
(``floor(SCALE * x)``, floors go down, ties to the lower index).

*Trees.* A task cuts its vectors into blocks of at most ``BLOCK`` rows and builds one cover
tree per block and part. A node covers a contiguous range of the tree's point order; its
centre is the first point of that range, its radius the largest distance to a point below.
A node's children cover it with half its radius, each child's centre being further than that from the
centres before it. Ranges of at most ``LEAF`` points, or of one distinct point, are leaves. Running sums
over the point order give the sum of any subtree by one subtraction. The trees are built once and stored; a round reads them
again, block by block.

*Assignment.* Going down level by level, a node keeps the entries that can still be nearest
for some point below it: entry c drops out when ``d(c) - radius > d(best) + radius``. With one
entry left the whole subtree is assigned by its running sum. Only leaves that stay ambiguous are
compared point by point, in whole numbers, so the result is that of plain Lloyd, bit for bit.

What travels: per task one row for each part and entry (count and componentwise sums), added
up by Spark; the driver holds the codebooks (``PARTS * ENTRIES`` entries) and nothing else.

Defined results: rows whose vector is null or holds a null or non-finite component are left out,
as are rows whose length is not a positive multiple of ``PARTS`` or is not that of the vector with the smallest id
(no codebook fits them). A null id sorts last; equal ids are ordered by their vectors. Fewer than
``ENTRIES`` vectors give shorter codebooks. Null labels form one group. Repeated rows are coded
alike and counted each. An empty table gives no rows. Extra columns are ignored.
Components beyond ``LIMIT`` after scaling would overflow 64-bit distances; they raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import concat_runs, ship_package, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK, LEAF = 8192, 24
LIMIT = 1 << 28
SLACK = 1e-3               # added to bounds that were rounded to doubles; larger only means more exact comparisons
SALTS = 16


# ---------------------------------------------------------------- trees (inside tasks)

@dataclass
class Tree:
    """Cover tree over the rows of one part. ``points`` are in tree order; nodes are rows of
    ``start, end, first child, children, squared radius``."""
    points: np.ndarray
    order: np.ndarray
    nodes: np.ndarray


def cover_tree(x: np.ndarray) -> Tree:
    x = x.astype(np.int64)
    order = np.arange(len(x))
    nodes: list[list[int]] = [[0, len(x), 0, 0, 0]] if len(x) else []
    at = 0
    while at < len(nodes):
        lo, hi = nodes[at][:2]
        here = order[lo:hi]
        pts = x[here]
        off = pts - pts[0]
        far = np.einsum("ij,ij->i", off, off)
        r2 = int(far.max())
        nodes[at][4] = r2
        if r2 and hi - lo > LEAF:
            nodes[at][2] = len(nodes)
            left = np.arange(len(pts))
            pieces, pos = [], lo
            while len(left):
                near = far * 4 <= r2                       # covered by the child centred at left[0]
                inside = left[near]
                pieces.append(inside)
                nodes.append([pos, pos + len(inside), 0, 0, 0])
                pos += len(inside)
                left = left[~near]
                if len(left):
                    off = pts[left] - pts[left[0]]
                    far = np.einsum("ij,ij->i", off, off)
            nodes[at][3] = len(pieces)
            order[lo:hi] = here[np.concatenate(pieces)]
        at += 1
    return Tree(x[order], order, np.array(nodes, np.int64).reshape(-1, 5))


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    off = x[:, None, :] - book[None, :, :]
    return np.einsum("nkd,nkd->nk", off, off)


def assign(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole subtrees ``(start, end, entry)`` as rows, and single points ``(position, entry)``.

    Returns starts, ends, entries of the ranges (a point is a range of one) and the number of
    exact point comparisons (one number)."""
    starts, ends, entries = [], [], []
    compared = 0
    nodes = tree.nodes
    idx = np.zeros(min(1, len(nodes)), np.int64)
    cand = np.ones((len(idx), len(book)), bool)
    big = np.iinfo(np.int64).max
    while len(idx):
        n = nodes[idx]
        d2 = np.where(cand, _distances(tree.points[n[:, 0]], book), big)
        d, r = np.sqrt(d2.astype(np.float64)), np.sqrt(n[:, 4].astype(np.float64))[:, None]
        best = d2.argmin(1)                               # first of equals: the lower index
        cand &= d <= d[np.arange(len(idx)), best][:, None] + 2 * r + SLACK
        whole = (cand.sum(1) == 1) | (n[:, 4] == 0)
        starts.append(n[whole, 0]), ends.append(n[whole, 1]), entries.append(best[whole])
        leaf = ~whole & (n[:, 3] == 0)
        if leaf.any():
            size = n[leaf, 1] - n[leaf, 0]
            pos = concat_runs(n[leaf, 0], size)
            near = np.where(np.repeat(cand[leaf], size, 0), _distances(tree.points[pos], book), big).argmin(1)
            starts.append(pos), ends.append(pos + 1), entries.append(near)
            compared += len(pos)
        down = ~whole & ~leaf
        kids = n[down, 3]
        idx, cand = concat_runs(n[down, 2], kids), np.repeat(cand[down], kids, 0)
    if not starts:
        return (np.empty(0, np.int64),) * 3 + (np.array(0),)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(entries), np.array(compared)


def entry_sums(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and componentwise sums of each entry, by differences of running sums."""
    s, e, k, _ = assign(tree, book)
    running = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, out=running[1:])
    count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    np.add.at(count, k, e - s)
    np.add.at(total, k, running[e] - running[s])
    return count, total


def nearest(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row, in the order of the rows given to ``cover_tree``."""
    s, e, k, _ = assign(tree, book)
    at = np.empty(len(tree.points), np.int64)
    at[concat_runs(s, e - s)] = np.repeat(k, e - s)
    off = tree.points - book[at]
    code, error = np.empty_like(at), np.empty_like(at)
    code[tree.order], error[tree.order] = at, np.einsum("ij,ij->i", off, off)
    return code, error


# ---------------------------------------------------------------- Spark

def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, v``: kept rows, components as whole numbers."""
    broken = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x: Column) -> Column:
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) <= LIMIT, F.floor(y)).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT // SCALE}")).cast("long"))

    n = F.size(vector_col)
    return (table.where(F.col(vector_col).isNotNull() & ~broken & (n > 0) & (n % PARTS == 0))
            .select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(vector_col, whole).alias("v")))


def first_codebooks(vectors: DataFrame) -> np.ndarray:
    """parts x entries x positions, from the vectors of the smallest ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    rows = [r.v for r in rows if len(r.v) == len(rows[0].v)]
    if not rows:
        return np.zeros((PARTS, 0, 0), np.int64)
    x = np.array(rows, np.int64)
    return np.ascontiguousarray(x.reshape(len(x), PARTS, -1).transpose(1, 0, 2))


def plant(vectors: DataFrame, length: int) -> DataFrame:
    """One stored row per block: ids, labels, and the trees of all parts."""
    ship_package(vectors.sparkSession)
    kinds = {f.name: f.dataType for f in vectors.schema.fields}
    schema = T.StructType([T.StructField("ids", T.ArrayType(kinds["vec_id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
                           T.StructField("points", T.ArrayType(T.IntegerType())), T.StructField("place", T.ArrayType(T.IntegerType())),
                           T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("node_count", T.ArrayType(T.IntegerType()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows)
            x = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, PARTS, -1)
            trees = [cover_tree(x[:, p]) for p in range(PARTS)]

            def listed(a: np.ndarray | pa.Array) -> pa.Array:
                a = pa.array(a) if isinstance(a, np.ndarray) else a
                return pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)

            return pa.record_batch([
                listed(t["vec_id"].combine_chunks()), listed(t["label"].combine_chunks()),
                listed(np.concatenate([q.points.ravel() for q in trees]).astype(np.int32)),
                listed(np.concatenate([q.order for q in trees]).astype(np.int32)),
                listed(np.concatenate([q.nodes.ravel() for q in trees])),
                listed(np.array([len(q.nodes) for q in trees], np.int32))],
                names=["ids", "labels", "points", "place", "nodes", "node_count"])

        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            while b.num_rows:
                take = b.slice(0, BLOCK - n)
                held.append(take)
                n += take.num_rows
                b = b.slice(take.num_rows)
                if n == BLOCK:
                    yield one(held)
                    held, n = [], 0
        if held:
            yield one(held)

    return stored(vectors.where(F.size("v") == length).mapInArrow(build, schema), "cover-trees", "zstd")


def _trees(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, list[Tree]]]:
    """Row number and trees of each block."""
    for i in range(batch.num_rows):
        points, place, nodes, counts = (np.asarray(batch.column(c)[i].values) for c in ("points", "place", "nodes", "node_count"))
        n, ends = len(place) // PARTS, np.cumsum(counts) * 5
        yield i, [Tree(points[p * n * (length // PARTS): (p + 1) * n * (length // PARTS)].reshape(n, -1).astype(np.int64),
                       place[p * n: (p + 1) * n], nodes[ends[p] - counts[p] * 5: ends[p]].reshape(-1, 5)) for p in range(PARTS)]


def lloyd_round(trees: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """The codebooks after one round: entries that have parts move to the floor of their mean."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            for _, forest in _trees(b, length):
                for p, tree in enumerate(forest):
                    c, t = entry_sums(tree, books[p])
                    count[p] += c
                    total[p] += t
        for p, k in zip(*np.nonzero(count), strict=True):
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([k], pa.int32()), pa.array([count[p, k]], pa.int64()),
                                   pa.array([total[p, k].tolist()], pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    width = books.shape[2]
    rows = (trees.select("points", "place", "nodes", "node_count").mapInArrow(add, "part int, entry int, n long, sums array<long>")
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))
            .collect())                                   # PARTS * ENTRIES rows at most
    new = books.copy()
    for r in rows:
        new[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return new


def encode(trees: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """``vec_id, label, code, error``: the nearest entry of each part as one hex digit pair."""
    kinds = {f.name: f.dataType.elementType for f in trees.schema.fields if isinstance(f.dataType, T.ArrayType)}
    schema = T.StructType([T.StructField("vec_id", kinds["ids"]), T.StructField("label", kinds["labels"]),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, forest in _trees(b, length):
                found = [nearest(t, books[p]) for p, t in enumerate(forest)]
                digits = np.stack([c for c, _ in found], 1).astype(np.uint8)
                code = [row.tobytes().hex() for row in digits]
                yield pa.record_batch([b.column("ids")[i].values, b.column("labels")[i].values, pa.array(code, pa.string()),
                                       pa.array(sum(e for _, e in found), pa.int64())], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, schema)


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all kept vectors (``vec_id, label, code, error``) and the final codebooks."""
    vectors = whole_vectors(table, id_col, vector_col, label_col)
    books = first_codebooks(vectors)
    length = PARTS * books.shape[2]
    trees = plant(vectors, length)
    if books.shape[1]:
        for _ in range(ROUNDS):
            books = lloyd_round(trees, books, length)
    return encode(trees, books, length), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels (nulls together).

    The sums are one row per label; each is repeated ``SALTS`` times, so that the rows of a very common label
    meet their sum in as many groups."""
    codes = stored(codes, "codes")
    sums = (codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    left = codes.withColumn("salt", F.pmod(F.hash("vec_id", "code"), F.lit(SALTS)))
    return left.join(sums, left["label"].eqNullSafe(sums["of"]) & (left["salt"] == sums["piece"])).drop("of", "piece", "salt")
