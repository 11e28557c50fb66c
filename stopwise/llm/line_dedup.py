"""Fuzzy line de-duplication by MinHash, with DataFrame operations only.

A line's set holds its character shingles: the ``SHINGLE`` code points that start at each
position, in lower case; a shorter line is one shingle. Lines that are equal, letter case
aside, are one node. Every node has ``BANDS * ROWS`` minima, each of one of ``HASHES`` 64-bit
hashes of its shingles, turned by another number of bits, so that other bits come first; nodes that agree on a band are candidates. With independent minima a pair
at similarity 0.8 agrees on at least one of 10 bands of 3 with probability 0.9992; these minima,
simulated on 40,000 random pairs per size (20,000 and 6,000 of the largest), gave 0.9994 for 4 of 5 common
shingles, 0.9992 for 8 of 10, 0.9994 for 16 of 20, 0.9994 for 40 of 50, 0.9995 for 80 of 100,
0.9990 for 200 of 250 and 0.9995 for 800 of 1000. Pairs that must differ in too
many shingles by their parity sketches (two sketches differ in at most as many bits as the
sets have elements apart) are left out inside the candidate joins; the others are verified by exact Jaccard similarity of the shingle sets, and verified links form components
(``linking``). Of each component the first occurrence is kept: smallest doc_id, then row,
then line number.

Explode and one aggregation give the minima: rows of a line meet map-side, so one row per
distinct line and task is shuffled, and a line that a third of all documents hold costs no
more than any other.

Defined results: null and empty texts and lines without a word give no rows; equal rows are
copies of each other, the later rows' lines go; a null id sorts first; extra columns are
ignored. Nodes are 64-bit hashes: of n distinct lines about n^2 / 2^65 pairs share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linking
from .shared import release, stored

SHINGLE = 12
BANDS, ROWS = 10, 3
HASHES = 3
SKETCH_WORDS = 16        # a power of two; 256 bits told sets of some 300 elements apart badly, 1,024 do up to some 2,000
WORD = r"[^\x20\x09-\x0D]"
# Code points have four bytes in UTF-32, so a shingle is cut out without a walk through the text.
POINT = 4
# A row stands for so many shingle starts, a power of two: their least hashes are taken before a line's minima are touched.
STEP = 4


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, line_no, line) of every line with a word."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    cut = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return cut.where(F.col("raw").rlike(WORD)).select("doc_id", "row", "line_no", F.lower("raw").alias("line"))


def _node() -> Column:
    return F.xxhash64("line")


def _wide(line: Column) -> Column:
    return F.encode(line, "UTF-32")


def _starts(wide: Column) -> Column:
    """How many shingles a line in UTF-32 has, repeats included."""
    return F.greatest((F.octet_length(wide) / POINT).cast("int") - (SHINGLE - 1), F.lit(1))


def _shingle(wide: Column, at: Column) -> Column:
    """The hash of the shingle that starts at code point ``at``, from 0."""
    return F.xxhash64(F.substring(wide, at * POINT + 1, F.lit(SHINGLE * POINT)))


def shingle_hashes(wide: Column) -> Column:
    """The hashes of all shingles of a line in UTF-32, repeats included. A lambda copies a column's bytes each time it
    reads them; those of its own variable, here the only element of an array, it does not."""
    return F.transform(F.array(wide), lambda w: F.transform(F.sequence(F.lit(0), _starts(w) - 1), lambda at: _shingle(w, at)))[0]


def _turned(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def _less(x: Column, y: Column) -> Column:
    """The smaller of two longs without a branch, which random values would mispredict, and without checked arithmetic."""
    x_first = F.shiftright(F.shiftleft((x < y).cast("long"), 63), 63)
    return y.bitwiseXOR(x.bitwiseXOR(y).bitwiseAND(x_first))


def band_rows(lines: DataFrame) -> DataFrame:
    """(sig, node, meta): one row per band of every distinct line."""
    wide = lines.select(_node().alias("node"), _wide(F.col("line")).alias("wide")).withColumn("last", _starts(F.col("wide")) - 1)
    steps = wide.select("node", "wide", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("at"))
    # The last step's surplus starts repeat the last shingle.
    first = steps.select("node", *[_shingle(F.col("wide"), F.least(F.col("at") + i, F.col("last"))).alias(f"h0_{i}") for i in range(STEP)])
    one = first.select("*", *[F.xxhash64(F.lit(k), F.col(f"h0_{i}")).alias(f"h{k}_{i}") for k in range(1, HASHES) for i in range(STEP)])
    turns = BANDS * ROWS // HASHES

    def drawn(j: int) -> Column:
        values = [_turned(F.col(f"h{j // turns}_{i}"), j % turns * 64 // turns) for i in range(STEP)]
        while len(values) > 1:
            values = [_less(x, y) for x, y in zip(values[::2], values[1::2], strict=True)]
        return values[0]
    minima = one.groupBy("node").agg(*[F.min(drawn(j)).alias(f"m{j}") for j in range(BANDS * ROWS)])
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)])
    return minima.select(F.explode(bands).alias("sig"), "node", F.lit(0).cast("long").alias("meta"))


def line_components(lines: DataFrame, least: tuple[int, int] = (8, 10)) -> DataFrame:
    """(node, component) of the nodes that are linked to another: Jaccard similarity a / b or more."""
    a, b = least

    def verify(pairs: DataFrame, known: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return known.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("line").alias(f"line_{name}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect(*[shingle_hashes(_wide(F.col(f"line_{x}").cast("string"))) for x in "ab"]))
        # common / (total - common) >= a / b
        return stored(both.where((a + b) * common >= a * (F.col("na") + F.col("nb"))).select("a", "b"), "line-links")

    def traits(nodes: DataFrame) -> DataFrame:
        # The set's size, its parity sketch (bit j is the parity of the hashes that fall on j) and the line, which is cut into shingles where it is read.
        ids = stored(nodes, "line-ids")
        chosen = stored(lines.withColumn("node", _node()).join(linking.bounded(ids), "node", "left_semi").groupBy("node")
                        .agg(F.max("line").alias("line")).select("node", F.col("line").cast("binary").alias("line")), "line-texts")
        release(ids)
        one = chosen.select("node", F.explode(F.array_distinct(shingle_hashes(_wide(F.col("line").cast("string"))))).alias("h"))
        word = lambda w: F.expr(f"bit_xor(if(shiftright(h, 6) & {SKETCH_WORDS - 1} = {w}, shiftleft(1L, cast(h & 63 as int)), 0L))")
        sketch = one.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[word(w).alias(f"p{w}") for w in range(SKETCH_WORDS)])
        out = stored(sketch.join(chosen, "node"), "line-traits")
        release(chosen)
        return out

    def fit(x: str, y: str) -> Column:
        n1, n2 = F.col(f"{x}.n"), F.col(f"{y}.n")
        bits = [F.bit_count(F.col(f"{x}.p{w}").bitwiseXOR(F.col(f"{y}.p{w}"))) for w in range(SKETCH_WORDS)]
        return (b * F.least(n1, n2) >= a * F.greatest(n1, n2)) & ((a + b) * sum(bits[1:], bits[0]) <= (b - a) * (n1 + n2))

    links = linking.resolve(band_rows(lines), traits, fit, verify)
    return linking.components(links)


def fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: tuple[int, int] = (8, 10)) -> DataFrame:
    """(doc_id, line_no, kept, first_doc_id, first_line_no) of every line with a word."""
    lines = _lines(docs, id_col, text_col)
    found = stored(lines.select("doc_id", "row", "line_no", _node().alias("node")), "lines")
    label = line_components(lines, least)
    place = F.struct("doc_id", "row", "line_no")
    per_node = found.groupBy("node").agg(F.min(place).alias("first")).join(label, "node", "left").withColumn("c", F.coalesce("component", "node"))
    first = per_node.groupBy("c").agg(F.min("first").alias("first"))
    named = per_node.select("node", "c").join(first, "c").select("node", "first")
    return (found.join(named, "node").select("doc_id", "line_no", (place == F.col("first")).alias("kept"),
                                             F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no")))


def without_copies(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``decisions`` drops taken out of the text (rows with distinct ids)."""
    gone = decisions.where("not kept").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("line_no").alias("__gone"))
    cut = F.split(F.col(text_col), "\n")
    left = F.array_join(F.filter(cut, lambda x, i: ~F.array_contains("__gone", i)), "\n")
    return (docs.join(gone, docs[id_col] == F.col("__id"), "left").withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(left))
            .drop("__id", "__gone"))
