"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` cuts the documents into segments and stores, for each segment, one
inverted file: its distinct terms (64-bit hashes, sorted), and for each term the sorted
list of its token positions. A segment holds about ``SEGMENT_BYTES`` of text (a longer
text is a segment of its own), so a row of the stored table is bounded and every task
works on its own segments only. Between two documents one position is left free, so a
phrase never runs across documents.

``phrase_matches`` and ``proximity_matches`` look test phrases up in every segment. For
each phrase the term with the shortest posting list in the segment comes first; its
list, shifted by the term's offset in the phrase, gives the candidate starts, and the
lists of the other terms, rarest first, are intersected with them. A phrase with a term
that the segment lacks costs nothing more.

Test items travel in blocks of at most ``block_words`` words, so what reaches a task at
once does not grow with the number of items; every block meets every segment.

Defined results: a null or empty text has no tokens (it is in the document table with 0
words and never hit); an item without words has no window; items without an id hit like
others and count together as one unnamed item of ``n_items``, not of ``items``; equal rows are each judged
on their own; extra columns of either input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import concat_runs, ship_package, stored

WINDOW_WORDS = 13
SEGMENT_BYTES = 2 << 20
BLOCK_WORDS = 200_000

INDEX_DDL = ("segment long, doc_ids array<long>, doc_rows array<long>, doc_starts array<int>, doc_words array<int>, terms binary, "
             "counts binary, gaps binary")


def _words(texts: pa.Array) -> Iterator[tuple[tk.Chunk, np.ndarray, np.ndarray]]:
    for c in tk.chunks(texts, SEGMENT_BYTES):
        starts, ends = c.runs(tk.ALNUM)
        yield c, c.span_hashes(starts, ends, fold=True), c.per_text(starts)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the inverted files of ``docs`` in the shared folder, one row per segment."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rids = b.column("doc_id"), b.column("row").to_numpy()
            for c, h, counts in _words(b.column("text")):
                doc_starts = np.cumsum(counts + 1) - (counts + 1)
                at = np.arange(len(h)) + np.repeat(np.arange(c.n), counts)
                order = np.argsort(h, kind="stable")
                s = h[order]
                heads = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
                # Delta-coded positions: the first of each list is absolute.
                pos = at[order]
                gaps = np.diff(pos, prepend=0)
                gaps[heads] = pos[heads]
                one = lambda v, kind: pa.array([v], kind)
                yield pa.record_batch({
                    "segment": one(int(rids[c.lo]), pa.int64()), "doc_ids": one(ids.slice(c.lo, c.n).to_pylist(), pa.list_(pa.int64())),
                    "doc_rows": one(rids[c.lo: c.hi], pa.list_(pa.int64())), "doc_starts": one(doc_starts.astype(np.int32), pa.list_(pa.int32())),
                    "doc_words": one(counts.astype(np.int32), pa.list_(pa.int32())), "terms": one(s[heads].tobytes(), pa.binary()),
                    "counts": one(np.diff(np.append(heads, len(s))).astype(np.int32).tobytes(), pa.binary()),
                    "gaps": one(gaps.astype(np.int32).tobytes(), pa.binary())})

    return stored(rows.mapInArrow(segments, INDEX_DDL), "phrase-index")


class Segment:
    """One inverted file: terms, list borders and positions."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        gaps = np.frombuffer(row["gaps"], np.int32).astype(np.int64)
        self.counts = counts
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        total = np.cumsum(gaps)
        base = total[self.first] - gaps[self.first] if len(counts) else np.empty(0, np.int64)
        self.pos = total - np.repeat(base, counts)
        # (term number, position) as one sorted key: membership is a binary search.
        self.key = (np.repeat(np.arange(len(counts), dtype=np.int64), counts) << 32) | self.pos
        self.doc_starts = np.array(row["doc_starts"], np.int64)
        self.doc_words = np.array(row["doc_words"], np.int64)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Term number of each hash, -1 where the segment lacks the term."""
        i = np.minimum(np.searchsorted(self.terms, h), max(len(self.terms) - 1, 0))
        return np.where(self.terms[i] == h, i, -1) if len(self.terms) else np.full(len(h), -1)

    def holds(self, term: np.ndarray, pos: np.ndarray) -> np.ndarray:
        want = (term << 32) | pos
        i = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return (self.key[i] == want) & (pos >= 0)

    def nearest(self, term: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Distance from ``pos`` to the nearest posting of the term."""
        want = (term << 32) | pos
        i = np.searchsorted(self.key, want)
        far = np.int64(1) << 40
        out = np.full(len(pos), far)
        for j in (np.minimum(i, len(self.key) - 1), np.maximum(i - 1, 0)):
            same = (self.key[j] >> 32) == term
            out = np.where(same, np.minimum(out, np.abs((self.key[j] & 0xFFFFFFFF) - pos)), out)
        return out

    def document(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, pos, "right") - 1


class Phrases:
    """The windows of a block of test items, as rows of term hashes."""

    def __init__(self, items: list[int], words: list[np.ndarray], width: int | None):
        # Per window: its item, its length and the index of its first word in ``h``.
        self.item_ids = items
        self.h = np.concatenate(words) if words else np.empty(0, np.uint64)
        n = np.array([len(w) for w in words], np.int64)
        base = np.concatenate([[0], np.cumsum(n)])[:-1] if len(n) else n
        span = n if width is None else np.minimum(n, width)
        wins = np.where(n > 0, n - span + 1, 0)
        self.item = np.repeat(np.arange(len(n)), wins)
        self.length = np.repeat(span, wins)
        self.first = concat_runs(base, wins)


def _candidates(seg: Segment, ph: Phrases) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Windows whose terms all exist, their terms from the rarest on, and anchor positions."""
    number = seg.number(ph.h)
    lacking = np.concatenate([[0], np.cumsum(number < 0)])
    alive = np.flatnonzero(lacking[ph.first + ph.length] == lacking[ph.first])
    if not len(alive):
        return alive, [], [], alive
    first, length = ph.first[alive], ph.length[alive]
    longest = int(length.max())
    offs = np.broadcast_to(np.arange(longest), (len(alive), longest))
    inside = offs < length[:, None]
    terms = number[np.minimum(first[:, None] + offs, len(ph.h) - 1)]
    cost = np.where(inside, seg.counts[np.maximum(terms, 0)], np.iinfo(np.int64).max)
    rank = np.argsort(cost, axis=1, kind="stable")
    terms, offs = np.take_along_axis(terms, rank, 1), rank
    return alive, [terms[:, k] for k in range(longest)], [offs[:, k] for k in range(longest)], length


def find_phrases(seg: Segment, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, start position) of every exact occurrence."""
    alive, terms, offs, length = _candidates(seg, ph)
    if not len(alive):
        return alive, alive
    n = seg.counts[terms[0]]
    win = np.repeat(np.arange(len(alive)), n)
    start = seg.pos[concat_runs(seg.first[terms[0]], n)] - offs[0][win]
    for k in range(1, len(terms)):
        more = k < length[win]
        ok = ~more
        ok[more] = seg.holds(terms[k][win[more]], start[more] + offs[k][win[more]])
        win, start = win[ok], start[ok]
    return alive[win], start


def find_near(seg: Segment, ph: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position of its rarest term) where every other term lies within ``slop`` words in the same document."""
    alive, terms, _, length = _candidates(seg, ph)
    if not len(alive):
        return alive, alive
    n = seg.counts[terms[0]]
    win, pos = np.repeat(np.arange(len(alive)), n), seg.pos[concat_runs(seg.first[terms[0]], n)]
    for k in range(1, len(terms)):
        more = k < length[win]
        ok = ~more
        if more.any():
            t, p = terms[k][win[more]], pos[more]
            doc = seg.document(p)
            lo, hi = np.maximum(seg.doc_starts[doc], p - slop), np.minimum(seg.doc_starts[doc] + seg.doc_words[doc] - 1, p + slop)
            # A posting of the term in [lo, hi].
            i = np.searchsorted(seg.key, (t << 32) | lo)
            ok[more] = (i < len(seg.key)) & (seg.key[np.minimum(i, len(seg.key) - 1)] <= ((t << 32) | hi))
        win, pos = win[ok], pos[ok]
    return alive[win], pos


def test_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pack items as hashed words into blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    ship_package(items.sparkSession)
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    schema = pa.schema([("items", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        words: list = []

        def block() -> pa.RecordBatch:
            return pa.record_batch([pa.array([ids], schema[0].type), pa.array([[len(w) for w in words]], schema[1].type),
                                    pa.array([np.concatenate(words).tobytes()], schema[2].type)], schema=schema)
        for b in batches:
            for c, h, counts in _words(b.column("text")):
                cut = np.concatenate([[0], np.cumsum(counts)])
                for i in range(c.n):
                    if not counts[i]:
                        continue
                    if ids and sum(map(len, words)) + counts[i] > block_words:
                        yield block()
                        ids, words = [], []
                    ids.append(b.column("item_id")[c.lo + i].as_py())
                    words.append(h[cut[i]: cut[i + 1]])
        if ids:
            yield block()

    return rows.mapInArrow(packed, "items array<string>, sizes array<int>, words binary")


def _lookup(index: DataFrame, blocks: DataFrame, width: int | None, find) -> DataFrame:
    """One row per (document row, item, covered span) of each block in each segment."""
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "test-blocks")
    numbers = [r.block for r in blocks.select("block").collect()]    # one number per block_words words of the test set
    # Every segment meets every block: a stated query set in bounded blocks, the block number being the join key.
    per_segment = index.withColumn("block", F.explode(F.lit(numbers) if numbers else F.array().cast("array<bigint>")))
    pairs = per_segment.join(blocks, "block").select(*index.columns, "items", "sizes", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                seg = Segment(row)
                sizes = np.array(row["sizes"], np.int64)
                ph = Phrases(row["items"], np.split(np.frombuffer(row["words"], np.uint64), np.cumsum(sizes)[:-1]), width)
                win, start, length = find(seg, ph)
                item, end = ph.item[win], start + length
                # Occurrences of one item that touch or overlap become one span.
                order = np.lexsort((start, item))
                item, start, end = item[order], start[order], end[order]
                if len(item):
                    doc = seg.document(start)
                    new = np.concatenate([[True], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])])
                    heads = np.flatnonzero(new)
                    end = np.maximum.reduceat(end, heads)
                    item, start, doc = item[heads], start[heads], doc[heads]
                    base = seg.doc_starts[doc]
                    yield pa.record_batch({
                        "row": pa.array(np.array(row["doc_rows"], np.int64)[doc]), "doc_id": pa.array(row["doc_ids"], pa.int64()).take(pa.array(doc)),
                        "item_id": pa.array([row["items"][i] for i in item], pa.string()),
                        "first_word": pa.array((start - base).astype(np.int64)), "end_word": pa.array((end - base).astype(np.int64))})

    return pairs.mapInArrow(run, "row long, doc_id long, item_id string, first_word long, end_word long")


def phrase_matches(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                   width: int | None = WINDOW_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Word spans of documents that equal windows of ``width`` words of an item.

    ``width=None`` looks for whole items; an item shorter than ``width`` is one window."""
    def find(seg: Segment, ph: Phrases):
        win, start = find_phrases(seg, ph)
        return win, start, ph.length[win]
    return _lookup(index, test_blocks(items, id_col, text_col, block_words), width, find)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int, id_col: str = "item_id", text_col: str = "text",
                      width: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Places where all terms of a window lie within ``slop`` words of its rarest term (that term's position is the span)."""
    def find(seg: Segment, ph: Phrases):
        win, pos = find_near(seg, ph, slop)
        return win, pos, np.ones(len(pos), np.int64)
    return _lookup(index, test_blocks(items, id_col, text_col, block_words), width, find)


def contamination(index: DataFrame, matches: DataFrame) -> DataFrame:
    """Per document row: n_words, n_hit (words inside any match), items (distinct, sorted), n_items (one more if an item without an id matches), contaminated."""
    docs = index.select(F.explode(F.arrays_zip("doc_rows", "doc_ids", "doc_words")).alias("d")).select(
        F.col("d.doc_rows").alias("row"), F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").cast("long").alias("n_words"))
    matches = stored(matches, "phrase-matches")
    by_row = Window.partitionBy("row").orderBy("first_word", "end_word").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select("row", "first_word", "end_word").distinct()
    hits = (spans.withColumn("seen", F.coalesce(F.max("end_word").over(by_row), F.lit(0)))
            .groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end_word") - F.greatest("first_word", "seen"))).alias("n_hit")))
    named = matches.groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max(F.col("item_id").isNull().cast("long")).alias("unnamed"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return (docs.join(hits.join(named, "row"), "row", "left")
            .select("row", "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    (F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("long") + F.coalesce("unnamed", F.lit(0).cast("long"))).alias("n_items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))
