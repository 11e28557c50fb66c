"""N-gram Jaccard join by universe partitioning and the pigeonhole principle.

A document's set holds its distinct k-word shingles (64-bit hashes). Documents with equal
sets are one class; classes are joined. Two sets with Jaccard similarity t = a / b or more
differ in at most H = floor((b - a) (n1 + n2) / (a + b)) elements.

*Segments by size band.* Set sizes fall into geometric bands. Band ``b`` cuts the universe
of hashes into ``m = H(b) + 1`` segments, H(b) being the largest difference of a pair whose
smaller set is in the band. A set signs under its own band and, if a smaller set of the band
below can still reach it, under that one too (a low row), so each pair meets under the smaller set's band;
two low rows need not meet, since their pair has a band of its own.

*Index.* For every segment the part of the set in it is signed, empty parts included. For
segment 0 the one-deletion neighbourhood is indexed too: parts that differ by one element
there still meet, so that segment counts two in the pigeonhole sum.

*Cost-based allocation.* A set of size n only needs allocations that add up to its own
H(n) + 1, under the band below, where its partners are no larger than that band's top, less; bands have an eighth more segments than that needs. All parts are indexed, and the
measured length of a part's posting list is its cost: a set leaves out the dearest parts it can
spare (empty parts, parts of passages that many documents share). Two rows of a signature make
a candidate only if one of them probes. Sets that still probe expensively (families of similar
sets that do not link) are signed once more with all one-deletion neighbourhoods, and
allocate 0, 1 or 2 to each segment by measured posting lengths.

*Exact verification.* Parity sketches of 64 and 256 bytes, then of half a byte to a byte per
element, rule out candidates that must differ in more than H elements. The others are resolved in rounds (``linking.resolve``); a pair links
when ``b * |A & B| >= a * |A u B|`` on the full sets.

Defined results: null or empty text, or one without words, has an empty set and links with
nothing; fewer than k words make the whole sequence one shingle; equal rows stay rows of
their own in one component; a component whose ids are all null has a null id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linking
from . import textkernel as tk
from .shared import concat_runs, release, ship_package, sliced, stored

GROWTH = 1.5
SKETCH_WORDS, FINE_WORDS = 8, 32
NO_ID = -(2**63)      # stands for a null id in joins


@dataclass(frozen=True)
class Threshold:
    """Similarity a / b as integers, so that every bound is exact."""
    a: int = 90
    b: int = 100

    def difference(self, total: int) -> int:
        """Largest symmetric difference of two linked sets with ``total`` elements together."""
        return (self.b - self.a) * total // (self.a + self.b)

    def partner(self, n: int) -> int:
        """Largest size a set can have to link with one of size n."""
        return n * self.b // self.a

    def linked(self, common: np.ndarray, union: np.ndarray) -> np.ndarray:
        return self.b * common >= self.a * union


def band_tops(t: Threshold, largest: int) -> np.ndarray:
    """Upper size of every band; bands grow by GROWTH, at least by one."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] * GROWTH)))
    return np.array(tops, np.int64)


def document_sets(c: tk.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, concatenated, and their counts."""
    starts, ends = c.runs(tk.NON_SPACE)
    words = c.per_text(starts)
    h = c.span_hashes(starts, ends, fold=True)
    first = np.concatenate([[0], np.cumsum(words)])
    grams = tk.shingles(h, k)
    parts: list[np.ndarray] = []
    for i in range(c.n):
        n = int(words[i])
        if n >= k:
            s = np.sort(grams[first[i]: first[i] + n - k + 1])
            parts.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            parts.append(tk.shingles(h[first[i]: first[i] + n], n) + np.uint64(n))
        else:
            parts.append(np.empty(0, np.uint64))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array([len(p) for p in parts], np.int64)


def _group_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    e = np.cumsum(counts)
    return s[e] - s[e - counts]


def fingerprints(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each set."""
    return (_group_sums(tk.mix(h + np.uint64(1)), n).view(np.int64), _group_sums(tk.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), n).view(np.int64))


def set_rows(docs: DataFrame, k: int, id_col: str, text_col: str, key_col: str) -> DataFrame:
    """(key, doc_id, n, k1, k2): the row's join key (NO_ID for null), the set's size and its fingerprint."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(key_col).cast("long"), F.lit(NO_ID)).alias("key"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column("text")):
                h, n = document_sets(c, k)
                k1, k2 = fingerprints(h, n)
                yield pa.record_batch({"key": b.column("key").slice(c.lo, c.n), "doc_id": b.column("doc_id").slice(c.lo, c.n),
                                       "n": pa.array(n), "k1": pa.array(k1), "k2": pa.array(k2)})

    return rows.mapInArrow(run, "key long, doc_id long, n long, k1 long, k2 long")


@dataclass
class Signatures:
    """Signature rows of a list of sets. ``deleted`` rows sign a part less one element."""
    who: np.ndarray        # number of the set
    sig: np.ndarray
    scheme: np.ndarray     # band
    segment: np.ndarray
    deleted: np.ndarray
    low: np.ndarray        # signed under the band below the set's own
    need: np.ndarray       # what the set's allocations must add up to
    spare: np.ndarray      # what they add up to beyond that if every segment probes


def sign(h: np.ndarray, n: np.ndarray, t: Threshold, every: bool = False) -> Signatures:
    """Sign concatenated sorted sets of sizes ``n``.

    ``every``: index the one-deletion neighbourhood of all segments, not of segment 0 only."""
    tops = band_tops(t, t.partner(int(n.max(initial=1))) + 1)
    least = np.array([t.difference(int(u) + t.partner(int(u))) + 1 for u in tops], np.int64)
    segments = np.where(least > 1, least + least // 8 + 1, 1)      # a few more than needed, so that some can be left out
    reach = np.array([t.partner(int(u)) for u in tops], np.int64)
    band = np.searchsorted(tops, n)
    below = (band > 0) & (n <= reach[np.maximum(band - 1, 0)])
    ends = np.cumsum(n)
    out: list[tuple] = []
    for scheme, who, low in ((band, np.flatnonzero(n > 0), False), (band - 1, np.flatnonzero(below & (n > 0)), True)):
        who = who[segments[scheme[who]] > 1]         # one segment: only equal sets link
        if not len(who):
            continue
        m, size, sch = segments[scheme[who]], n[who], scheme[who]
        partner = tops[sch] if low else size * t.b // t.a        # largest set it can link with under this band
        need = ((t.b - t.a) * (size + partner)) // (t.a + t.b) + 1
        x = h[concat_runs(ends[who] - size, size)]
        seg = ((x >> np.uint64(32)) * np.repeat(m, size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(m)])
        slot = np.repeat(base[:-1], size) + seg                                  # ascending: hashes are sorted within a set
        cards = np.bincount(slot, minlength=int(base[-1]))
        v = tk.mix(x + np.uint64(0x51ED270B))
        sums = _group_sums(v, cards)
        owner = np.repeat(np.arange(len(who)), m)
        number = np.arange(int(base[-1])) - base[owner]
        tag = tk.mix((sch[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
        # Segment 0 counts two, so all segments together are worth m + 1.
        spare = m + 1 - need
        out.append((who[owner], tk.mix(sums + tag), sch[owner], number, np.zeros(len(owner), bool), np.full(len(owner), low), need[owner], spare[owner]))
        at = np.arange(len(x)) if every else np.flatnonzero(seg == 0)
        sl = slot[at]
        out.append((who[owner[sl]], tk.mix(sums[sl] - v[at] + tag[sl]), sch[owner[sl]], number[sl], np.ones(len(at), bool), np.full(len(at), low), need[owner[sl]], spare[owner[sl]]))
    if not out:
        none = np.empty(0, np.int64)
        out = [(none, none.view(np.uint64), none, none, none.astype(bool), none.astype(bool), none, none)]
    return Signatures(*(np.concatenate([o[i] for o in out]) for i in range(8)))


def parity_sketches(sets: list[np.ndarray], words: int) -> np.ndarray:
    """One row of 64-bit ``words`` per set: bit j is the parity of the elements hashed to j.

    Two sketches differ in at most as many bits as their sets have elements apart, so a pair
    whose sketches differ in more than H bits cannot link: an exact filter."""
    bits = 64 * words
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    at = (tk.mix(flat + np.uint64(77)) % np.uint64(bits)).astype(np.int64)
    parity = (np.bincount(owner * bits + at, minlength=len(sets) * bits) & 1).astype(np.uint8).reshape(len(sets), bits)
    return np.packbits(parity, axis=1).view(np.int64)


def wide_sketch(x: np.ndarray) -> bytes:
    """Parity sketch of four to eight bits per element (a power of two, at least 512)."""
    bits = max(512, 1 << int(np.ceil(np.log2(4 * max(len(x), 1)))))
    at = (tk.mix(x + np.uint64(78)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def sketch_distance(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two wide sketches differ; the longer one is folded to the shorter's length first."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def near_classes(docs: DataFrame, k: int = 3, threshold: Threshold | None = None, id_col: str = "doc_id",
                 text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(key, doc_id, n_shingles, component, component_id, n_tree_links) of every row of ``docs``.

    ``key_col`` names a column that finds a row's text again (the id by default).
    ``component`` names the component (null without words), also where ids are null or repeated;
    ``component_id`` is the smallest doc_id reachable by links (its own without words);
    ``n_tree_links`` counts the verified links of the row's class that were tested to connect it,
    not all links it has."""
    t = threshold or Threshold()
    ship_package(docs.sparkSession)
    key_col = key_col or id_col
    sets = stored(set_rows(docs, k, id_col, text_col, key_col), "set-rows")
    # Classes of equal sets. A class is named by 64 bits of its 128-bit fingerprint; the few
    # classes whose name another class has too (n^2 / 2^65 of them) take the other 64 bits.
    classes = stored(sets.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("key").alias("least_key"), F.min("doc_id").alias("least")), "set-classes")
    clash = [r.k1 for r in classes.groupBy("k1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").collect()]
    named = classes.withColumn("node", F.when(F.col("k1").isin(clash), F.col("k2")).otherwise(F.col("k1")) if clash else F.col("k1"))
    texts = docs.select(F.coalesce(F.col(key_col).cast("long"), F.lit(NO_ID)).alias("key"), F.col(text_col).alias("text"))

    def names(h: np.ndarray, n: np.ndarray) -> np.ndarray:
        k1, k2 = fingerprints(h, n)
        return np.where(np.isin(k1, clash), k2, k1) if clash else k1

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = np.empty(0, np.int64)              # a task signs a class once, however many copies it reads
        for b in batches:
            for c in tk.chunks(b.column("text")):
                h, n = document_sets(c, k)
                node = names(h, n)
                _, at = np.unique(node, return_index=True)
                new = np.zeros(c.n, bool)
                new[at] = True
                new &= ~np.isin(node, signed) & (n > 0)
                signed = np.concatenate([signed, node[new]])
                h, n, node = h[np.repeat(new, n)], n[new], node[new]
                s = sign(h, n, t)
                # spare, low and segment 0 in one number
                meta = s.spare * 4 + s.low * 2 + (s.segment == 0)
                yield pa.record_batch({"sig": pa.array(s.sig.view(np.int64)), "node": pa.array(node[s.who]), "meta": pa.array(meta)})

    def sets_of(nodes: DataFrame, give, ddl: str) -> DataFrame:
        """One row per node from ``give(names, hashes, sizes)``, over the texts of one row of each class."""
        keys = stored(named.join(nodes, "node", "left_semi").select(F.col("least_key").alias("key")).distinct(), "keys")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for c in tk.chunks(b.column("text")):
                    h, n = document_sets(c, k)
                    if n.any():
                        n = n[n > 0]
                        yield pa.record_batch(give(names(h, n), h, n))
        out = stored(texts.join(linking.bounded(keys), "key", "left_semi").select("text").mapInArrow(run, ddl), "sets")
        release(keys)
        # Rows that repeat an id give a node twice, or another text's.
        counted = out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("node").alias("nodes")).first()
        if counted["rows"] != counted["nodes"]:
            out, twice = stored(out.dropDuplicates(["node"]), "sets"), out
            release(twice)
        return out

    def exact_sets(nodes: DataFrame) -> DataFrame:
        def give(node: np.ndarray, h: np.ndarray, n: np.ndarray) -> dict:
            cut = np.cumsum(n)
            return {"node": pa.array(node), "items": pa.array([h[e - m: e].tobytes() for e, m in zip(cut, n, strict=True)], pa.binary())}
        return sets_of(nodes, give, "node long, items binary")

    def traits(nodes: DataFrame) -> DataFrame:
        def give(node: np.ndarray, h: np.ndarray, n: np.ndarray) -> dict:
            cut = np.cumsum(n)
            sets = [h[e - m: e] for e, m in zip(cut, n, strict=True)]
            words, fine_words = parity_sketches(sets, SKETCH_WORDS), parity_sketches(sets, FINE_WORDS)
            return {"node": pa.array(node), "n": pa.array(n), **{f"p{i}": pa.array(words[:, i].copy()) for i in range(SKETCH_WORDS)},
                    **{f"q{i}": pa.array(fine_words[:, i].copy()) for i in range(FINE_WORDS)}, "wide": pa.array([wide_sketch(x) for x in sets], pa.binary())}
        return sets_of(nodes, give, "node long, n long, " + ", ".join(f"p{i} long" for i in range(SKETCH_WORDS)) + ", "
                       + ", ".join(f"q{i} long" for i in range(FINE_WORDS)) + ", wide binary")

    def apart(x: str, y: str, name: str, words: int) -> Column:
        """Whether the sketches differ in few enough bits."""
        bits = [F.bit_count(F.col(f"{x}.{name}{i}").bitwiseXOR(F.col(f"{y}.{name}{i}"))) for i in range(words)]
        return (t.a + t.b) * sum(bits[1:], bits[0]) <= (t.b - t.a) * (F.col(f"{x}.n") + F.col(f"{y}.n"))

    def fit(x: str, y: str) -> Column:
        n1, n2 = F.col(f"{x}.n"), F.col(f"{y}.n")
        return (F.least(n1, n2) * t.b >= F.greatest(n1, n2) * t.a) & apart(x, y, "p", SKETCH_WORDS)

    def fine(x: str, y: str) -> Column:
        return apart(x, y, "q", FINE_WORDS)

    def filtered(pairs: DataFrame, content: DataFrame, value: str, test) -> DataFrame:
        """The pairs whose two values pass ``test``."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = [test(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), m, n) for x, y, m, n in zip(
                    b.column("va"), b.column("vb"), b.column("na").to_pylist(), b.column("nb").to_pylist(), strict=True)]
                yield pa.record_batch({c: b.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")})
        size = F.col("n") if "n" in content.columns else (F.octet_length(value) / 8).cast("long")
        x = content.select(F.col("node").alias("a"), F.col(value).alias("va"), size.alias("na"))
        y = content.select(F.col("node").alias("b"), F.col(value).alias("vb"), size.alias("nb"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "va", "vb", "na", "nb").mapInArrow(run, "a long, b long")

    def verify(pairs: DataFrame, known: DataFrame) -> DataFrame:
        def near(x: np.ndarray, y: np.ndarray, m: int, n: int) -> bool:
            return sketch_distance(x, y) <= t.difference(m + n)

        def linked(x: np.ndarray, y: np.ndarray, m: int, n: int) -> bool:
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            return bool(t.linked(common, m + n - common))
        likely = stored(filtered(pairs, known, "wide", near), "likely")
        content = exact_sets(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        out = stored(filtered(likely, content, "items", linked), "links")
        release(likely, content)
        return out

    def full_index(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part in sliced(b, 512):
                    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("items")]
                    s = sign(np.concatenate(sets), np.array([len(x) for x in sets], np.int64), t, every=True)
                    node = part.column("node").to_numpy()[s.who]
                    yield pa.record_batch({"sig": pa.array(s.sig.view(np.int64)), "node": pa.array(node), "scheme": pa.array(s.scheme), "segment": pa.array(s.segment),
                                           "deleted": pa.array(s.deleted), "low": pa.array(s.low), "need": pa.array(s.need)})
        sets = exact_sets(nodes)
        return sets.mapInArrow(run, "sig long, node long, scheme long, segment long, deleted boolean, low boolean, need long"), sets

    links = linking.resolve(texts.select("text").mapInArrow(signatures, "sig long, node long, meta long"), traits, fit, verify, full_index, fine)
    label = linking.components(links)
    grouped = named.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_tree_links"))
    found = grouped.join(least, "component").join(degree, "node", "left").select("n", "k1", "k2", "component", "component_id", "n_tree_links")
    return (sets.join(found, ["n", "k1", "k2"], "left")
            .select("key", "doc_id", F.col("n").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_tree_links", F.lit(0)).cast("long").alias("n_tree_links")))
