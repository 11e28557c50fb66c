import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from stopwise.llm import linking, near_join, textkernel as tk

SCHEMA = "doc_id long, text string, n long"


def brute(rows, k, a, b):
    """{row index: (set size, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = tk_words(text)
        sets.append(frozenset(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            common = len(x & y)
            if x and y and b * common >= a * (len(x) + len(y) - common):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return sets, [min((d for d in groups[root(i)] if d is not None), default=None) for i in range(len(rows))]


def tk_words(text):
    out, cur = [], ""
    for ch in (text or ""):
        if ch in " \t\n\v\f\r":
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += ch.lower() if ch.isascii() else ch
    return out + [cur] if cur else out


def family(rng, size, copies, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            del w[rng.randrange(len(w))]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("plain_cost", [0, 64])
def test_components_equal_brute_force(spark, monkeypatch, plain_cost):
    monkeypatch.setattr(linking, "PLAIN_COST", plain_cost)
    if not plain_cost:
        monkeypatch.setattr(linking, "PLAIN_SIZES", 0)          # everything that is still apart goes through the full index
    rng = random.Random(plain_cost)
    texts = []
    for size, copies, edits in ((12, 15, 2), (40, 25, 3), (150, 30, 8), (600, 12, 30)):
        texts += family(rng, size, copies, edits)
    texts += ["", None, "  \n", "one", "ONE", "two words", "Two  WORDS", "é É", "é é"] + texts[:5]
    rows = [(i * 3 % 101 + i * 1000, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA)
    for k, a, b in ((3, 90, 100), (5, 80, 100)):
        got = {r.doc_id: r for r in near_join.near_classes(df, k, near_join.Threshold(a, b)).collect()}
        sets, want = brute(rows, k, a, b)
        assert len(got) == len(rows)
        for (i, _), s, c in zip(rows, sets, want, strict=True):
            assert (got[i].n_shingles, got[i].component_id) == (len(s), c)


@pytest.mark.parametrize("sizes", [0, 200])
def test_a_family_near_the_threshold(spark, monkeypatch, sizes):
    """300 sets of one family, most pairs just apart: no link is lost, whichever way they are searched, and neither the
    star rounds' pairs nor the index grow with the square of the family."""
    monkeypatch.setattr(linking, "PLAIN_SIZES", sizes)
    monkeypatch.setattr(linking, "PLAIN_COST", 0)
    made = {}
    original = linking.stored

    def counting(df, name, compression="snappy"):
        out = original(df, name, compression)
        made.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(linking, "stored", counting)
    rng = random.Random(11)
    texts = family(rng, 140, 299, 8)
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in near_join.near_classes(df).collect()}
    _, want = brute(rows, 3, 90, 100)
    assert [got[i] for i, _ in rows] == want and 20 < len(set(want)) < 280
    assert made["full-index"][0] < 300 * 140 * 4 if sizes == 0 else "full-index" not in made
    rounds = made["pairs"][:-1]
    assert all(n <= made["members"][0] for n in rounds) and len(rounds) <= linking.STAR_ROUNDS


def test_star_candidates_are_at_most_one_per_row(spark):
    members = spark.createDataFrame([(s, n, (n + s) % 3 > 0) for s in range(6) for n in range(40) if (n * 7 + s) % 4], "sig long, node long, probes boolean")
    label = spark.createDataFrame([(n, n % 5) for n in range(0, 40, 2)], "node long, component long")
    component = {n: n % 5 if n % 2 == 0 else n for n in range(40)}
    rows = {(r.sig, r.node): r.probes for r in members.collect()}
    seen = set()
    for salt in range(3):
        pairs = [(r.a, r.b) for r in linking.star_candidates(members, label, salt).collect()]
        assert 0 < len(pairs) <= len(rows) and len(set(pairs)) == len(pairs)
        for a, b in pairs:
            assert component[a] != component[b] and a < b
            assert any((s, a) in rows and (s, b) in rows and (rows[s, a] or rows[s, b]) for s in range(6))
        seen |= set(pairs)
    assert len(seen) > len(pairs)                                # another round tries others


def test_every_linked_pair_shares_a_probed_signature():
    rng = np.random.default_rng(3)
    t = near_join.Threshold(90, 100)
    for size in (9, 12, 19, 30, 77, 140, 500):
        x = np.sort(rng.integers(0, 2**64, size, dtype=np.uint64))
        for _ in range(30):
            lose = int(rng.integers(0, t.difference(2 * size) + 1))
            gain = int(rng.integers(0, t.difference(2 * size) + 1 - lose))
            y = np.sort(np.concatenate([rng.permutation(x)[lose:], rng.integers(0, 2**64, gain, dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if not t.linked(common, len(x) + len(y) - common) or (lose == gain == 0):
                continue
            s = near_join.sign(np.concatenate([x, y]), np.array([len(x), len(y)]), t)
            shared = np.intersect1d(s.sig[s.who == 0], s.sig[s.who == 1])
            # Whatever parts a set leaves out within its spare units, a shared one is left.
            for who in (0, 1):
                for scheme in np.unique(s.scheme):
                    mine = (s.who == who) & (s.scheme == scheme) & np.isin(s.sig, shared)
                    other = (s.who != who) & (s.scheme == scheme)
                    if not other.any() or not (s.who[s.scheme == scheme] == who).any():
                        continue
                    found = np.unique(s.segment[mine])
                    assert sum(2 if seg == 0 else 1 for seg in found) > s.spare[(s.who == who) & (s.scheme == scheme)][0]


def test_empty_table_and_nulls(spark):
    assert near_join.near_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (6, None), (6, None)], T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in near_join.near_classes(df).collect())
    assert got == [(-1, 2, 5), (-1, 2, 5), (5, 2, 5), (6, 0, 6), (6, 0, 6)]


def test_link_counts_are_named_for_the_tree(spark):
    df = spark.createDataFrame([(1, "a b c d", 0), (2, "x y z", 0)], SCHEMA)
    got = near_join.near_classes(df)
    assert got.columns == ["key", "doc_id", "n_shingles", "component", "component_id", "n_tree_links"]
    assert [r.n_tree_links for r in got.collect()] == [0, 0]


def test_hub_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 20), (30, 20), (40, 41)]
    got = {r.node: r.component for r in linking.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 30: 1, 7: 7, 8: 7, 9: 7, 40: 40, 41: 40}


def test_chunks_keep_texts_whole():
    texts = pa.array(["ab cd", None, "", "x" * 5000, "ef"])
    got = [(c.lo, c.hi, bytes(c.data).decode()) for c in tk.chunks(texts, 16)]
    assert [x[:2] for x in got] == [(0, 3), (3, 4), (4, 5)]
    assert "".join(x[2] for x in got) == "ab cd" + "x" * 5000 + "ef"


def test_low_rows_leave_out_what_they_can_spare_and_do_not_meet_each_other(spark):
    t = near_join.Threshold(80, 100)
    rng = np.random.default_rng(11)
    tops = near_join.band_tops(t, 2000)
    for top in (94, 711, 1066):
        assert top in tops
        n = t.partner(top)                                # the largest set that also signs under that band
        s = near_join.sign(np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)), np.array([n]), t)
        low = s.scheme == np.searchsorted(tops, top)
        assert (s.low == low).all() and low.any() and (s.spare[low] > 0).all()
        assert (s.need[low] == t.difference(n + top) + 1).all()
    rows = spark.createDataFrame([(1, 10, 2), (1, 11, 2), (2, 10, 2), (2, 11, 2), (2, 12, 0), (3, 10, 0), (3, 12, 0)], "sig long, node long, meta long")
    got = {(r.sig, r.node): r.others for r in linking.shared_signatures(rows).collect()}
    assert got == {(2, 10): 1, (2, 11): 1, (2, 12): 2, (3, 10): 1, (3, 12): 1}
