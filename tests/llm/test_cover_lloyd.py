"""Vector codes against plain Lloyd on whole numbers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from stopwise.llm import cover_lloyd as cl

SCHEMA = "vec_id long, embedding array<float>, label int, text string, v string"


def plain(rows):
    """vec_id, code, error, label_error, digest by direct comparison; rows of (id, vector, label)."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    if not first:
        return [], None
    d = len(first[0][1]) // 8
    books = [[list(r[1][p * d:(p + 1) * d]) for r in first] for p in range(8)]

    def near(p, x):
        e = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in books[p]]
        k = e.index(min(e))
        return k, e[k]

    for _ in range(6):
        new = [[list(c) for c in b] for b in books]
        for p in range(8):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[near(p, v[p * d:(p + 1) * d])[0]].append(v[p * d:(p + 1) * d])
            for k, xs in groups.items():
                new[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
        books = new
    out, by_label = [], defaultdict(int)
    for i, v, y in kept:
        found = [near(p, v[p * d:(p + 1) * d]) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for k, _ in found), sum(e for _, e in found), y))
        by_label[y] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, c, e, by_label[y]) for i, c, e, y in out], digest


def coded(spark, rows):
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    codes, books = cl.compress(df)
    got = [tuple(r) for r in cl.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()]
    return got, cl.codebook_digest(books)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("seed,dim,n", [(1, 16, 300), (2, 64, 150), (3, 8, 400)])
def test_equals_plain_lloyd(spark, seed, dim, n, monkeypatch):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dim)).astype(np.float32)
    x[rng.random(n) < 0.3] = x[0]                          # one very common vector
    x[rng.random(n) < 0.3] *= np.float32(0.001)            # a dense knot: many ties after the floor
    rows = [(int(i), x[k].tolist(), int(k % 3) if k % 5 else None) for k, i in enumerate(rng.permutation(n))]
    got, digest = coded(spark, rows)
    want, want_digest = plain(rows)
    assert digest == want_digest
    assert ordered(got) == ordered(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5] * 8
    rows = [(5, v, 1), (5, v, 1), (None, [0.25] * 8, None), (1, None, 1), (2, [None] + v[1:], 1), (3, [nan] + v[1:], 1), (4, [inf] + v[1:], 2),
            (9, [-0.0001] * 8, None)]
    got, digest = coded(spark, rows)
    want, want_digest = plain(rows)
    assert digest == want_digest and ordered(got) == ordered(want)
    assert coded(spark, [])[0] == []
    assert [r[0] for r in coded(spark, [(0, v, 1), (1, v * 2, 1), (2, [1.0] * 7, 1), (3, [], 1)])[0]] == [0]


def test_tree_invariants_and_whole_subtrees():
    rng = np.random.default_rng(7)
    centres = rng.integers(-4000, 4000, (12, 8))
    x = centres[rng.integers(0, 12, 4000)] + rng.integers(-40, 40, (4000, 8))
    t = cl.cover_tree(x)
    assert sorted(t.order.tolist()) == list(range(4000)) and (t.points == x[t.order]).all()
    for s, e, child, kids, r2 in t.nodes:
        d2 = ((t.points[s:e] - t.points[s]) ** 2).sum(1)
        assert d2.max() == r2
        if kids:
            below = t.nodes[child: child + kids]
            assert below[0, 0] == s and below[-1, 1] == e and (below[1:, 0] == below[:-1, 1]).all()
            assert (below[:, 4] * 4 <= r2).all()                                        # covering
            c = t.points[below[:, 0]]
            gap = ((c[:, None] - c[None]) ** 2).sum(2) + np.eye(len(c), dtype=np.int64) * r2
            assert (gap * 4 > r2).all()                                                 # separation
    book = centres.astype(np.int64)
    s, e, k, compared = cl.assign(t, book)
    assert (e - s).sum() == 4000 and compared == 0 and len(s) < 400                      # whole subtrees only
    code, error = cl.nearest(t, book)
    d2 = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (code == d2.argmin(1)).all() and (error == d2.min(1)).all()


def test_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        coded(spark, [(1, [1e9] * 8, 1)])
