import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopwise.llm import line_dedup, linking, token_trie, toxicity, textkernel as tk
from stopwise.llm.queries import MODEL_FILE

from . import brute


# ---------------------------------------------------------------- fuzzy lines

def full_shingles(line):
    """Shingles at every position of the lower-cased line."""
    low = line.lower()
    return {low[i: i + line_dedup.SHINGLE] for i in range(max(len(low) - line_dedup.SHINGLE + 1, 1))}


def test_fuzzy_lines_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"word{i}" for i in range(300)]
    docs = []
    base = [" ".join(rng.choice(vocab) for _ in range(40)) for _ in range(12)]
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            w = rng.choice(base).split()
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.append(" ".join(w) if rng.random() < 0.7 else " ".join(rng.choice(vocab) for _ in range(20)))
        docs.append((i, "\n".join([*lines, "", "Common LINE here"])))
    docs += [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (904, "X")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, line_no int")
    got = {(r.doc_id, r.line_no): (r.kept, r.first_doc_id, r.first_line_no) for r in line_dedup.fuzzy_lines(df).collect()}
    occ = [(i, k, line) for i, t in docs for k, line in enumerate((t or "").split("\n")) if brute.words(line)]
    sets = [full_shingles(line) for _, _, line in occ]
    parent = list(range(len(occ)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(occ)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {(i, k): (root(x) == x, occ[root(x)][0], occ[root(x)][1]) for x, (i, k, _) in enumerate(occ)}
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) / len(want) > 0.99        # banding finds 0.999 of the pairs at the limit
    cut = {r.doc_id: r.text for r in line_dedup.without_copies(df, line_dedup.fuzzy_lines(df)).collect()}
    assert cut[900] is None and "Common LINE here" in cut[0] and "Common LINE here" not in cut[1]


def test_fuzzy_lines_equal_brute_force_on_every_position(spark):
    """Lines without spaces, long words and code points beyond 16 bits, compared beyond their first 12 code points."""
    rng = random.Random(8)
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    texts = ["https://example.com/a", "https://example.com/b", "2024-01-01T00:00:01", "2024-01-01T00:00:02", "\U0001F600" * 30 + "x", "\U0001F600" * 30 + "y"]
    for chars, n in (("0123456789abcdef", 64), ("的一是在不了有和人这中大为上个国我以要他時來用們", 150), ("ab\U00020000\U00020001 ", 90), ("abcdefgh", 400)):
        for _ in range(5):
            base = draw(chars, n)
            texts += [base, base[:12] + draw(chars, n - 12).rstrip() + "a", base[: n - 4] + draw("xyz", 4), base[: n // 2] + "Q" + base[n // 2:]]
    docs = [(i, t) for i, t in enumerate(texts)] + [(900, "short"), (901, "SHORT"), (902, "x" * 11), (903, "x" * 12), (904, "x" * 13)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.first_doc_id for r in line_dedup.fuzzy_lines(df).collect()}
    sets = [full_shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {i: docs[root(x)][0] for x, (i, _) in enumerate(docs)}
    assert (got[2], got[3]) == (2, 3)


def test_short_lines_at_the_threshold_share_a_band(spark):
    """2,000 pairs of 15-code-point lines with 4 shingles each, 4 of 5 common after one more code point."""
    rng = random.Random(3)
    pairs = []
    for _ in range(2000):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(16))
        pairs.append((line[:15], line))
    df = spark.createDataFrame([(i, x) for i, p in enumerate(pairs) for x in p], "pair long, line string")
    rows = line_dedup.band_rows(df).join(df.select("pair", line_dedup._node().alias("node")).distinct(), "node")
    found = rows.groupBy("pair", "sig").count().where("count > 1").select("pair").distinct().count()
    assert found >= 0.99 * len(pairs)            # 0.9992 are expected, 0.969 of dependent minima


def test_fuzzy_lines_never_shuffle_shingle_sets(spark, monkeypatch):
    plans = {}
    keep = line_dedup.stored

    def stored(df, name, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name, *rest)
    monkeypatch.setattr(line_dedup, "stored", stored)
    text = "a line of some words that two documents hold, but for its end"
    df = spark.createDataFrame([(1, text + " a"), (2, text + " b"), (3, "\U0001F600" * 20 + "x"), (4, "\U0001F600" * 20 + "y")], "doc_id long, text string")
    got = {r.doc_id: r.first_doc_id for r in line_dedup.fuzzy_lines(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}            # 3 and 4 have 1 of 3 shingles in common
    assert {"line-traits", "line-links"} <= plans.keys() and not any("collect_" in p for p in plans.values())


def test_hashing_a_long_line_is_linear(spark):
    """A line of 300,000 code points: a copy of its bytes per shingle would be 360 GB."""
    line = "".join(random.Random(4).choice("abcdefgh ") for _ in range(300_000))
    df = spark.createDataFrame([(line,), (line[:300],)], "line string").select(line_dedup._wide(F.col("line")).alias("wide")).cache()
    assert df.count() == 2
    began = time.monotonic()
    got = [r.n for r in df.select(F.size(line_dedup.shingle_hashes(F.col("wide"))).alias("n")).collect()]
    took = time.monotonic() - began
    df.unpersist()
    assert got == [300_000 - 11, 300 - 11] and took < 15


def test_minima_are_taken_without_checked_arithmetic(spark):
    plan = line_dedup.band_rows(spark.createDataFrame([("a line",)], "line string"))._jdf.queryExecution().optimizedPlan().toString()
    minima = next(x for x in plan.splitlines() if "min(" in x).partition("min(")[2]
    assert not any(x in minima for x in (" * ", " + ", " - ", "least("))
    values = [-2**63, -2**63 + 1, -5, -1, 0, 1, 7, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(x, y) for x in values for y in values], "x long, y long")
    for r in df.select("x", "y", line_dedup._less(F.col("x"), F.col("y")).alias("m"), line_dedup._turned(F.col("x"), 6).alias("t")).collect():
        u = r.x % 2**64
        assert r.m == min(r.x, r.y) and r.t % 2**64 == (u << 6 | u >> 58) % 2**64


def test_sketches_tell_long_lines_apart(spark, monkeypatch):
    """Twelve lines of 700 shingles that share 525 (similarity 0.6) meet in bands; no pair gets as far as the exact test."""
    rng = random.Random(6)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    made, keep, head = {}, linking.stored, draw(536)

    def stored(df, name, *rest):
        out = keep(df, name, *rest)
        made.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(linking, "stored", stored)
    df = spark.createDataFrame([(i, head + draw(175)) for i in range(12)], "doc_id long, text string")
    assert {r.doc_id: r.first_doc_id for r in line_dedup.fuzzy_lines(df).collect()} == {i: i for i in range(12)}
    assert made["members"][0] > 0 and sum(made["pairs"]) == 0


def test_no_lines(spark):
    assert line_dedup.fuzzy_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- token trie

def brute_tokens(word, vocab, longest):
    b = token_trie.MARK + word
    best = [(0.0, 0)]
    for d in range(1, len(b) + 1):
        cur = (-np.inf, 0)
        for k in range(1, min(d, longest) + 1):
            v = vocab.get(b[d - k: d], -np.inf)
            v = max(v, token_trie.UNKNOWN) if k == 1 else v
            if best[d - k][0] + v >= cur[0]:
                cur = (best[d - k][0] + v, best[d - k][1] + 1)
        best.append(cur)
    return best[-1][1]


def test_tokens_equal_brute_force(spark):
    pieces_ = token_trie.read_pieces(MODEL_FILE)
    vocab = token_trie.Vocabulary.of(pieces_)
    texts = ["the cat sat on the mat", "", None, "unbelievable, really!", "Größe éàü 語語 \x00\x01", "a" * 500, "x y\tz\n" * 50, "the cat sat on the mat"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_trie.token_counts(df, vocab).collect()}
    for i, t in enumerate(texts):
        w = [x.encode() for x in brute.words(t)]
        assert got[i] == (len(w), sum(brute_tokens(x, pieces_, vocab.longest) for x in w))


def test_small_vocabulary_prefers_high_scores():
    vocab = token_trie.Vocabulary.of({token_trie.MARK: -1.0, b"a": -3.0, b"b": -3.0, b"ab": -4.0, b"abc": -20.0, b"c": -2.0})
    for word, n in ((b"ab", 2), (b"abc", 3), (b"aab", 3), (b"z", 2)):
        buf = np.frombuffer(token_trie.MARK + word, np.uint8)
        assert token_trie.count_tokens(buf, np.array([0]), np.array([len(buf)]), vocab)[0] == n


# ---------------------------------------------------------------- toxicity

def toxic_sample(n=400, seed=2):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("na", "so", "ti", "ver", "um", "dek")]
    texts, y = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randrange(5, 150))]
        if i % 4 == 0:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["stupidoo", "vequ" + rng.choice(["ta", "eu", "aire", "on"])]))
        texts.append(" ".join(w))
        y.append(i % 4 == 0)
    return texts, np.array(y)


def test_network_learns_words_and_stems():
    texts, y = toxic_sample()
    net = toxicity.fit(pa.array(texts), y)
    more, want = toxic_sample(200, 9)
    more = [t.replace("vequon", "vequzzle") for t in more]       # an unseen word of a seen stem
    s = np.concatenate([net.score_chunk(c) for c in tk.chunks(pa.array(more))])
    assert ((s >= 0.7) == want).mean() > 0.95
    again = toxicity.fit(pa.array(texts), y)
    assert all((net.p[k] == again.p[k]).all() for k in net.p)


def test_gradient_is_numeric_gradient(monkeypatch):
    texts, y = toxic_sample(12)
    monkeypatch.setattr(toxicity, "F32", np.float64)
    net = toxicity.fit(pa.array(texts), y, rounds=1, epochs=1, min_steps=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    (c,) = tk.chunks(pa.array(texts), 1 << 20)
    w = toxicity.read_words(c)
    rows = np.arange(min(8, len(w.owner)))
    t, weight = y[w.owner[rows]].astype(float), np.ones(len(rows))
    _, g = toxicity.gradients(net, w, rows, t, weight)
    rng = np.random.default_rng(0)
    for name in net.p:
        flat = np.flatnonzero(g[name].ravel())
        for at in rng.choice(flat, min(4, len(flat)), replace=False) if len(flat) else []:
            loss = []
            for step in (1e-4, -1e-4):
                net.p[name].ravel()[at] += step
                loss.append(toxicity.gradients(net, w, rows, t, weight)[0])
                net.p[name].ravel()[at] -= step
            numeric = (loss[0] - loss[1]) / 2e-4
            assert abs(numeric - g[name].ravel()[at]) < 1e-3 * max(1, abs(numeric)), name


@pytest.mark.parametrize("n", [0, 1, 24, 31, 32, 33, 56, 57, 500])
def test_windows_cover_every_word(n):
    w = toxicity.read_words(next(tk.chunks(pa.array([" ".join(f"w{i}" for i in range(n))]))))
    assert len(np.unique(w.windows[w.windows < len(w.bucket)])) == n
    assert len(w.windows) == max(1, -(-(n - toxicity.WINDOW) // toxicity.STRIDE) + 1)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, "some words", 1.0), (3, "vequta " * 3000, 0.0)], "doc_id long, text string, score double")
    for rows in ([], [(1, 1), (2, 1)], [(2, 0), (3, None)], [(2, 0), (2, 0), (3, 1)]):
        net = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        got = toxicity.score(docs, net).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), net).count() == 0


def test_long_words_count_alike_and_fast():
    """A long word's own forward pass equals the trie's, ties included; a megabyte takes seconds."""
    import time

    from stopwise.llm.queries import MODEL_FILE
    vocab = token_trie.Vocabulary.of(token_trie.read_pieces(MODEL_FILE))
    rng = np.random.default_rng(8)
    for size, letters in ((1, b"ab"), (30, b"abcderi"), (700, b"etaoin shrdlu"), (3000, b"aaab"), (900, bytes(range(128, 256)))):
        word = np.frombuffer(token_trie.MARK + bytes(rng.choice(np.frombuffer(letters, np.uint8), size)), np.uint8)
        trie = token_trie.count_tokens(word, np.array([0]), np.array([len(word)]), vocab)[0]
        assert token_trie.count_long(word, vocab) == trie
    word = rng.choice(np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8), 1 << 20)
    began = time.perf_counter()
    assert token_trie.count_long(word, vocab) > 300_000
    assert time.perf_counter() - began < 30
