"""Whole operators against plain versions written row by row: quality scores, rule verdicts, the network's forward pass, the k-d tree."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from stopwise.llm import kd_shards, quality, toxicity, weak_rules
from stopwise.llm import textkernel as tk
from stopwise.llm.docstats import chunk_stats

SCHEMA = "doc_id long, text string, lang string, source string, node string"


def corpus(rng, n):
    good, junk = "the river runs past the old mill and nobody knows why it turns".split(), ["BUY", "now!!!", "$$$", "###", "1234", "click", "click", "%%%"]
    out, marks = [], []
    for i in range(n):
        bad = rng.random() < 0.4
        words = [rng.choice(junk if bad and rng.random() < 0.8 else good) for _ in range(rng.randint(5, 80))]
        out.append(rng.choice([" ", "\n"]).join(words) + ("." if not bad else ""))
        marks.append(0 if bad else 1)
    return out, marks


def test_quality_scores_equal_the_plain_discriminant(spark):
    """Class moments row by row, explicit inverses and determinants instead of moments in Spark and Cholesky factors."""
    rng = random.Random(3)
    texts, marks = corpus(rng, 240)
    texts += [None, ""]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)
    labelled = spark.createDataFrame([(i, m) for i, m in enumerate(marks) if i % 5], "doc_id long, quality int")
    feats = quality.featurize(df)
    got = {r.doc_id: r.score for r in quality.score(feats, quality.train(feats, labelled)).collect()}
    x = quality.vectors(chunk_stats(next(tk.chunks(pa.array([t or "" for t in texts])))))
    d = x.shape[1]
    rows = {k: [x[i] for i, m in enumerate(marks) if m == k and i % 5] for k in (0, 1)}
    total = len(rows[0]) + len(rows[1])
    mean = {k: sum(v) / len(v) for k, v in rows.items()}
    cov = {k: sum(np.outer(r - mean[k], r - mean[k]) for r in v) / len(v) for k, v in rows.items()}
    pooled = sum(len(rows[k]) / total * cov[k] for k in rows)
    log = {}
    for k in (0, 1):
        n = len(rows[k])
        share = 0.8 * n / (n + d)
        c = share * cov[k] + (1 - share) * pooled + 0.02 * np.trace(pooled) / d * np.eye(d)
        inverse, (_, size) = np.linalg.inv(c), np.linalg.slogdet(c)
        log[k] = [math.log(n / total) - size / 2 - (r - mean[k]) @ inverse @ (r - mean[k]) / 2 for r in x]
    want = [1 / (1 + math.exp(-max(-500, min(500, (a - b) / quality.TEMPERATURE)))) for a, b in zip(log[1], log[0], strict=True)]
    assert len(got) == len(texts) and max(abs(got[i] - w) for i, w in enumerate(want)) < 1e-8


def test_verdicts_equal_expectation_maximisation_over_rows(spark):
    """EM over every document's own votes, in plain Python, gives the verdicts that pattern counts give."""
    rng = random.Random(4)
    texts, _ = corpus(rng, 150)
    texts += ["", None, texts[0]]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)
    stats = weak_rules.statistics(df)
    names = [f"vote_{r.name}" for r in weak_rules.RULES]
    votes = {r.doc_id: [r[n] != 0 for n in names] for r in weak_rules.votes(stats).collect()}
    says = [r.says for r in weak_rules.RULES]
    ids = sorted(votes)
    good = {i: 0.05 if any(v and s == -1 for v, s in zip(votes[i], says, strict=True)) else 0.95 for i in ids}
    for _ in range(200):
        prior = (sum(good.values()) + 1) / (len(ids) + 2)
        rate = []
        for j in range(len(names)):
            w_good, w_bad = sum(good.values()), sum(1 - g for g in good.values())
            rate.append(((sum(1 - good[i] for i in ids if votes[i][j]) + 1) / (w_bad + 2), (sum(good[i] for i in ids if votes[i][j]) + 1) / (w_good + 2)))
        new = {}
        for i in ids:
            odds = math.log(prior / (1 - prior))
            for v, (b, g) in zip(votes[i], rate, strict=True):
                odds += math.log(g / b) if v else math.log((1 - g) / (1 - b))
            new[i] = 1 / (1 + math.exp(-odds))
        moved = max(abs(new[i] - good[i]) for i in ids)
        good = new
        if moved < 1e-9:
            break
    got = {r.doc_id: (r.p_good, r.verdict) for r in weak_rules.judge(stats).collect()}
    assert all(abs(got[i][0] - good[i]) < 1e-6 for i in ids)
    assert all(got[i][1] == (good[i] >= 0.5) for i in ids if abs(good[i] - 0.5) > 1e-6)
    assert 20 < sum(v for _, v in got.values()) < len(ids)


def test_network_equals_a_plain_forward_pass():
    """Gates, both directions, attention and overlapping windows, one word and one number at a time."""
    rng = np.random.default_rng(6)
    net = toxicity.new_network(np.random.default_rng(1)) if hasattr(toxicity, "new_network") else None
    if net is None:
        h, w, c = toxicity.HIDDEN, toxicity.WORD_DIM, toxicity.CHAR_DIM
        dim = w + c + 3
        shape = {"word": (1 << toxicity.WORD_BITS, w), "char": (1 << toxicity.CHAR_BITS, c), "Wf": (dim, 3 * h), "bf": (3 * h,), "Wb": (dim, 3 * h), "bb": (3 * h,), "Uf": (h, 3 * h),
                 "Ub": (h, 3 * h), "Wa": (2 * h, h), "ba": (h,), "va": (h,), "wo": (2 * h,), "bo": (1,)}
        net = toxicity.Network({k: rng.normal(0, 0.5, s).astype(np.float32) for k, s in shape.items()},
                               rng.normal(0, 1, 1 << toxicity.WORD_BITS).astype(np.float32), rng.normal(0, 1, 1 << toxicity.CHAR_BITS).astype(np.float32), 0.7, -0.2)
    texts = ["", "one", "a bb ccc dddd, eeeee", " ".join(f"w{i % 17}" for i in range(90)), "é è " * 20]
    got = net.score_chunk(next(tk.chunks(pa.array(texts))))
    p, H = net.p, toxicity.HIDDEN

    def sigmoid(v):
        return 1 / (1 + math.exp(-v))

    for t, score in zip(texts, got, strict=True):
        words = toxicity.read_words(next(tk.chunks(pa.array([t]))))
        best = -math.inf
        for window in words.windows:
            xs = []
            for i in window:
                if i == len(words.bucket):
                    continue
                grams = words.grams[words.gram_first[i]: words.gram_first[i] + words.gram_count[i]]
                odds = [float(net.char_odds[g]) for g in grams]
                xs.append([*map(float, p["word"][words.bucket[i]]), *(sum(float(p["char"][g][k]) for g in grams) / len(grams) for k in range(toxicity.CHAR_DIM)),
                           float(net.word_odds[words.bucket[i]]), max(odds), sum(odds) / len(odds)])
            states = {}
            for way, seq in (("f", xs), ("b", xs[::-1])):
                h, out = [0.0] * H, []
                for x in seq:
                    a = [sum(x[i] * float(p[f"W{way}"][i][k]) for i in range(len(x))) + float(p[f"b{way}"][k]) for k in range(3 * H)]
                    u = p[f"U{way}"]
                    z = [sigmoid(a[k] + sum(h[i] * float(u[i][k]) for i in range(H))) for k in range(H)]
                    r = [sigmoid(a[H + k] + sum(h[i] * float(u[i][H + k]) for i in range(H))) for k in range(H)]
                    cand = [math.tanh(a[2 * H + k] + sum(r[i] * h[i] * float(u[i][2 * H + k]) for i in range(H))) for k in range(H)]
                    h = [h[k] + z[k] * (cand[k] - h[k]) for k in range(H)]
                    out.append(h)
                states[way] = out if way == "f" else out[::-1]
            if xs:
                both = [f + b for f, b in zip(states["f"], states["b"], strict=True)]
                s = [sum(math.tanh(sum(v[i] * float(p["Wa"][i][k]) for i in range(2 * H)) + float(p["ba"][k])) * float(p["va"][k]) for k in range(H)) for v in both]
                e = [math.exp(v - max(s)) for v in s]
                pooled = [sum(w * v[k] for w, v in zip(e, both, strict=True)) / sum(e) for k in range(2 * H)]
            else:
                pooled = [0.0] * (2 * H)                       # nothing to attend to: every state is zero
            best = max(best, sum(v * float(o) for v, o in zip(pooled, p["wo"], strict=True)) + float(p["bo"][0]))
        assert abs(score - sigmoid(net.slope * best + net.shift)) < 2e-4


@pytest.mark.parametrize("seed,shards", [(1, 16), (2, 5)])
def test_shards_equal_a_plain_tree(spark, seed, shards):
    """The recursion with sorted lists instead of histogram passes."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, rng.randint(0, 10**6)]), "x" * int(rng.paretovariate(1) * 20 % 3000), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c"]), None) for _ in range(300)]
    rows += [(7, "same", "en", "a", None)] * 80
    slim = kd_shards.slim(spark.createDataFrame(rows, SCHEMA))
    got = {r.row: r.shard for r in kd_shards.assign(slim, shards).collect()}
    items = slim.collect()
    dims = kd_shards.DIMENSIONS
    spread = [max(max(r[d] for r in items) - min(r[d] for r in items), 1) for d in dims]
    want: dict = {}

    def split(some, number, k):
        if k == 1 or not some:
            want.update((r.row, number) for r in some)
            return
        wide = [(max(r[d] for r in some) - min(r[d] for r in some)) / s for d, s in zip(dims, spread, strict=True)]
        dim = dims[wide.index(max(wide))]
        order = sorted(some, key=lambda r: (r[dim], r.place, r.row))
        goal, below, left = sum(r.size for r in some) * (k // 2) // k, 0, 0
        for r in order:                                         # the row that holds the quantile goes to the nearer side
            if below + r.size >= goal:
                left += 2 * (goal - below) >= r.size
                break
            below += r.size
            left += 1
        split(order[:left], number, k // 2)
        split(order[left:], number + k // 2, k - k // 2)

    split(items, 0, shards)
    assert got == want
