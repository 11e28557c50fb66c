"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

*Input.* A word's vector joins a word part (a learned embedding of its hash and its log
odds), and a character part (the mean learned embedding of its 4-byte character grams,
word ends included, with the largest and mean log odds of those grams), so unseen words
still say something. Words are lower-cased runs of letters and digits.

*Network.* Two gated recurrent layers read a window of ``WINDOW`` words in both directions;
attention weighs the positions; a linear unit gives the window's logit. A document is read
in windows that overlap by ``WINDOW - STRIDE`` words and cover every word; its logit is the
largest of its windows', turned into a probability by a logistic fit on the sample.

*Training.* On the driver, on at most ``MAX_TOXIC`` + ``MAX_CLEAN`` labelled documents of at
most ``MAX_CHARS`` characters, taken in hash order (that is the documented bound; scoring
covers every word of every text). Toxic documents teach by the windows that look worst,
first by log odds, then by the network itself.

Defined results: a null or empty text is one empty window and gets its score; null labels are
ignored; a sample without both classes gives the share of toxic labels as every score; equal
rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import ship_package

WINDOW, STRIDE = 32, 24
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
WORD_BITS, CHAR_BITS = 16, 15
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 2000, 3000, 20_000
BLOCK = 4096               # windows run at once
TOXIC_SHARE = 0.1          # assumed share for the log odds
F32 = np.float32


# ---------------------------------------------------------------- input

@dataclass
class Words:
    """The distinct words of a chunk (plus a last, empty one for padding) and the windows over them."""
    bucket: np.ndarray       # word bucket of each distinct word
    grams: np.ndarray        # character-gram buckets, word after word
    gram_first: np.ndarray
    gram_count: np.ndarray
    windows: np.ndarray      # windows x WINDOW: index of a distinct word, len(bucket) where padded
    owner: np.ndarray        # text of each window


def read_words(c: tk.Chunk) -> Words:
    starts, ends = c.runs(tk.ALNUM)
    h = c.span_hashes(starts, ends, fold=True)
    counts = c.per_text(starts)
    u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    # Character grams of each distinct word: 4-byte pieces of "^word$".
    s, n = starts[first], (ends - starts)[first]
    lower = c.data.copy()
    upper = (lower >= 0x41) & (lower <= 0x5A)
    lower[upper] += 32
    padded = np.concatenate([[0], np.cumsum(n + 2)])
    flat = np.zeros(int(padded[-1]), np.uint64)
    inner = np.repeat(padded[:-1] + 1 - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n) + np.arange(int(n.sum()))
    flat[inner] = lower[np.repeat(s - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n) + np.arange(int(n.sum()))]
    flat[padded[:-1]], flat[padded[1:] - 1] = 1, 2
    size = n + 2
    gram_count = np.maximum(size - 3, 1)
    ext = np.concatenate([flat, np.zeros(3, np.uint64)])
    code = ext[:-3] | (ext[1:-2] << np.uint64(8)) | (ext[2:-1] << np.uint64(16)) | (ext[3:] << np.uint64(24))
    gram_first = np.concatenate([[0], np.cumsum(gram_count)])[:-1].astype(np.int64) if len(n) else np.empty(0, np.int64)
    at = np.repeat(padded[:-1] - gram_first, gram_count) + np.arange(int(gram_count.sum()))
    short = np.repeat(size < 4, gram_count)      # a one-letter word: its own three bytes only
    code = np.where(short, code[at] & np.uint64(0xFFFFFF), code[at])
    grams = (tk.mix(code + np.uint64(0x7777)) >> np.uint64(64 - CHAR_BITS)).astype(np.int32)
    # Windows that cover every word of every text.
    n_win = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(c.n), n_win)
    base = np.cumsum(counts) - counts
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    pos = k[:, None] * STRIDE + np.arange(WINDOW)
    inside = pos < counts[owner][:, None]
    if len(inverse):
        windows = np.where(inside, inverse[np.minimum(base[owner][:, None] + pos, len(inverse) - 1)], len(u))
    else:
        windows = np.full(pos.shape, 0)
    return Words((u >> np.uint64(64 - WORD_BITS)).astype(np.int32), grams, gram_first, gram_count, windows.astype(np.int32), owner)


def join_words(parts: list[Words], texts: list[int]) -> Words:
    """Several chunks' words as one; a word of two chunks is in it twice. ``texts``: texts of each chunk."""
    words = np.cumsum([0] + [len(p.bucket) for p in parts])
    grams = np.cumsum([0] + [len(p.grams) for p in parts])
    before = np.cumsum([0, *texts])
    return Words(np.concatenate([p.bucket for p in parts]), np.concatenate([p.grams for p in parts]),
                 np.concatenate([p.gram_first + g for p, g in zip(parts, grams, strict=False)]), np.concatenate([p.gram_count for p in parts]),
                 np.concatenate([np.where(p.windows == len(p.bucket), words[-1], p.windows + w).astype(np.int32) for p, w in zip(parts, words, strict=False)]),
                 np.concatenate([p.owner + t for p, t in zip(parts, before, strict=False)]))


def subset(w: Words, rows: np.ndarray) -> Words:
    """The named windows and only their words."""
    used, inverse = np.unique(w.windows[rows], return_inverse=True)
    pad = len(used) > 0 and used[-1] == len(w.bucket)
    used = used[:-1] if pad else used
    count = w.gram_count[used]
    first = np.cumsum(count) - count
    at = np.repeat(w.gram_first[used] - first, count) + np.arange(int(count.sum()))
    return Words(w.bucket[used], w.grams[at], first, count, inverse.reshape(len(rows), -1).astype(np.int32), w.owner[rows])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights. ``p`` holds the trained arrays by name; log odds and calibration are fixed after fitting."""
    p: dict[str, np.ndarray]
    word_odds: np.ndarray
    char_odds: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    _adam: dict = field(default_factory=dict)

    def vectors(self, w: Words) -> np.ndarray:
        """Input vector of each distinct word; the last row (padding) is zero."""
        n = len(w.bucket)
        x = np.zeros((n + 1, WORD_DIM + CHAR_DIM + 3), F32)
        if n:
            x[:n, :WORD_DIM] = self.p["word"][w.bucket]
            x[:n, WORD_DIM: WORD_DIM + CHAR_DIM] = np.add.reduceat(self.p["char"][w.grams], w.gram_first) / w.gram_count[:, None]
            odds = self.char_odds[w.grams]
            x[:n, -3] = self.word_odds[w.bucket]
            x[:n, -2] = np.maximum.reduceat(odds, w.gram_first)
            x[:n, -1] = np.add.reduceat(odds, w.gram_first) / w.gram_count
        return x

    def _run(self, proj: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
        """One direction over steps x windows x 3 HIDDEN projections; returns steps x windows x HIDDEN states."""
        steps, n, _ = proj.shape
        h = np.zeros((n, HIDDEN), F32)
        out = np.empty((steps, n, HIDDEN), F32)
        for t in range(steps):
            a = proj[t]
            g = _sigmoid(a[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            cand = np.tanh(a[:, 2 * HIDDEN:] + (r * h) @ u[:, 2 * HIDDEN:])
            z = z * mask[t]
            if keep is not None:
                keep.append((h, z, r, cand))
            h = h + z * (cand - h)
            out[t] = h
        return out

    def logits(self, w: Words, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        x = self.vectors(w)
        pf, pb = x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]
        if keep is not None:
            return self._window_logits(w, w.windows, x, pf, pb, keep)
        parts = [self._window_logits(w, w.windows[i: i + BLOCK], x, pf, pb, None) for i in range(0, len(w.windows), BLOCK)]
        return np.concatenate(parts) if parts else np.empty(0, F32)

    def _window_logits(self, w: Words, win: np.ndarray, x: np.ndarray, pf: np.ndarray, pb: np.ndarray, keep: dict | None) -> np.ndarray:
        idx = win.T                                                       # steps x windows
        mask = (idx != len(w.bucket)).astype(F32)[:, :, None]
        tape_f, tape_b = ([], []) if keep is not None else (None, None)
        hf = self._run(pf[idx], mask, self.p["Uf"], tape_f)
        hb = self._run(pb[idx[::-1]], mask[::-1], self.p["Ub"], tape_b)[::-1]
        h = np.concatenate([hf, hb], 2)
        e = np.tanh(h @ self.p["Wa"] + self.p["ba"])
        score = (e @ self.p["va"]) + (mask[:, :, 0] - 1) * 30
        score -= score.max(0)
        alpha = np.exp(score)
        alpha /= alpha.sum(0)
        pooled = np.einsum("tn,tnh->nh", alpha, h)
        if keep is not None:
            keep.update(x=x, idx=idx, mask=mask, h=h, e=e, alpha=alpha, pooled=pooled, f=tape_f, b=tape_b)
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def document_logits(self, w: Words, n: int) -> np.ndarray:
        out = np.full(n, -np.inf)
        np.maximum.at(out, w.owner, self.logits(w))
        return out

    def score_chunk(self, c: tk.Chunk) -> np.ndarray:
        if self.constant is not None:
            return np.full(c.n, self.constant)
        z = self.slope * self.document_logits(read_words(c), c.n) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


# ---------------------------------------------------------------- training

def _back(proj_grad: np.ndarray, d_out: np.ndarray, tape: list, u: np.ndarray, du: np.ndarray) -> None:
    """Backward through one direction; fills the projections' gradient (steps x windows x 3 HIDDEN)."""
    dh = np.zeros_like(d_out[0])
    for t in reversed(range(len(tape))):
        h, z, r, cand = tape[t]
        dh = dh + d_out[t]
        d_cand = dh * z * (1 - cand * cand)
        gate = dh * (cand - h)
        raw = np.where(z > 0, z, 0)
        d_z = gate * raw * (1 - raw)
        rh = d_cand @ u[:, 2 * HIDDEN:].T
        d_r = rh * h * r * (1 - r)
        proj_grad[t, :, :HIDDEN], proj_grad[t, :, HIDDEN: 2 * HIDDEN], proj_grad[t, :, 2 * HIDDEN:] = d_z, d_r, d_cand
        du[:, : HIDDEN] += h.T @ d_z
        du[:, HIDDEN: 2 * HIDDEN] += h.T @ d_r
        du[:, 2 * HIDDEN:] += (r * h).T @ d_cand
        dh = dh * (1 - z) + d_z @ u[:, :HIDDEN].T + d_r @ u[:, HIDDEN: 2 * HIDDEN].T + rh * r


def gradients(net: Network, w: Words, rows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross-entropy of the windows and its gradient by array name."""
    k: dict = {}
    w = subset(w, rows)
    z = net.logits(w, k)
    prob = _sigmoid(z)
    loss = float(-(weight * np.where(y, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))).sum() / weight.sum())
    dz = ((prob - y) * weight / weight.sum()).astype(F32)
    g = {name: np.zeros_like(a) for name, a in net.p.items()}
    g["wo"], g["bo"] = k["pooled"].T @ dz, np.array([dz.sum()], F32)
    d_pooled = dz[:, None] * net.p["wo"]
    dh = k["alpha"][:, :, None] * d_pooled
    d_alpha = np.einsum("tnh,nh->tn", k["h"], d_pooled)
    d_score = k["alpha"] * (d_alpha - (k["alpha"] * d_alpha).sum(0))
    de = d_score[:, :, None] * net.p["va"] * (1 - k["e"] ** 2)
    g["va"] = np.einsum("tnh,tn->h", k["e"], d_score)
    g["Wa"], g["ba"] = np.einsum("tni,tnj->ij", k["h"], de), de.sum((0, 1))
    dh = dh + de @ net.p["Wa"].T
    pf, pb = (np.empty((*k["idx"].shape, 3 * HIDDEN), F32) for _ in range(2))
    _back(pf, dh[:, :, :HIDDEN], k["f"], net.p["Uf"], g["Uf"])
    _back(pb, dh[::-1, :, HIDDEN:], k["b"], net.p["Ub"], g["Ub"])
    # Sum the projections' gradients per distinct word, then go on to the weights and embeddings.
    flat = k["idx"].ravel()
    order = np.argsort(flat, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
    used = flat[order][heads]
    per_f = np.add.reduceat(pf.reshape(-1, 3 * HIDDEN)[order], heads)
    per_b = np.add.reduceat(pb[::-1].reshape(-1, 3 * HIDDEN)[order], heads)
    x = k["x"][used]
    g["Wf"], g["bf"], g["Wb"], g["bb"] = x.T @ per_f, per_f.sum(0), x.T @ per_b, per_b.sum(0)
    dx = per_f @ net.p["Wf"].T + per_b @ net.p["Wb"].T
    real = used < len(w.bucket)
    used, dx = used[real], dx[real]
    np.add.at(g["word"], w.bucket[used], dx[:, :WORD_DIM])
    count = w.gram_count[used]
    at = np.repeat(w.gram_first[used] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(used) else count, count) + np.arange(int(count.sum()))
    np.add.at(g["char"], w.grams[at], np.repeat(dx[:, WORD_DIM: WORD_DIM + CHAR_DIM] / count[:, None], count, 0))
    return loss, g


def _step(net: Network, g: dict[str, np.ndarray], rate: float) -> None:
    """One Adam step."""
    st = net._adam
    st["t"] = st.get("t", 0) + 1
    for name, d in g.items():
        m, v = st.setdefault(name, (np.zeros_like(d), np.zeros_like(d)))
        m *= 0.9
        m += 0.1 * d
        v *= 0.999
        v += 0.001 * d * d
        net.p[name] -= (rate * (m / (1 - 0.9 ** st["t"])) / (np.sqrt(v / (1 - 0.999 ** st["t"])) + 1e-8)).astype(F32)


def _count(bucket: np.ndarray, text: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """Texts that hold each bucket: clean ones, toxic ones."""
    seen = np.unique(text.astype(np.int64) * size + bucket)
    t, b = seen // size, seen % size
    return np.stack([np.bincount(b[~toxic[t]], minlength=size), np.bincount(b[toxic[t]], minlength=size)])


def _odds(clean: np.ndarray, hit: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of a bucket's toxic texts to those expected at its overall frequency."""
    other = clean * ((1 - TOXIC_SHARE) / TOXIC_SHARE * max(toxic.sum(), 1) / max((~toxic).sum(), 1))
    return np.log((hit + 1) / ((hit + other) * TOXIC_SHARE + 1)).astype(F32)


def fit(texts: pa.Array, toxic: np.ndarray, rounds: int = 2, epochs: int = 4, batch: int = 512, rate: float = 0.02,
        min_steps: int = 160, seed: int = 7) -> Network:
    """Train on the sample; deterministic for given texts and labels."""
    rng = np.random.default_rng(seed)
    d = WORD_DIM + CHAR_DIM + 3
    init = lambda *s, scale=0.3: (rng.standard_normal(s) * scale).astype(F32)
    net = Network({"word": init(1 << WORD_BITS, WORD_DIM, scale=0.05), "char": init(1 << CHAR_BITS, CHAR_DIM, scale=0.05),
                   "Wf": init(d, 3 * HIDDEN), "Wb": init(d, 3 * HIDDEN), "bf": np.zeros(3 * HIDDEN, F32), "bb": np.zeros(3 * HIDDEN, F32),
                   "Uf": init(HIDDEN, 3 * HIDDEN), "Ub": init(HIDDEN, 3 * HIDDEN), "Wa": init(2 * HIDDEN, HIDDEN), "ba": np.zeros(HIDDEN, F32),
                   "va": init(HIDDEN), "wo": init(2 * HIDDEN), "bo": np.zeros(1, F32)}, np.zeros(1 << WORD_BITS, F32), np.zeros(1 << CHAR_BITS, F32))
    if toxic.all() or not toxic.any():
        net.constant = float(toxic.mean()) if len(toxic) else 0.0
        return net
    # Chunk by chunk: texts that hold each word and each character gram.
    parts, sizes = [], []
    words, grams = np.zeros((2, 1 << WORD_BITS)), np.zeros((2, 1 << CHAR_BITS))
    for c in tk.chunks(texts):
        part = read_words(c)
        y = toxic[c.lo: c.hi]
        word_at, text_at = part.windows.ravel(), np.repeat(part.owner, WINDOW)
        ok = word_at < len(part.bucket)
        pair = np.unique(text_at[ok].astype(np.int64) * max(len(part.bucket), 1) + word_at[ok])
        text_at, word_at = pair // max(len(part.bucket), 1), pair % max(len(part.bucket), 1)
        words += _count(part.bucket[word_at], text_at, y, 1 << WORD_BITS)
        count = part.gram_count[word_at]
        at = np.repeat(part.gram_first[word_at] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        grams += _count(part.grams[at], np.repeat(text_at, count), y, 1 << CHAR_BITS)
        parts.append(part)
        sizes.append(c.n)
    net.word_odds, net.char_odds = _odds(*words, toxic), _odds(*grams, toxic)
    looks = []
    for part in parts:
        x = net.vectors(part)
        looks.append((x[:, -3] + x[:, -2])[part.windows].max(1))
    looks = np.concatenate(looks)
    w = join_words(parts, sizes)
    n = len(w.owner)
    is_toxic = toxic[w.owner]
    for _ in range(rounds):
        order = np.lexsort((-looks, w.owner))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.searchsorted(w.owner[order], w.owner[order])
        rows = np.flatnonzero(np.where(is_toxic, rank < 1, (rank < 2) | (rng.random(n) < 0.05)))
        y = is_toxic[rows].astype(F32)
        weight = np.where(y > 0, 1 / max(y.sum(), 1), 1 / max((1 - y).sum(), 1)).astype(F32) * len(rows)
        batches = max(1, -(-len(rows) // batch))
        passes = max(epochs, -(-min_steps // batches))
        for i in range(passes):
            for some in np.array_split(rng.permutation(len(rows)), batches):
                _step(net, gradients(net, w, rows[some], y[some], weight[some])[1], rate * (1 - 0.9 * i / passes))
        looks = np.concatenate([net.logits(part) for part in parts])
    # Calibration of document logits, classes weighted to the assumed share.
    z = np.full(len(toxic), -np.inf)
    np.maximum.at(z, w.owner, looks)
    share = np.where(toxic, TOXIC_SHARE / toxic.sum(), (1 - TOXIC_SHARE) / (~toxic).sum())
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, s = share * (q - toxic), share * q * (1 - q) + 1e-9
        grad = np.array([(r * z).sum() + 1e-4 * a, r.sum()])
        hess = np.array([[(s * z * z).sum() + 1e-4, (s * z).sum()], [(s * z).sum(), s.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
    net.slope, net.shift, net._adam = float(a), float(b), {}
    return net


def sample(docs: DataFrame, labelled: DataFrame, label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
           max_chars: int = MAX_CHARS) -> tuple[pa.Array, np.ndarray]:
    """The bounded training sample: ids are chosen among the labels, then only their texts are fetched."""
    y = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    pick = lambda v, n: y.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = pick(1, max_toxic).union(pick(0, max_clean))
    got = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length(F.coalesce("text", F.lit(""))) <= max_chars)
           .join(F.broadcast(ids), "doc_id").orderBy("doc_id", "text").limit(max_toxic + max_clean).toArrow())
    return got.column("text").combine_chunks(), got.column("y").to_numpy() == 1


def train(docs: DataFrame, labelled: DataFrame, label_col: str = "toxic") -> Network:
    ship_package(docs.sparkSession)
    return fit(*sample(docs, labelled, label_col))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; the network (a few megabytes, fixed) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column("text")):
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(c.lo, c.n), "score": pa.array(shared.value.score_chunk(c).astype(np.float64))})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
