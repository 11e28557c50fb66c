"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

*Patterns* (``base_spans``): key assignments, access keys and long hex runs, leftmost and non-overlapping per kind.

*Tokens* are runs of letters, digits, underscores and bytes beyond ASCII. Each is tagged as secret begin, inside
or outside. A token's features are its shape (length, character classes, changes of class, hex and
vowel shares), its own word, the two words before and the word after it, the gaps around it (assignment
signs, quotes, line breaks, joints such as ``-`` and ``.``), the shapes of its neighbours, and the file
(shares of digits and symbols, line lengths).

*Training.* The patterns teach. A pass over all documents writes windows of ``WINDOW`` tokens: around every
pattern span, around the same places with the value replaced by random letters of several alphabets, and from one of ``CLEAN_RATE`` documents without any (by the hash of the text) around its most
suspicious token and at a random place. Equal windows count once. At most about ``MAX_SECRET`` + ``MAX_CLEAN`` of them, by their hash, go to
the driver: that is the documented bound of the sample; scoring covers every token of every text. The likelihood is that of the whole tag chain (forward and
backward sums); in every step parts of the features are hidden at random, so that context alone or shape alone can tell.

*Decoding* is Viterbi's, exact and short: a token whose score for "outside" exceeds the others by more than
all transitions could make up is outside in every best chain, so chains are decoded between such tokens only.

A found span reaches from its first to its last token (with up to two padding signs) and is added under the kind
``crf`` unless it overlaps a pattern span. Offsets count code points, ends are exclusive.

Defined results: null and empty texts have no spans. Ties go to "outside". Repeated rows get equal spans. A corpus without
pattern spans, or without any document, trains nothing and adds nothing. Null ids are kept. Texts and
tokens of any length are read whole. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as tk
from .shared import concat_runs, ship_package, stored

# ---------------------------------------------------------------- patterns

KINDS = ("assign", "access", "hex", "crf")
# The patterns of the contract.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")         # runs are maximal, so the shorter ones may be skipped at once
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS = 6, 20


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Pattern spans by start, then kind: ``start, kind, end, start of the value``."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


# ---------------------------------------------------------------- features

OUTSIDE, BEGIN, INSIDE = range(3)
WORD_BITS = 11
WINDOW, CLEAN_RATE = 24, 8
MAX_SECRET, MAX_CLEAN = 4000, 6000

GROUPS = {"shape": 512, "fine": 32, "own": 1 << WORD_BITS, "before": 1 << WORD_BITS, "before2": 1 << WORD_BITS, "after": 1 << WORD_BITS,
          "gap_before": 17, "gap_after": 17, "shape_before": 128, "shape_after": 128, "file": 128}
_FIRST = dict(zip(GROUPS, np.cumsum([0, *GROUPS.values()])[:-1].tolist(), strict=True))
N_FEATURES = sum(GROUPS.values())
#: Groups hidden together in training.
HIDDEN_TOGETHER = (("before", "before2", "after"), ("gap_before", "gap_after"), ("own",), ("shape_before", "shape_after"), ("file",))

TOKEN = np.zeros(256, bool)
TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 256)]] = True
_STEP = 21                                   # bits per packed count


def _packed(*classes: bytes | range) -> np.ndarray:
    """Per byte: a one in the field of each class it belongs to."""
    lut = np.zeros(256, np.int64)
    for i, members in enumerate(classes):
        lut[list(members)] += 1 << (_STEP * i)
    return lut


_CASE = _packed(range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A))
_KIND = _packed(b"0123456789abcdefABCDEF", b"aeiouyAEIOUY", b"")
_GAP = _packed(b"=:", b"\"'`", b"\n\r")
_FILE = _packed(range(0x30, 0x3A), b"=:{}[]()<>\"'`;#$%&|\\@/_", b"\n")
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 1, 2, 3
_JOINT = np.zeros(256, bool)
_JOINT[list(b"-./+@~")] = True


def _fields(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << _STEP) - 1
    return packed & mask, (packed >> _STEP) & mask, (packed >> (2 * _STEP)) & mask


def _running(per_byte: np.ndarray) -> np.ndarray:
    out = np.zeros(len(per_byte) + 1, np.int64)
    np.cumsum(per_byte, out=out[1:])
    return out


@dataclass
class Tokens:
    """Tokens of a chunk: byte spans, tokens per text, and one feature row each."""
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    features: np.ndarray         # tokens x groups, places in the weight table
    suspicion: np.ndarray        # how unlike prose a token looks; only picks training windows


def read_tokens(c: tk.Chunk) -> Tokens:
    starts, ends = c.runs(TOKEN)
    counts = c.per_text(starts)
    n = len(starts)
    if not n:
        return Tokens(starts, ends, counts, np.zeros((0, len(GROUPS)), np.int16), np.zeros(0))
    size = ends - starts
    word = (c.span_hashes(starts, ends, fold=True) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    case, kind = _running(_CASE[c.data]), _running(_KIND[c.data])
    lower, upper, digit = _fields(case[ends] - case[starts])
    hexes, vowels, _ = _fields(kind[ends] - kind[starts])
    cls = _CLASS[c.data]
    change = _running(np.concatenate([[False], cls[1:] != cls[:-1]]))
    changes = change[ends] - change[starts + 1]
    length = np.searchsorted([4, 8, 12, 16, 20, 32, 48], size, "right")
    classes = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (lower + upper + digit < size)
    coarse = length * 16 + classes
    shape = coarse * 4 + np.searchsorted([1, 3, 6], changes, "right")
    fine = (hexes == size) * 16 + np.searchsorted([0.15, 0.3, 0.5], vowels / np.maximum(lower + upper, 1), "right") * 4 + np.searchsorted([0.05, 0.2, 0.4], changes / size, "right")
    # Gaps: what stands between a token and the one before it in its text.
    text = np.repeat(np.arange(c.n), counts)
    head = np.concatenate([[True], text[1:] != text[:-1]])
    tail = np.append(head[1:], True)
    gap_from = np.where(head, c.offsets[text], np.concatenate([[0], ends[:-1]]))
    gap = _running(_GAP[c.data])
    signs, quotes, breaks = _fields(gap[starts] - gap[gap_from])
    joint = (starts - gap_from == 1) & _JOINT[c.data[gap_from]]
    before = np.where(head, 16, (signs > 0) + 2 * (quotes > 0) + 4 * (breaks > 0) + 8 * joint)
    at_end = gap[c.offsets[text + 1]] - gap[ends]
    s2, q2, b2 = _fields(at_end)
    after = np.where(tail, (s2 > 0) + 2 * (q2 > 0) + 4 * (b2 > 0), np.append(before[1:], 0))
    # The file: shares of digits and symbols, mean line length.
    digits, symbols, lines = _fields(np.diff(_running(_FILE[c.data])[c.offsets]))
    long = np.maximum(np.diff(c.offsets), 1)
    file = np.searchsorted([0.01, 0.05, 0.2], digits / long, "right") * 16 + np.searchsorted([0.005, 0.02, 0.1], symbols / long, "right") * 4 \
        + np.searchsorted([30, 80, 300], long / (lines + 1), "right")
    odd = (size >= 12) & (digit > 0)

    def shifted(x: np.ndarray, by: int, none: int) -> np.ndarray:
        """The value of the token ``by`` places on in the same text, else ``none``."""
        y = np.full(n, none, np.int64)
        if by > 0:
            y[:-by] = x[by:]
            y[:-by][text[by:] != text[:-by]] = none
        else:
            y[-by:] = x[:by]
            y[-by:][text[:by] != text[-by:]] = none
        return y

    columns = {"shape": shape, "fine": fine, "own": np.where(size < 16, word, 0), "before": shifted(word, -1, 0), "before2": shifted(word, -2, 0) if n > 2 else np.zeros(n, np.int64),
               "after": shifted(word, 1, 0), "gap_before": before, "gap_after": after, "shape_before": shifted(coarse, -1, 0), "shape_after": shifted(coarse, 1, 0),
               "file": file[text] * 2 + odd}
    features = np.empty((n, len(GROUPS)), np.int16)
    for i, g in enumerate(GROUPS):
        features[:, i] = columns[g] + _FIRST[g]
    return Tokens(starts, ends, counts, features, size * (digit > 0) + size * (changes > 2) + 30 * ((before & 1) > 0))


# ---------------------------------------------------------------- the field

@dataclass
class Field:
    """Weights: features x tags, and transitions tag x next tag."""
    weights: np.ndarray
    moves: np.ndarray
    trained: bool = True

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3), np.float32)
        for g in range(features.shape[1]):
            out += self.weights[features[:, g]]
        return out

    def certain(self, e: np.ndarray) -> np.ndarray:
        """True where "outside" wins whatever the neighbouring tags are."""
        m = self.moves
        sure = np.ones(len(e), bool)
        for tag in (BEGIN, INSIDE):
            gain = max(0.0, float((m[:, tag] - m[:, OUTSIDE]).max())) + max(0.0, float((m[tag] - m[OUTSIDE]).max()))
            sure &= e[:, OUTSIDE] - e[:, tag] > gain + 1e-3
        return sure

    def decode(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The best tag chain of each text."""
        e = self.emissions(features)
        tags = np.zeros(len(e), np.int8)
        open_ = np.flatnonzero(~self.certain(e))
        if not len(open_):
            return tags
        text = np.repeat(np.arange(len(counts)), counts)
        new = np.concatenate([[True], (np.diff(open_) != 1) | (text[open_[1:]] != text[open_[:-1]])])
        first = open_[new]
        size = np.diff(np.append(np.flatnonzero(new), len(open_)))
        ends = np.cumsum(counts)
        head = first == (ends - counts)[text[first]]                     # nothing before: no transition into the chain
        tail = first + size == ends[text[first]]
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):                                            # chains of like length together
            hi = int(np.searchsorted(size[order], 2 * size[order[lo]], "right"))
            hi = min(hi, lo + max(1, (1 << 20) // int(2 * size[order[lo]])))
            r = order[lo:hi]
            tags[concat_runs(first[r], size[r])] = self._chains(e, first[r], size[r], head[r], tail[r])
            lo = hi
        return tags

    def _chains(self, e: np.ndarray, first: np.ndarray, size: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        n, steps = len(first), int(size.max())
        back = np.zeros((steps, n, 3), np.int8)
        score = e[first] + np.where(head[:, None], 0, self.moves[OUTSIDE])
        for t in range(1, steps):
            on = t < size
            way = score[:, :, None] + self.moves
            back[t] = way.argmax(1)
            best = way.max(1) + e[np.minimum(first + t, len(e) - 1)]
            score = np.where(on[:, None], best, score)
        tag = (score + np.where(tail[:, None], 0, self.moves[:, OUTSIDE])).argmax(1)
        out = np.zeros((n, steps), np.int8)
        for t in reversed(range(steps)):
            on = t < size
            out[on, t] = tag[on]
            if t:
                tag = np.where(on, back[t][np.arange(n), tag], tag)
        return out[np.arange(steps) < size[:, None]]


def likelihood(field: Field, x: np.ndarray, tags: np.ndarray, hidden: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood of windows (features -1 and tags -1 beyond their end), and its gradients.

    ``x``: windows x steps x groups; ``hidden``: windows x groups, True where a window hides a group."""
    n, steps, _ = x.shape
    there = tags >= 0
    used = there[:, :, None] & (x >= 0)
    if hidden is not None:
        used &= ~hidden[:, None, :]
    e = (field.weights[np.maximum(x, 0)] * used[..., None]).sum(2)
    m = field.moves
    alpha, beta = np.empty((steps, n, 3)), np.zeros((steps, n, 3))
    alpha[0] = e[:, 0]
    for t in range(1, steps):
        nxt = np.logaddexp.reduce(alpha[t - 1][:, :, None] + m, axis=1) + e[:, t]
        alpha[t] = np.where(there[:, t, None], nxt, alpha[t - 1])
    for t in reversed(range(steps - 1)):
        prev = np.logaddexp.reduce(m[None] + (e[:, t + 1] + beta[t + 1])[:, None, :], axis=2)
        beta[t] = np.where(there[:, t + 1, None], prev, 0)
    log_z = np.logaddexp.reduce(alpha[-1], axis=1)
    marginal = np.exp(alpha + beta - log_z[None, :, None]).transpose(1, 0, 2) * there[:, :, None]
    told = np.zeros((n, steps, 3))
    told[there] = np.eye(3)[tags[there]]
    score = (e * told).sum((1, 2))
    d_moves = np.zeros((3, 3))
    for t in range(steps - 1):
        on = there[:, t + 1]
        pair = np.exp(alpha[t][:, :, None] + m + (e[:, t + 1] + beta[t + 1])[:, None, :] - log_z[:, None, None])
        d_moves += np.einsum("ni,nj->ij", told[on, t], told[on, t + 1]) - pair[on].sum(0)
        score[on] += m[tags[on, t], tags[on, t + 1]]
    diff = told - marginal
    flat = x[used]
    d_weights = np.stack([np.bincount(flat, np.broadcast_to(diff[:, :, None, k], x.shape)[used], N_FEATURES) for k in range(3)], 1)
    return float((score - log_z).sum()) / n, d_weights / n, d_moves / n


def fit(x: np.ndarray, tags: np.ndarray, steps: int = 120, rate: float = 0.15, decay: float = 1e-5, seed: int = 11) -> Field:
    """Adam on the likelihood, parts of the features hidden at random."""
    field = Field(np.zeros((N_FEATURES, 3)), np.zeros((3, 3)), trained=bool((tags > 0).any()))
    if not field.trained:
        return field
    rng = np.random.default_rng(seed)
    names = list(GROUPS)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (field.weights, field.moves)]
    for step in range(1, steps + 1):
        hidden = np.zeros((len(x), len(GROUPS)), bool)
        for together in HIDDEN_TOGETHER:
            hidden[np.ix_(rng.random(len(x)) < 0.3, [names.index(g) for g in together])] = True
        pick = rng.random(len(x)) < 0.25 if len(x) > 2000 else np.ones(len(x), bool)
        _, *grads = likelihood(field, x[pick], tags[pick], hidden[pick])
        for p, g, (m, v) in zip((field.weights, field.moves), grads, state, strict=True):
            g = g - decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    field.weights, field.moves = field.weights.astype(np.float32), field.moves.astype(np.float32)
    return field


# ---------------------------------------------------------------- Spark

def _bytes_before(text: str, at: int) -> int:
    return len(text[:at].encode())


def _text_hash(text: str) -> int:
    return zlib.crc32(text.encode())


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = ("".join(_LETTERS), _LETTERS[0] + _LETTERS[2], _LETTERS[1] + _LETTERS[2], "".join(_LETTERS) + "-_./+")


def variant(text: str, values: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text with each value (spans in order, apart from each other) replaced by random letters of a random alphabet."""
    rng = np.random.default_rng(_text_hash(text))
    out, spans, at, size = [], [], 0, 0
    for s, e in values:
        letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
        value = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(14, 45)))
        out += [text[at:s], value]
        size += s - at
        spans.append((size, size + len(value)))
        size += len(value)
        at = e
    return "".join(out) + text[at:], spans


def _values(text: str) -> list[tuple[int, int]]:
    """The secret parts of the pattern spans, the first of overlapping ones."""
    values: list[tuple[int, int]] = []
    for _, _, end, value in base_spans(text):
        if not values or value >= values[-1][1]:
            values.append((value, end))
    return values


def _windows(c: tk.Chunk, texts: list[str], values: list[list[tuple[int, int]]]) -> Iterator[tuple[bool, list[int], list[int]]]:
    """Windows of a chunk's texts: around the values, or around two places of a text without any."""
    tokens = read_tokens(c)
    ends = np.cumsum(tokens.counts)
    for i, text in enumerate(texts):
        lo, hi, at = int(ends[i] - tokens.counts[i]), int(ends[i]), int(c.offsets[i])
        if lo == hi:
            continue
        tags = np.zeros(hi - lo, np.int16)
        centres = []
        for s, e in values[i]:
            first = int(np.searchsorted(tokens.ends[lo:hi], at + _bytes_before(text, s), "right"))
            last = int(np.searchsorted(tokens.starts[lo:hi], at + _bytes_before(text, e), "left"))
            if first < last:
                tags[first:last] = INSIDE
                tags[first] = BEGIN
                centres.append(first)
        if not values[i]:
            centres = [int(tokens.suspicion[lo:hi].argmax()), _text_hash(text) // CLEAN_RATE % (hi - lo)]
        for m in centres:
            # The place of the centre in its window varies, so that it tells nothing.
            s = min(max(0, m - 4 - (m * 7 + hi - lo) % (WINDOW - 8)), max(0, hi - lo - WINDOW))
            k = min(WINDOW, hi - lo - s)
            x, y = np.full((WINDOW, len(GROUPS)), -1, np.int16), np.full(WINDOW, -1, np.int16)
            x[:k], y[:k] = tokens.features[lo + s: lo + s + k], tags[s: s + k]
            yield bool(values[i]), x.ravel().tolist(), y.tolist()


def training_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``secret, features, tags``: stored windows, equal ones once, with their hash as ``key``."""
    ship_package(docs.sparkSession)
    kinds = (pa.bool_(), pa.list_(pa.int16()), pa.list_(pa.int16()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in tk.chunks(b.column(0)):
                texts, values = [], []
                for t in b.column(0).slice(part.lo, part.n).to_pylist():
                    v = _values(t or "")
                    if v:
                        changed = variant(t, v)
                        texts += [t, changed[0]]
                        values += [v, changed[1]]
                    elif t and _text_hash(t) % CLEAN_RATE == 0:
                        texts.append(t)
                        values.append([])
                for c in tk.chunks(pa.array(texts, pa.string())):
                    rows = list(_windows(c, texts[c.lo: c.hi], values[c.lo: c.hi]))
                    if rows:
                        yield pa.record_batch([pa.array(col, kind) for col, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=["secret", "features", "tags"])

    windows = docs.select(F.col(text_col)).mapInArrow(run, "secret boolean, features array<short>, tags array<short>")
    return stored(windows.withColumn("key", F.xxhash64("features", "tags")).dropDuplicates(["key"]), "secret-windows", "zstd")


def train(docs: DataFrame, text_col: str = "text") -> Field:
    windows = training_windows(docs, text_col)
    found = {r.secret: r.n for r in windows.groupBy("secret").agg(F.count("*").alias("n")).collect()}

    def part(secret: bool, most: int) -> list:
        rows = windows.where(F.col("secret") == secret)
        n = found.get(secret, 0)
        if n > most:                                       # by hash: about ``most`` of them, the same ones in every run
            rows = rows.where(F.pmod("key", F.lit(1 << 30)) < F.lit(int((1 << 30) * most / n)))
        return rows.select("key", "features", "tags").collect()

    rows = sorted(part(True, MAX_SECRET) + part(False, MAX_CLEAN), key=lambda r: r.key)
    x = np.array([r.features for r in rows], np.int16).reshape(len(rows), WINDOW, len(GROUPS))
    return fit(x, np.array([r.tags for r in rows], np.int16).reshape(len(rows), WINDOW))


def chunk_spans(c: tk.Chunk, texts: list[str], field: Field) -> list[list[tuple[int, int, int]]]:
    """Per text all spans ``start, kind, end`` by start, then kind."""
    base = [base_spans(t) for t in texts]
    out = [[(s, k, e) for s, k, e, _ in b] for b in base]
    if not field.trained:
        return out
    tokens = read_tokens(c)
    tags = field.decode(tokens.features, tokens.counts)
    hit = np.flatnonzero(tags)
    if not len(hit):
        return out
    text = np.repeat(np.arange(c.n), tokens.counts)
    new = np.concatenate([[True], (np.diff(hit) != 1) | (tags[hit[1:]] == BEGIN) | (text[hit[1:]] != text[hit[:-1]])])
    first = hit[new]
    last = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        d = int(text[i])
        s, e, lo, hi = int(tokens.starts[i]), int(tokens.ends[j]), int(c.offsets[d]), int(c.offsets[d + 1])
        while e < hi and c.data[e] == 0x3D and e - int(tokens.ends[j]) < 2:
            e += 1
        start = int(np.count_nonzero((c.data[lo:s] & 0xC0) != 0x80))
        end = start + int(np.count_nonzero((c.data[s:e] & 0xC0) != 0x80))
        if not any(x < end and start < y for x, _, y, _ in base[d]):
            out[d].append((start, KINDS.index("crf"), end))
    return [sorted(x) for x in out]


def find_secrets(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: array of ``kind, start, end, value`` by start, then kind."""
    ship_package(docs.sparkSession)
    schema = T.StructType().add("doc_id", docs.schema[id_col].dataType).add(
        "spans", T.ArrayType(T.StructType.fromDDL("kind string, start long, end long, value string")))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column(1)):
                texts = [t or "" for t in b.column(1).slice(c.lo, c.n).to_pylist()]
                found = [[{"kind": KINDS[k], "start": s, "end": e, "value": t[s:e]} for s, k, e in spans]
                         for t, spans in zip(texts, chunk_spans(c, texts, field), strict=True)]
                yield pa.record_batch([b.column(0).slice(c.lo, c.n), pa.array(found, span)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the pattern spans, and all spans as text."""
    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", *(of(k) for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
