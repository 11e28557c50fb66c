"""Token counts by dynamic programming over a shared trie.

A unigram vocabulary gives every piece a score; a word's tokens are the pieces of the
segmentation with the largest total score. The words of a chunk of documents are reduced to
the distinct ones and sorted, so that they form a trie: a node is a distinct prefix. Forward
scores (best total score and its token count) are computed once per node, level by level;
words that share a prefix share its work. A word's count is stored at its last node and
added up per document.

Pre-tokens are maximal runs of non-space bytes, preceded by the vocabulary's word mark.
Matching is on UTF-8 bytes; a byte that no piece covers is a token of its own with
``UNKNOWN`` as score (byte fallback). Among equal scores the segmentation with the longer
last piece wins.

Defined results: a null or empty text has 0 tokens; equal rows are counted alike; words of
any length are processed whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import ship_package

MARK = "▁".encode()
UNKNOWN = -30.0
CHUNK = 4 << 20
LONG_WORD, LONG_BLOCK = 512, 1 << 16
_A = 0x9E3779B97F4A7C15


@dataclass
class Vocabulary:
    """Pieces by the hash of their bytes (sorted), with scores; ``longest`` in bytes."""
    keys: np.ndarray
    scores: np.ndarray
    longest: int

    @classmethod
    def of(cls, pieces: dict[bytes, float]) -> Vocabulary:
        h = np.array([piece_hash(p) for p in pieces], np.uint64)
        order = np.argsort(h)
        keys = h[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        return cls(keys, np.array(list(pieces.values()))[order], max(map(len, pieces), default=0))

    def score(self, h: np.ndarray) -> np.ndarray:
        """Score of each hashed byte string, -inf where it is no piece."""
        if not len(self.keys):
            return np.full(len(h), -np.inf)
        i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[i] == h, self.scores[i], -np.inf)


def piece_hash(p: bytes) -> int:
    """Hash of a byte string that can grow at the front: sum of T[b_j] A^(distance from the end), then mixed."""
    acc = 0
    for b in p:
        acc = (acc * _A + int(tk._BYTE[b])) % 2**64
    return int(tk.mix(np.array([acc], np.uint64) + np.uint64(len(p)))[0])


def read_pieces(model_file: str) -> dict[bytes, float]:
    """Pieces and scores of a sentencepiece model; byte pieces stand for their byte.

    A merge-ranked model gives minus the rank as score; ranks become log probabilities of a
    Zipf law, so that fewer and more common pieces win."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    out: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i):
            continue
        out[sp.id_to_piece(i).encode()] = -float(np.log(i + 2.0)) - 2.0
    return out


def _levels(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by their bytes, and the length of the prefix each shares with the one before."""
    width = int(lengths.max(initial=0))
    wide = np.zeros((len(starts), width), np.uint8)
    inside = np.arange(width) < lengths[:, None]
    wide[inside] = words[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]
    keys = np.ascontiguousarray(wide).view(f"S{max(width, 1)}").ravel() if width else np.zeros(len(starts), "S1")
    order = np.argsort(keys, kind="stable")
    w, n = wide[order], lengths[order]
    differ = w[1:] != w[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width) if width else np.zeros(max(len(w) - 1, 0), np.int64)
    return order, np.concatenate([[0], np.minimum(common, np.minimum(n[1:], n[:-1]))]).astype(np.int64)


def count_tokens(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Tokens of each distinct byte word (word mark included in the bytes)."""
    if not len(starts):
        return np.empty(0, np.int64)
    order, shared = _levels(buffer, starts, lengths)
    s, n = starts[order], lengths[order]
    longest = int(n.max())
    # node[w, d]: trie node of word w's prefix of d bytes; best and tokens are per node.
    best_of: list[np.ndarray] = [np.zeros(1)]
    tokens_of: list[np.ndarray] = [np.zeros(1, np.int64)]
    node_of: list[np.ndarray] = [np.zeros(len(s), np.int64)]
    out = np.zeros(len(s), np.int64)
    for d in range(1, longest + 1):
        has = n >= d
        # A word starts a new node of this level if it shares fewer than d bytes with the word before.
        new = has & (shared < d)
        number = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        best = np.full(len(first), -np.inf)
        count = np.zeros(len(first), np.int64)
        acc, power = np.zeros(len(first), np.uint64), 1
        for k in range(1, min(d, vocab.longest) + 1):
            # The piece of k bytes that ends at depth d: its hash grows by one byte at the front.
            acc = acc + tk._BYTE[buffer[s[first] + d - k]] * np.uint64(power)
            power = power * _A % 2**64
            value = vocab.score(tk.mix(acc + np.uint64(k)))
            if k == 1:
                value = np.maximum(value, UNKNOWN)
            above = node_of[d - k][first]
            total = best_of[d - k][above] + value
            better = total >= best
            best = np.where(better, total, best)
            count = np.where(better, tokens_of[d - k][above] + 1, count)
        best_of.append(best)
        tokens_of.append(count)
        node_of.append(number)
        ends = np.flatnonzero(n == d)
        out[ends] = count[number[ends]]
        if d - vocab.longest >= 0:        # no later piece reaches further back
            node_of[d - vocab.longest] = best_of[d - vocab.longest] = tokens_of[d - vocab.longest] = np.empty(0)
    result = np.empty(len(s), np.int64)
    result[order] = out
    return result


def count_long(word: np.ndarray, vocab: Vocabulary) -> int:
    """Tokens of one long byte word: the pieces that end at each byte are looked up for ``LONG_BLOCK`` bytes at a time, then one
    forward pass goes over those that exist. The same scores, sums and ties as on the trie."""
    best, tokens = [0.0], [0]
    for lo in range(0, len(word), LONG_BLOCK):
        ends = np.arange(lo, min(lo + LONG_BLOCK, len(word)))
        acc, power = np.zeros(len(ends), np.uint64), 1
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(1, vocab.longest + 1):
            inside = ends - k + 1 >= 0
            acc = acc + np.where(inside, tk._BYTE[word[np.maximum(ends - k + 1, 0)]], np.uint64(0)) * np.uint64(power)
            power = power * _A % 2**64
            value = vocab.score(tk.mix(acc + np.uint64(k)))
            if k == 1:
                value = np.maximum(value, UNKNOWN)
            at = np.flatnonzero(inside & (value > -np.inf))
            found.append((at, np.full(len(at), k), value[at]))
        at, size, value = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((size, at))
        pieces = zip(at[order].tolist(), size[order].tolist(), value[order].tolist(), strict=True)
        here, top, count = 0, -np.inf, 0
        for i, k, v in pieces:
            if i != here:
                best.append(top)
                tokens.append(count)
                here, top, count = i, -np.inf, 0
            total = best[lo + i + 1 - k] + v
            if total >= top:
                top, count = total, tokens[lo + i + 1 - k] + 1
        best.append(top)
        tokens.append(count)
    return tokens[-1]


def chunk_counts(c: tk.Chunk, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(words, tokens) of each text of a chunk."""
    starts, ends = c.runs(tk.NON_SPACE)
    h = c.span_hashes(starts, ends)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    s, n = starts[first], (ends - starts)[first]
    # Distinct words with their mark in a buffer of their own.
    m = len(MARK)
    offs = np.cumsum(n + m) - (n + m)
    buffer = np.empty(int((n + m).sum()), np.uint8)
    for i in range(m):
        buffer[offs + i] = MARK[i]
    rows = np.arange(int(n.sum()))
    back = np.repeat(np.cumsum(n) - n, n)
    buffer[np.repeat(offs + m, n) + rows - back] = c.data[np.repeat(s, n) + rows - back]
    tokens = np.empty(len(s), np.int64)
    # Words of like length share a table; a very long word goes on its own.
    size = n + m
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        tokens[i] = count_long(buffer[offs[i]: offs[i] + size[i]], vocab)
    band = np.maximum(np.ceil(np.log2(size)).astype(np.int64), 5) if len(size) else size
    for b in np.unique(band):
        at = np.flatnonzero((band == b) & (size <= LONG_WORD))
        tokens[at] = count_tokens(buffer, offs[at], size[at], vocab)
    words = c.per_text(starts)
    total = np.concatenate([[0], np.cumsum(tokens[inverse])])
    end = np.cumsum(words)
    return words, total[end] - total[end - words]


def token_counts(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row; the vocabulary (fixed size) is broadcast."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column("text"), CHUNK):
                words, tokens = chunk_counts(c, shared.value)
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(c.lo, c.n), "n_words": pa.array(words.astype(np.int64)), "n_tokens": pa.array(tokens)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
