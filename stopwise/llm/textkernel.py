"""Vectorised text helpers used inside Arrow tasks.

A chunk of texts is one byte buffer with offsets. Words are maximal runs of "word" bytes
(a 256-entry table) inside one text; a word's 64-bit hash comes from one prefix sum over
the buffer, so no Python object is made per word.

Nulls count as empty texts. Texts are always processed whole: a chunk ends at a text
border, and a text larger than the chunk size is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C55)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
CHUNK_BYTES = 1 << 20

# Word classes of the contracts.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NON_SPACE = ~SPACE                       # [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, bool)              # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _BYTE[0x61:0x7B]

_powers: list[np.ndarray] = []


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i (mod 2^64) for i < n; kept per process and grown on demand."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        fwd, inv = np.empty(size, np.uint64), np.empty(size, np.uint64)
        fwd[0] = inv[0] = 1
        fwd[1:], inv[1:] = _P, _P_INV
        _powers[:] = [np.multiply.accumulate(fwd), np.multiply.accumulate(inv)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Chunk:
    """Consecutive rows ``lo .. hi`` of a batch: bytes and per-text offsets."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets
        self.n = hi - lo

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Index (within the chunk) of the text that holds each byte position."""
        return np.searchsorted(self.offsets, positions, "right") - 1

    def per_text(self, positions: np.ndarray) -> np.ndarray:
        """How many of the sorted byte positions each text holds."""
        return np.diff(np.searchsorted(positions, self.offsets))

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of table bytes, never across texts."""
        w = table[self.data]
        before, after = np.empty_like(w), np.empty_like(w)
        if not len(w):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        before[1:], after[:-1] = w[:-1], w[1:]
        before[0] = after[-1] = False
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(w))]
        before[inner] = False
        after[inner - 1] = False
        return np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
        """64-bit hash of each byte span; ``fold`` makes A-Z equal to a-z."""
        fwd, inv = _pow_tables(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((_FOLDED if fold else _BYTE)[self.data] * fwd[: len(self.data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64))

    def spans_of(self, lut: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sum of a per-byte table over each span."""
        c = np.empty(len(self.data) + 1, np.int64)
        c[0] = 0
        np.cumsum(lut[self.data], out=c[1:], dtype=np.int64)
        return c[ends] - c[starts]

    def totals(self, lut: np.ndarray) -> np.ndarray:
        """Sum of a per-byte table over each text."""
        return self.spans_of(lut, self.offsets[:-1], self.offsets[1:])


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of about ``limit`` bytes at text borders."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi, data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])
        lo = hi


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (one per start position)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= np.uint64(0xD6E8FEB86659FD93)
        acc += h[i: i + n]
    return mix(acc)


def text_windows(counts: np.ndarray, k: int) -> np.ndarray:
    """True where a k-word window that starts at this word stays inside its text."""
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(int(counts.sum()))
    return left >= k
