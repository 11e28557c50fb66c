"""Whole-text statistics of documents, computed for a chunk at a time.

Definitions (null text = empty text, all counts 0): words are ``[^\\x20\\x09-\\x0D]+``;
``word_chars`` code points in words; ``n_symbols`` characters of ``[#*$%&|<>]``;
``n_dup_lines`` ``\\n``-split lines that hold a word and equal an earlier line of the
text; ``n_repeat_words`` words inside a 5-word window that occurs twice or more in the
text, its first occurrence included.
"""

from __future__ import annotations

import numpy as np

from . import textkernel as tk

SYMBOLS = np.zeros(256, np.int8)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
CODE_POINT = np.ones(256, np.int8)
CODE_POINT[0x80:0xC0] = 0                # continuation bytes
UPPER = np.zeros(256, np.int8)
UPPER[0x41:0x5B] = 1
LETTER = np.zeros(256, np.int8)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0xC0:] = 1
DIGIT = np.zeros(256, np.int8)
DIGIT[0x30:0x3A] = 1
STOP = np.zeros(256, np.int8)
STOP[[ord(c) for c in ".!?"]] = 1
SHOUT = np.zeros(256, np.int8)
SHOUT[ord("!")] = 1
PUNCT = np.zeros(256, np.int8)
PUNCT[0x21:0x30] = PUNCT[0x3A:0x41] = PUNCT[0x5B:0x61] = PUNCT[0x7B:0x7F] = 1
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False


def _repeated(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for entries whose (group, hash) occurs twice or more."""
    order = np.lexsort((h, group))
    g, x = group[order], h[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (g[1:] == g[:-1]) & (x[1:] == x[:-1])
    out = np.zeros(len(h), bool)
    out[order] = same[1:] | same[:-1]
    return out


def chunk_stats(c: tk.Chunk) -> dict[str, np.ndarray]:
    """One entry per text of the chunk for each statistic."""
    starts, ends = c.runs(tk.NON_SPACE)
    counts = c.per_text(starts)
    first = np.concatenate([[0], np.cumsum(counts)])
    h = c.span_hashes(starts, ends)
    word_chars = c.spans_of(CODE_POINT, starts, ends)
    owner = np.repeat(np.arange(c.n), counts)

    def per_text(values: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return s[first[1:]] - s[first[:-1]]

    # 5-word windows found twice or more in the same text cover their words.
    n_windows = max(len(h) - 4, 0)
    inside = tk.text_windows(counts, 5)[:n_windows]
    at = np.flatnonzero(inside)
    twice = at[_repeated(owner[at], tk.shingles(h, 5)[at])] if len(at) else at
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 5, -1)
    repeat = np.cumsum(cover)[:-1] > 0

    # Lines with a word that equal an earlier line of the same text.
    ls, le = c.runs(NOT_NEWLINE)
    with_word = c.spans_of(tk.NON_SPACE.astype(np.int8), ls, le) > 0
    ls, le = ls[with_word], le[with_word]
    lh, lo = c.span_hashes(ls, le), c.owner(ls)
    order = np.lexsort((ls, lh, lo))
    dup = np.zeros(len(ls), bool)
    dup[1:] = (lo[order][1:] == lo[order][:-1]) & (lh[order][1:] == lh[order][:-1])
    n_dup = np.bincount(lo[order][dup], minlength=c.n)

    # Words that only repeat the word before them.
    echo = np.zeros(len(h), bool)
    echo[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    upper, letters = c.spans_of(UPPER, starts, ends), c.spans_of(LETTER, starts, ends)
    # Distinct words of each text.
    order = np.lexsort((h, owner))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return {
        "n_words": counts.astype(np.int64), "word_chars": per_text(word_chars), "n_symbols": c.totals(SYMBOLS),
        "n_dup_lines": n_dup.astype(np.int64), "n_repeat_words": per_text(repeat), "n_lines": np.bincount(lo, minlength=c.n),
        "n_upper_words": per_text((letters > 0) & (upper * 2 > letters)), "n_echo_words": per_text(echo),
        "n_distinct_words": np.bincount(owner[order][new], minlength=c.n), "n_letters": c.totals(LETTER),
        "n_digits": c.totals(DIGIT), "n_stops": c.totals(STOP), "n_shouts": c.totals(SHOUT), "n_punct": c.totals(PUNCT),
        "n_code_points": c.totals(CODE_POINT),
    }
