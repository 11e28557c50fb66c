"""Tokenizer alignment against whole-text encoding and plain counting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from stopwise.llm import textkernel as tk
from stopwise.llm import token_links as tl
from stopwise.llm.queries import BYTE_FILE, MODEL_FILE
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, chunk string, kind int, counts string"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_FILE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=MODEL_FILE)


def letters():
    """Byte-level letters as the encoder itself shows them."""
    from tokenizers.pre_tokenizers import ByteLevel
    out = {}
    for cp in [*range(0x80), 0xA0, 0xFF, 0x100, 0x3FF, 0x7FF, 0x800, 0xFFF, 0x1000, 0x2028, 0x20AC, 0x3000, 0xFFFD, 0x10000, 0x10FFFF, 0x1F600, 0x40000, 0x80000, 0xC0000, 0x100000]:
        if 0xD800 <= cp < 0xE000:
            continue
        shown = "".join(p for p, _ in ByteLevel(add_prefix_space=False).pre_tokenize_str(chr(cp)))
        out.update(zip(shown, chr(cp).encode(), strict=True))
    return out


def plain(texts, tokenizers):
    """Rows by whole-text encoding: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    a, b = tokenizers
    to_byte = tl.byte_of_letter()
    a_piece = {i: bytes(to_byte[c] for c in p) for p, i in a.get_vocab().items() if all(c in to_byte for c in p)}
    b_piece = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    parts, links = [], Counter()
    for t in texts:
        if not t:
            parts.append(None)
            continue
        x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        raw = (" " + t).encode()
        if b"".join(a_piece[i] for i in x) != raw or b"".join(b_piece[i] for i in y) != raw:
            parts.append(None)
            continue
        ends_x, ends_y = np.cumsum([len(a_piece[i]) for i in x]).tolist(), np.cumsum([len(b_piece[i]) for i in y]).tolist()
        shared = sorted(set(ends_x) & set(ends_y))
        groups, lo = [], 0
        for cut in shared:
            groups.append(([i for i, e in zip(x, ends_x, strict=True) if lo < e <= cut], [i for i, e in zip(y, ends_y, strict=True) if lo < e <= cut]))
            lo = cut
        pairs = [(i, j) for i, e in zip(x, ends_x, strict=True) if e in set(ends_y) for j, f in zip(y, ends_y, strict=True) if e == f] if len(x) < 400 \
            else [(g[0][-1], g[1][-1]) for g in groups]
        links.update(pairs)
        parts.append((len(x), len(y), groups, pairs))
    top = defaultdict(int)
    for (_, j), n in links.items():
        top[j] = max(top[j], n)
    out = []
    for p in parts:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = p
        said = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((n_a, n_b, len(groups), len(pairs), sum(links[q] == top[q[1]] for q in pairs), sum(links[q] for q in pairs), hashlib.sha256(said.encode()).hexdigest()))
    return out


def linked(spark, texts, ids=None):
    df = spark.createDataFrame([(i, t, "c", 7, "n") for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)
    got = tl.link_statistics(tl.align_documents(df, BYTE_FILE, MODEL_FILE), BYTE_FILE, MODEL_FILE)
    return got.collect()


def odd_texts(n, seed):
    rng = random.Random(seed)
    words = ["the", "cat", "don't", "we'll", "Wörter", "naïve", "été", "1234567", "3.14", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "日本語", "テキスト", "x" * 50,
             "foo_bar", "http://a.b/c?d=e", "😀", "👩‍👩‍👧", "ﬁ", "½", "à", " ", " ", "　", " ", "\x1c", "\x85", "'s", "'", "...", "--", "́", "Ġ", "ĠĊ"]
    gaps = [" ", " ", " ", "  ", "   ", "\n", "\n\n", " \n ", "\t", "", "\r\n", "  ", "\x0b"]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 30)))
        out.append(rng.choice(["", "", " ", "  ", "\n"]) + t + rng.choice(["", "", " ", "  ", "\n "]))
    return out


def test_equals_whole_texts(spark, tokenizers):
    texts = [None, "", " ", "  ", "\n", "a", "a ", " a", "a▁b", "▁", "\x00", *odd_texts(250, 1), "y" * 3000 + " z", "same words here " * 40, *["same words here"] * 20]
    got = sorted(linked(spark, texts), key=lambda r: r.doc_id)
    want = plain(texts, tokenizers)
    assert [tuple(r)[1:] for r in got] == want
    assert sum(w[0] == 0 for w in want) < 30


def test_whole_table(spark, tokenizers):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in linked(spark, [r.text for r in rows], [r.doc_id for r in rows])}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows], tokenizers), strict=True))


def test_edges(spark):
    assert linked(spark, []) == []
    rows = linked(spark, [None, "", "one text", "one text"], [None, 3, 3, 3])
    assert Counter((r.doc_id, r.n_a) for r in rows) == {(None, 0): 1, (3, 0): 1, (3, 2): 2}
    assert {r.count_sum for r in rows if r.n_a} == {4} and {r.n_best for r in rows if r.n_a} == {2}


def test_byte_letters():
    ours = tl.byte_of_letter()
    assert sorted(ours.values()) == list(range(256))
    assert all(ours[c] == b for c, b in letters().items())


def test_regular_links_stay_out_of_the_pairs():
    """One-to-one groups of equal bytes are told by the A id alone."""
    import pyarrow as pa
    aligner = tl.loaded(tl.read_files(BYTE_FILE, MODEL_FILE))
    c = next(tk.chunks(pa.array(["the the of and unbelievableness"])))
    x = tl.link_chunk(c, aligner)
    assert len(x.regular) >= 4 and len(x.regular) + len(x.codes) == x.n_groups[0]
    assert (aligner.same[x.regular] >= 0).all()
    assert all(aligner.a_bytes[a] == aligner.b_bytes[aligner.same[a]] for a in x.regular)
    width = len(aligner.b_bytes)
    assert all(aligner.same[p // width] != p % width for p in x.pairs)


def test_a_vocabulary_with_pieces_across_words_keeps_whole_texts():
    aligner = tl.Aligner(*tl.read_files(BYTE_FILE, MODEL_FILE))
    aligner.separable = False
    data = np.frombuffer(b" a b c", np.uint8)
    assert aligner.cuts(data, np.array([0])).tolist() == [0]
