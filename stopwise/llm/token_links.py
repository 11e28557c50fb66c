"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

A is a byte-level BPE file, B a piece model with byte fallback. Both read every text behind one
space. Where a token of A and a token of B end at the same byte, the text is cut; between two cuts
lies a group, and its last A and B tokens are linked.

*Segments.* Both vocabularies split a text wherever a space follows a character that is not white
space, so the tokens of a text are those of its segments, in order. (``Aligner`` checks that the piece
vocabulary has no piece that runs on across such a border; with one that has, whole texts are the
segments.) A chunk of texts is reduced to its distinct segments (by 64-bit hashes), which are tokenized and aligned once.

*Identity map.* ``same[a]`` is the B id with the bytes of A's token a, or -1. A group of one token on either
side with ``b == same[a]`` is regular: its link is told by ``a`` alone and is counted in a vector as
long as A's vocabulary, one per task. Only the links of irregular groups travel as pairs.

*Counts.* A task writes its documents, the distinct irregular pairs of each chunk with their
counts, and its vector. Pair counts are added up by pair; a chunk looks its pairs up by a join
that has one row per chunk and distinct pair, so a very common pair costs a row per chunk, and a
cogroup by chunk (at most ``CHUNK`` bytes of text, or one longer text) brings them to the documents.
The driver holds two vectors of vocabulary length, nothing that grows with the corpus.

Defined results: a null or empty text, and a text that one of the tokenizers does not give back byte
for byte, has no tokens: zeros, and '' for the digest. Repeated rows are counted each. Null and repeated ids are
kept as they are. Words and texts of any length are processed whole. An empty table gives no
rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as tk
from .shared import concat_runs, ship_package, stored

CHUNK = 2 << 20
JOINED = 1 << 16             # bytes of segments that are encoded as one string
KEPT_SEGMENTS = 200_000      # segments whose alignment a worker remembers; beyond that it starts anew


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Segments:
    """Aligned segments, as arrays over segments and, where it says so, end to end over their contents."""
    hashes: np.ndarray
    fits: np.ndarray             # both tokenizers give the bytes back
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    said: np.ndarray             # tokens in the order of the groups' text (4 * id + place in MARKS), end to end
    regular: np.ndarray          # A ids of regular links, end to end
    n_regular: np.ndarray
    irregular: np.ndarray        # pairs of irregular links, end to end
    n_irregular: np.ndarray

    @classmethod
    def none(cls) -> Segments:
        return cls(np.empty(0, np.uint64), np.empty(0, bool), *(np.empty(0, np.int64) for _ in range(8)))

    def plus(self, other: Segments) -> Segments:
        return Segments(*(np.concatenate([getattr(self, f.name), getattr(other, f.name)]) for f in fields(self)))


class Aligner:
    """Both tokenizers with their byte tables."""

    def __init__(self, a_json: str, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        letters = byte_of_letter()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        normal = {x: i for i, x in enumerate(self.b_bytes) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))}
        bytewise = {x: i for i, x in enumerate(self.b_bytes) if self.b.is_byte(i)}
        self.same = np.array([normal.get(x, bytewise.get(x, -1)) for x in self.a_bytes], np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lone_space = self.b.encode("a ")[len(self.b.encode("a")):]
        self.digits, self.digit_count = _decimals(max(len(self.a_bytes), len(self.b_bytes)))
        self.known = Segments.none()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """First byte of each segment; ``starts``: first byte of each text (each is a space)."""
        first = np.zeros(len(data), bool)
        if self.separable:
            first[1:] = (data[1:] == 0x20) & ~_SPACE[data[:-1]]
            # Letters behind these lead bytes may be white space of other scripts: no cut is made there.
            first[2:] &= data[:-2] != 0xC2
            first[3:] &= (data[:-3] < 0xE1) | (data[:-3] > 0xE3)
        first[starts] = True
        return np.flatnonzero(first)

    def _joins(self, segment: bytes) -> bool:
        """Whether another segment may follow this one in one string without changing the tokens of either."""
        return (self.separable and segment[-1] not in _SPACE_BYTES and (len(segment) < 2 or segment[-2] != 0xC2)
                and (len(segment) < 3 or not 0xE1 <= segment[-3] <= 0xE3) and b"\xe2\x96\x81" not in segment)

    def tokens(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``fits``, A ids end to end, their number per segment, the same for B; segments that do not fit have no tokens.

        Segments that may stand side by side are encoded as one string of up to ``JOINED`` bytes and cut again at their ends."""
        runs: list[list[int]] = []
        size = JOINED
        for i, s in enumerate(segments):
            joins = self._joins(s)
            if not joins or size + len(s) > JOINED:
                runs.append([i])
                size = len(s) if joins else JOINED
            else:
                runs[-1].append(i)
                size += len(s)
        while True:
            strings = [b"".join(segments[i] for i in r) for r in runs]
            texts = [s.decode(errors="replace") for s in strings]
            by_a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)] if texts else []
            by_b = self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []
            by_b = [self.lone_space if s == b" " else ids for s, ids in zip(strings, by_b, strict=True)]
            good = [b"".join(map(self.a_bytes.__getitem__, x)) == s == b"".join(map(self.b_bytes.__getitem__, y)) for s, x, y in zip(strings, by_a, by_b, strict=True)]
            if all(ok or len(r) == 1 for ok, r in zip(good, runs, strict=True)):
                break
            runs = [q for ok, r in zip(good, runs, strict=True) for q in ([r] if ok else [[i] for i in r])]    # find the segment that does not fit
        fits = np.zeros(len(segments), bool)
        order = [i for r in runs for i in r]
        if order != list(range(len(segments))):
            raise AssertionError("segments stay in order")
        fits[[i for ok, r in zip(good, runs, strict=True) if ok for i in r]] = True
        ends = np.cumsum(np.array([len(s) for s in segments], np.int64) * fits)
        out: list[np.ndarray] = [fits]
        for encoded, length in ((by_a, self.a_len), (by_b, self.b_len)):
            ids = np.fromiter(itertools.chain.from_iterable(x for x, ok in zip(encoded, good, strict=True) if ok), np.int64)
            out += [ids, np.diff(np.searchsorted(np.cumsum(length[ids]), ends, "right"), prepend=0)]
        return tuple(out)

    def align(self, segments: list[bytes], hashes: np.ndarray) -> Segments:
        fits, x, n_a, y, n_b = self.tokens(segments)
        k = len(segments)
        if not len(x):
            zero = np.zeros(k, np.int64)
            none = np.empty(0, np.int64)
            return Segments(hashes, fits, zero, zero, zero, none, none, zero, none, zero)
        # All segments end to end: token ends, and the cuts they share.
        ends_x, ends_y = np.cumsum(self.a_len[x]), np.cumsum(self.b_len[y])
        cuts = np.intersect1d(ends_x, ends_y, assume_unique=True)
        last_x, last_y = np.searchsorted(ends_x, cuts), np.searchsorted(ends_y, cuts)
        one = (np.diff(last_x, prepend=-1) == 1) & (np.diff(last_y, prepend=-1) == 1)
        a, b = x[last_x], y[last_y]
        regular = one & (self.same[a] == b)
        owner = np.searchsorted(np.cumsum(n_a), last_x, "right")
        # A group's text: its A tokens, then its B tokens, each with the mark that follows it.
        group_x, group_y = np.searchsorted(cuts, ends_x), np.searchsorted(cuts, ends_y)
        said = np.empty(len(x) + len(y), np.int64)
        at_x, at_y = np.arange(len(x)), np.arange(len(y))
        said[at_x + np.concatenate([[0], last_y[:-1] + 1])[group_x]] = 4 * x + (last_x[group_x] == at_x) * MARKS.index(b"|")
        said[at_y + (last_x + 1)[group_y]] = 4 * y + (last_y[group_y] == at_y) * MARKS.index(b";")
        return Segments(hashes, fits, n_a, n_b, np.bincount(owner, minlength=k), said, a[regular], np.bincount(owner[regular], minlength=k),
                        (a * len(self.b_bytes) + b)[~regular], np.bincount(owner[~regular], minlength=k))

    def lookup(self, hashes: np.ndarray, segment: Callable[[int], bytes]) -> tuple[Segments, np.ndarray]:
        """Aligned segments and where in them each asked hash stands; ``segment(i)`` gives the bytes of the i-th asked one."""
        if len(self.known.hashes) > KEPT_SEGMENTS:
            self.known = Segments.none()
        order = np.argsort(self.known.hashes)
        at = np.searchsorted(self.known.hashes, hashes, sorter=order)
        place = order[np.minimum(at, len(order) - 1)] if len(order) else np.zeros(len(hashes), np.int64)
        new = np.flatnonzero(self.known.hashes[place] != hashes) if len(order) else np.arange(len(hashes))
        place[new] = len(order) + np.arange(len(new))
        self.known = self.known.plus(self.align([segment(i) for i in new.tolist()], hashes[new]))
        return self.known, place


MARKS = b",|;"


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Left-aligned decimal digits of 0 .. n-1 with room for a mark, and how many digits each has."""
    width = len(str(n - 1))
    numbers = np.arange(n)
    count = np.searchsorted(10 ** np.arange(1, width), numbers, "right") + 1
    out = np.zeros((n, width + 1), np.uint8)
    for i in range(width):
        has = count > i
        out[has, i] = 48 + numbers[has] // 10 ** (count[has] - 1 - i) % 10
    return out, count


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_SPACE_BYTES = frozenset(np.flatnonzero(_SPACE).tolist())
_LOADED: dict[str, Aligner] = {}


def loaded(files: tuple[str, bytes]) -> Aligner:
    """One aligner per worker process and pair of files."""
    key = hashlib.sha1(files[0].encode() + files[1]).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Aligner(*files)
    return _LOADED[key]


def read_files(a_file: str, b_file: str) -> tuple[str, bytes]:
    """Both vocabulary files, read on the driver; their size does not depend on the corpus."""
    with open(a_file, encoding="utf-8") as f, open(b_file, "rb") as g:
        return f.read(), g.read()


# ---------------------------------------------------------------- one chunk

@dataclass
class ChunkLinks:
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digest: list[str]
    regular: np.ndarray          # A ids, text after text
    regular_ends: np.ndarray
    codes: np.ndarray            # places in ``pairs``, text after text
    codes_ends: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray


def link_chunk(c: tk.Chunk, aligner: Aligner) -> ChunkLinks:
    """Alignment of a chunk's texts."""
    starts = c.offsets[:-1] + np.arange(c.n)
    data = np.full(len(c.data) + c.n, 0x20, np.uint8)
    inner = np.ones(len(data), bool)
    inner[starts] = False
    data[inner] = c.data
    spaced = tk.Chunk(0, c.n, data, np.append(starts, len(data)))
    first = aligner.cuts(data, starts)
    end = np.append(first[1:], len(data))
    hashes, sample, which = np.unique(spaced.span_hashes(first, end), return_index=True, return_inverse=True)
    raw = data.tobytes()
    lo, hi = first[sample].tolist(), end[sample].tolist()
    known, place = aligner.lookup(hashes, lambda i: raw[lo[i]: hi[i]])
    which = place[which]
    per_text = np.diff(np.searchsorted(first, spaced.offsets))
    owner = np.repeat(np.arange(c.n), per_text)
    empty = np.diff(c.offsets) == 0
    empty |= np.bincount(owner[~known.fits[which]], minlength=c.n).astype(bool)
    live = ~empty[owner]
    n_a, n_b, n_groups = (np.bincount(owner, x[which] * live, c.n).astype(np.int64) for x in (known.n_a, known.n_b, known.n_groups))

    def gathered(flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        take = n[which] * live
        return flat[concat_runs((np.cumsum(n) - n)[which], take)], np.cumsum(np.bincount(owner, take, c.n).astype(np.int64))

    said, said_ends = gathered(known.said, known.n_a + known.n_b)
    digits = aligner.digits[said >> 2]
    size = aligner.digit_count[said >> 2]
    digits[np.arange(len(said)), size] = np.frombuffer(MARKS, np.uint8)[said & 3]
    text = digits[np.arange(digits.shape[1]) <= size[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(size + 1)])[said_ends].tolist()
    digest = ["" if e else hashlib.sha256(text[x: y - 1]).hexdigest() for e, x, y in zip(empty.tolist(), [0, *ends], ends, strict=False)]
    regular, regular_ends = gathered(known.regular, known.n_regular)
    pair, codes_ends = gathered(known.irregular, known.n_irregular)
    pairs, codes, counts = np.unique(pair, return_inverse=True, return_counts=True)
    return ChunkLinks(n_a, n_b, n_groups, digest, regular, regular_ends, codes, codes_ends, pairs, counts)


# ---------------------------------------------------------------- Spark

DOCUMENT, PAIRS, VECTOR = 0, 1, 2


def _lists(flat: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, kind))


def align_documents(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored alignment: rows of ``kind`` DOCUMENT (one per document), PAIRS (one per chunk), VECTOR (one per task)."""
    spark = docs.sparkSession
    ship_package(spark)
    files = spark.sparkContext.broadcast(read_files(a_file, b_file))
    id_type = docs.schema[id_col].dataType
    schema = T.StructType.fromDDL("kind int, chunk long, n_a long, n_b long, n_groups long, groups_sha256 string, regular array<int>, "
                                  "irregular array<int>, keys array<long>, counts array<long>").add("doc_id", id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(files.value)
        vector = np.zeros(len(aligner.a_bytes), np.int64)
        chunk = TaskContext.get().partitionId() << 32
        kind: pa.DataType | None = None

        def row(what: int, name: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            one, none = np.array([len(keys)]), np.zeros(1, np.int64)
            zero = pa.array([0], pa.int64())
            return pa.record_batch([pa.array([what], pa.int32()), pa.array([name], pa.int64()), zero, zero, zero, pa.array([""]),
                                    _lists(none[:0], none, pa.int32()), _lists(none[:0], none, pa.int32()),
                                    _lists(keys, one, pa.int64()), _lists(counts, one, pa.int64()), pa.nulls(1, kind)], names=schema.names)

        for b in batches:
            ids, texts = b.column(0), b.column(1)
            kind = ids.type
            for c in tk.chunks(texts, CHUNK):
                x = link_chunk(c, aligner)
                vector += np.bincount(x.regular, minlength=len(vector))
                none = np.zeros(c.n, np.int64)
                yield pa.record_batch([pa.array(np.full(c.n, DOCUMENT), pa.int32()), pa.array(np.full(c.n, chunk), pa.int64()),
                                       pa.array(x.n_a), pa.array(x.n_b), pa.array(x.n_groups), pa.array(x.digest, pa.string()),
                                       _lists(x.regular, x.regular_ends, pa.int32()), _lists(x.codes, x.codes_ends, pa.int32()),
                                       _lists(none[:0], none, pa.int64()), _lists(none[:0], none, pa.int64()), ids.slice(c.lo, c.n)], names=schema.names)
                if len(x.pairs):
                    yield row(PAIRS, chunk, x.pairs, x.pair_counts)
                chunk += 1
        if kind is not None:
            used = np.flatnonzero(vector)
            yield row(VECTOR, -1, used, vector[used])

    return stored(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema), "token-links", "zstd")


def link_statistics(aligned: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Per document its counts, digest, and how common its links are (``n_best``, ``count_sum``)."""
    aligner = loaded(read_files(a_file, b_file))
    width, same = len(aligner.b_bytes), aligner.same

    def listed(kind: int) -> DataFrame:
        return (aligned.where(F.col("kind") == kind).select("chunk", F.posexplode(F.arrays_zip("keys", "counts")).alias("code", "kv"))
                .select("chunk", "code", F.col("kv.keys").alias("key"), F.col("kv.counts").alias("n")))

    vector, best = np.zeros(len(same), np.int64), np.zeros(width, np.int64)
    for key, n in listed(VECTOR).groupBy("key").agg(F.sum("n")).collect():          # at most A's vocabulary
        vector[key] = n
    pairs = listed(PAIRS)
    counts = stored(pairs.groupBy("key").agg(F.sum("n").alias("total")), "pair-counts")
    for key, n in counts.groupBy(F.col("key") % width).agg(F.max("total")).collect():   # at most B's vocabulary
        best[key] = n
    np.maximum.at(best, same[vector > 0], vector[vector > 0])
    regular_best = (vector > 0) & (vector == best[same])
    fields = aligned.schema["doc_id"].dataType
    schema = (T.StructType().add("doc_id", fields)
              .add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long").add("n_best", "long").add("count_sum", "long").add("groups_sha256", "string"))

    def finish(docs: pa.Table, found: pa.Table) -> pa.Table:
        code, key, total = (found[c].to_numpy() for c in ("code", "key", "total"))
        of = np.zeros(len(code), np.int64)
        top = np.zeros(len(code), bool)
        of[code] = total
        top[code] = total == best[key % width]

        def summed(column: str, values: np.ndarray) -> np.ndarray:
            lists = docs[column].combine_chunks()
            running = np.concatenate([[0], np.cumsum(values[lists.values.to_numpy(zero_copy_only=False)], dtype=np.int64)])
            offs = lists.offsets.to_numpy()
            return running[offs[1:]] - running[offs[:-1]]

        count_sum = summed("regular", vector) + summed("irregular", of)
        n_best = summed("regular", regular_best) + summed("irregular", top)
        out = [docs["doc_id"], docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_groups"], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), docs["groups_sha256"]]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out], names=schema.names)

    documents = aligned.where(F.col("kind") == DOCUMENT).select("chunk", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "regular", "irregular")
    looked = pairs.join(counts, "key").select(F.col("chunk").alias("of"), "code", "key", "total")
    return documents.groupBy("chunk").cogroup(looked.groupBy("of")).applyInArrow(finish, schema)
