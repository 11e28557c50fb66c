import random

from stopwise.llm import phrase_index

from . import brute

SCHEMA = "doc_id long, text string, items string"


def corpus():
    rng = random.Random(4)
    vocab = ["the", "of", "AND", "é", "x1", "long-word", "Rare", "tail"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((20, 13, 14, 5, 1, 40))] + [(90, None), (91, "  .. "), (92, "the the the")]
    docs = []
    for i in range(60):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            w = brute.alnum_words(items[rng.randrange(6)][1])
            at = rng.randrange(max(1, len(w) - 5))
            body[5:5] = w[at: at + rng.randrange(3, 30)]
        docs.append((i, ", ".join(body).upper() if i % 7 == 0 else "\n".join(body)))
    return docs + [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[5][1])], items


def test_contamination_equals_brute_force(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(phrase_index, "SEGMENT_BYTES", 300)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    index = phrase_index.build_index(d)
    want = sorted((i or -1, *brute.hits(t, items)) for i, t in docs)
    for block_words in (30, 10**6):
        found = phrase_index.phrase_matches(index, b, block_words=block_words)
        got = sorted((r.doc_id or -1, r.n_words, r.n_hit, r["items"]) for r in phrase_index.contamination(index, found).collect())
        assert got == want


def test_items_without_id_hit(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, "x y"), (3, "a b y"), (4, "z")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "a b"), (None, "b c"), (7, "y")], "item_id long, text string")
    index = phrase_index.build_index(d)
    got = sorted((r.doc_id, r.n_hit, r["items"], r.n_items, r.contaminated) for r in phrase_index.contamination(index, phrase_index.phrase_matches(index, b)).collect())
    assert got == [(1, 3, [], 1, True), (2, 1, ["7"], 1, True), (3, 3, ["7"], 2, True), (4, 0, [], 0, False)]


def test_proximity(spark):
    docs = [(1, "alpha x x beta"), (2, "beta alpha"), (3, "alpha " + "x " * 9 + "beta"), (4, "alpha"), (5, "beta")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, "Alpha beta")], "item_id long, text string")
    index = phrase_index.build_index(d)
    for slop, want in ((1, {2}), (3, {1, 2}), (20, {1, 2, 3})):
        assert {r.doc_id for r in phrase_index.proximity_matches(index, b, slop).collect()} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    index = phrase_index.build_index(none)
    assert phrase_index.contamination(index, phrase_index.phrase_matches(index, items)).count() == 0
    index = phrase_index.build_index(some)
    (r,) = phrase_index.contamination(index, phrase_index.phrase_matches(index, items)).collect()
    assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (2, 0, [], False)
