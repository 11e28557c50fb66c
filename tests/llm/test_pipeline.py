import random

import corpus_pipeline
from stopwise.llm import stages

from ..conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


def test_stages_run_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stages.stored(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == columns and 0 < docs.count() <= rows
        rows = docs.count()
        if name == "quality":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            assert all((i in kept) == (q == 1) for i, q in labels.items())
    mixed = stages.stored(stages.mix_sources(spark, docs, SF_SMALL), "mix")
    assert mixed.columns == columns
    shards = stages.shard(spark, mixed, SF_SMALL)
    assert shards.count() == mixed.count()


def test_stages_on_odd_rows(spark):
    good = "A plain text of some ordinary words. It goes on for a while, then it ends. " * 2
    rows = [(1, good, "en", "a", 1, "x"), (1, good, "en", "a", 1, "x"), (2, good, "en", "b", 1, "x"), (None, good + " more", None, None, None, None),
            (None, None, None, None, None, None), (3, "", "en", "a", 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = stages.drop_near_copies(spark, docs, SF_SMALL).collect()
    assert sorted((r.doc_id or -1) for r in left) in ([-1, 1, 3], [-1, -1, 1, 3])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        stage(spark, docs, SF_SMALL).collect()


def test_near_copies_with_null_and_repeated_ids(spark):
    """Groups are those of the texts, whatever the ids: one row of each is left, that with the smallest id (null last)."""
    rng = random.Random(11)
    rows = []
    for g in range(40):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(rng.choice((1, 1, 2, 3))):
            text = list(base)
            if rng.random() < 0.7:
                text[-1] = f"x{rng.randrange(10**6)}"      # 55 of 57 shingles are common
            rows.append((rng.choice((None, None, 1, 2, g)), " ".join(text), "en", "a", 1, str(g)))
    rows.append((1, rows[0][1], "en", "a", 1, "0"))
    docs = spark.createDataFrame(rows, SCHEMA)
    left = stages.drop_near_copies(spark, docs, SF_SMALL).collect()
    want = {}
    for i, _, _, _, _, g in rows:
        want[g] = min(want.get(g, (True, 0)), (i is None, i or 0))
    assert sorted((r.row, (r.doc_id is None, r.doc_id or 0)) for r in left) == sorted(want.items())
