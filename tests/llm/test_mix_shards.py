import zlib

import pytest

from stopwise.llm import curriculum, kd_shards

SCHEMA = "doc_id long, text string, lang string, source string, size string, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, "clash", 5) for i, t, la, s in rows], SCHEMA)


def test_mix_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 7)
    rows = [(i, "w " * (i % 13 + 1), "en", "hot" if i % 3 else ("tiny" if i % 30 == 0 else None)) for i in range(300)] + [(None, None, None, "hot"), (5, "", "en", "empty"), (7, "a b", "de", "b"), (7, "a b", "de", "b")]
    docs = table(spark, rows)
    sizes = curriculum.document_sizes(docs)
    placed = curriculum.placed(sizes, curriculum.source_weights(sizes))
    got = curriculum.taken(placed).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    per = {}
    for r in placed.select("source", "target", "source_size", "gives").collect():
        t = per.setdefault(r.source, [r.target, r.source_size, 0])
        t[2] += sum(r.gives)
    total = sum(t[1] for t in per.values())
    assert abs(sum(t[0] for t in per.values()) - total) < 1e-6 * total
    for target, size, taken in per.values():
        assert target <= 3 * size and abs(taken - target) < 1
    names = sorted((s for s in per if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    free = [(s, t) for s, t in per.items() if t[0] < 3 * t[1] - 1e-9]
    rate = {round(t[0] / weight[s], 6) for s, t in free}
    assert len(rate) == 1 and all(3 * t[1] <= weight[s] * max(rate) + 1e-6 for s, t in per.items() if s not in dict(free))
    order = [(r.position, r.words) for r in curriculum.copies(placed).collect()]
    assert [p for p, _ in order] == sorted(p for p, _ in order) and all(0 <= p <= 1 for p, _ in order)
    assert sum(w for _, w in order) == sum(r.taken for r in got)


def test_taken_words_are_those_of_the_scheduled_copies(spark, monkeypatch):
    """What ``taken`` gives follows the positioned copies, row by row for null and repeated ids."""
    rows = [(i if i % 4 else None, "w " * (i % 5 + 1), "en", f"s{i % 3}") for i in range(60)] + [(7, "a b", "de", "s1")] * 3
    sizes = curriculum.document_sizes(table(spark, rows))
    placed = curriculum.stored(curriculum.placed(sizes, curriculum.source_weights(sizes)), "placed")
    whole = curriculum.copies
    monkeypatch.setattr(curriculum, "copies", lambda p: whole(p).where("position < 0.5"))
    want = {}
    for r in whole(placed).collect():
        if r.position < 0.5:
            want[r.row] = want.get(r.row, 0) + r.words
    got = curriculum.taken(placed).collect()
    want = [(r.doc_id or -1, r["size"], want.get(r.row, 0)) for r in placed.collect()]
    assert sorted((r.doc_id or -1, r["size"], r.taken) for r in got) == sorted(want)
    assert any(t == 0 for *_, t in want) and any(t > 0 for *_, t in want)


def test_positions_follow_the_schedule(spark):
    """An early source's copies lie before a late one's, by the integral of the weights."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(q / 10, [1.5, 1.0, 0.5], [0.0, 0.625, 1.0]) for q in range(11)], "q double, curve array<double>, demand array<double>")
    for r in df.withColumn("t", curriculum.time_of(F.col("q"), F.col("curve"), F.col("demand"))).collect():
        assert abs(1.5 * r.t - 0.5 * r.t * r.t - r.q) < 1e-9      # integral of 1.5 - t


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "", "en", "a"), (2, None, "en", "b")]])
def test_mix_without_words(spark, rows):
    sizes = curriculum.document_sizes(table(spark, rows))
    got = curriculum.taken(curriculum.placed(sizes, curriculum.source_weights(sizes))).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0)] * len(rows)


def test_shards_are_near_equal_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_ROWS", 5)
    monkeypatch.setattr(kd_shards, "BINS", 16)
    rows = [(i * 7919 % 1000, "é" * (i % 50 + 20), "en" if i % 4 else None, f"s{i % 5}" if i % 3 else "hot") for i in range(600)] + [(3, "same", "de", "x")] * 300
    got = kd_shards.with_slots(kd_shards.assign(kd_shards.slim(table(spark, rows)), 11)).collect()
    assert len(got) == len(rows)
    size, slots = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(size) == set(range(11))
    mean = sum(size.values()) / 11
    assert all(abs(b - mean) < 250 for b in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _, _ in rows)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == want


def test_shards_of_little(spark):
    assert kd_shards.with_slots(kd_shards.assign(kd_shards.slim(table(spark, [])), 4)).count() == 0
    got = kd_shards.with_slots(kd_shards.assign(kd_shards.slim(table(spark, [(None, None, None, None), (1, "", "en", "a")])), 4)).collect()
    assert sorted(r["size"] for r in got) == [1, 1] and len({(r.shard, r.slot) for r in got}) == 2
    slim = kd_shards.slim(table(spark, [(1, "abc", "en", "a")]))
    assert kd_shards.shards_for(slim, 4) == 1 and kd_shards.shards_for(slim, 3) == 2
