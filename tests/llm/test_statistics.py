import numpy as np
import pyarrow as pa
import pytest

from stopwise.llm import quality, queries, textkernel as tk, weak_rules
from stopwise.llm.docstats import chunk_stats

from ..conftest import SF_SMALL
from . import brute

TEXTS = ["", None, "a b c d e a b c d e", "Same line here\nSame line here\n\nother\nSame line here", "é ü ß 語 ok", "x\ty\x0bz\rq", " \n\t ",
         "# * $ % & | < >", "UP UP UP! low", "w " * 300, "one\n" * 40, "  lead\n  lead\nlead", "a b c"]


def test_statistics_equal_brute_force():
    for limit in (8, 1 << 20):
        got = {}
        for c in tk.chunks(pa.array(TEXTS), limit):
            for k, v in chunk_stats(c).items():
                got.setdefault(k, []).extend(v.tolist())
        for i, text in enumerate(TEXTS):
            want = brute.stats(text)
            assert {k: got[k][i] for k in want} == want, text


def test_weak_rules_query(spark):
    got = {r.doc_id: r for r in queries.op4_weak_rules(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = brute.stats(d.text)
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert {k: got[d.doc_id][k] for k in want} == want and got[d.doc_id].base_failed == failed
        assert not (failed and got[d.doc_id].kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    good = [got[i].kept for i, q in labels.items() if q == 1 and not got[i].base_failed]
    bad = [got[i].kept for i, q in labels.items() if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1


def test_em_recovers_rates():
    rng = np.random.default_rng(1)
    n = 20000
    good = rng.random(n) < 0.8
    rates = np.array([[0.6, 0.01], [0.5, 0.02], [0.1, 0.9]])
    fired = rng.random((n, 3)) < np.where(good[:, None], rates[:, 1], rates[:, 0])
    votes = fired * np.array([-1, -1, 1])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = weak_rules.expectation_maximisation(patterns, counts)
    odds = np.log(m.prior / (1 - m.prior)) + m.log_odds()[np.arange(3), (votes != 0).astype(int)].sum(1)
    assert ((odds > 0) == good).mean() > 0.93
    assert (m.log_odds()[:2, 1] < 0).all() and m.log_odds()[2, 1] > 0


def test_rules_on_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, row string, p_good double"
    rows = weak_rules.judge(weak_rules.statistics(spark.createDataFrame([(1, None, "r", 0.0), (1, None, "r", 0.0), (None, "plain words here. and more of them.", "x", 1.0)], schema))).collect()
    assert len(rows) == 3 and sorted(r.n_words for r in rows) == [0, 0, 7]
    assert weak_rules.judge(weak_rules.statistics(spark.createDataFrame([], schema))).count() == 0


def test_quality_held_out(spark):
    got = queries.op1_quality_discriminant(spark, SF_SMALL).toPandas()
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    assert len(got) == got.doc_id.nunique() and got.score.between(0, 1).all()
    assert (both.predicted == both.quality).mean() > 0.95


def test_quality_edges(spark):
    schema = "doc_id long, text string, features string"
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "Some plain words. And more.", "c"), (2, "", "b")], schema)
    feats = quality.featurize(docs)
    assert feats.count() == 4
    none = quality.train(feats, spark.createDataFrame([], "doc_id long, quality int"))
    one = quality.train(feats, spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int"))
    for model in (none, one):
        scores = [r.score for r in quality.score(feats, model).collect()]
        assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert quality.keep(docs, one, 0.3).columns == docs.columns
    assert quality.featurize(spark.createDataFrame([], schema)).count() == 0


def test_discriminant_prefers_its_class():
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    a, b = rng.normal(0, 1, (500, d)), rng.normal(0.8, 0.3, (500, d))
    sums = {k: (float(len(x)), x.sum(0), x.T @ x) for k, x in ((0, a), (1, b))}
    m = quality.fit(sums)
    assert (m.difference(a) < 0).mean() > 0.9 and (m.difference(b) > 0).mean() > 0.9
    inv = [np.linalg.inv(f @ f.T) for f in m.factors]
    q = [-0.5 * np.einsum("ij,jk,ik->i", a - m.means[k], inv[k], a - m.means[k]) + m.constants[k] for k in (0, 1)]
    assert np.allclose(q[1] - q[0], m.difference(a))


@pytest.mark.parametrize("text", ["a" * 3_000_000, "word " * 400_000])
def test_very_long_texts_are_whole(text):
    (c,) = tk.chunks(pa.array([text]), 1024)
    s = chunk_stats(c)
    assert s["word_chars"][0] == len(text.replace(" ", "")) and s["n_words"][0] == len(text.split())
