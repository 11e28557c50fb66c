"""Quality rules under weak supervision.

Each rule looks at whole-text statistics and either votes (junk rules vote bad, -1; prose
rules vote good, 1) or abstains (0). The votes of all documents are counted by pattern (at
most 2^rules patterns, whatever the corpus size), and expectation-maximisation over those
counts estimates how often each rule votes on good and on bad documents (its accuracy),
and the share of good documents. A document's posterior probability of being good then
decides, instead of "all rules must pass".

Defined results: a null or empty text has no words: every rate rule abstains; an empty
table gives an empty result; equal rows get equal verdicts; extra columns are ignored and not
returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .docstats import chunk_stats
from .shared import ship_package, stored

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_echo_words",
         "n_distinct_words", "n_shouts", "n_stops", "n_digits")


@dataclass(frozen=True)
class Rule:
    """Votes ``says`` (1 good, -1 bad) where the SQL condition holds, else abstains; null counts as abstaining."""
    name: str
    says: int
    when: str


RULES = (
    Rule("symbols", -1, "n_symbols >= 0.15 * n_words"),
    Rule("symbol_chars", -1, "n_symbols >= 0.02 * word_chars"),
    Rule("repeats", -1, "n_repeat_words > 0.20 * n_words"),
    Rule("same_lines", -1, "n_lines >= 4 and n_dup_lines >= 0.5 * n_lines"),
    Rule("shouting", -1, "n_upper_words >= 0.5 * n_words"),
    Rule("exclamations", -1, "n_shouts >= 0.25 * n_words"),
    Rule("echoes", -1, "n_echo_words >= 0.25 * n_words and n_words >= 10"),
    Rule("odd_words", -1, "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("monotony", -1, "n_words >= 40 and ln(n_distinct_words) <= 0.5 * ln(n_words)"),
    Rule("run_on", -1, "n_words >= 200 and n_words > 150 * (n_stops + 1)"),
    # A prose rule votes only where no kind of junk shows, so that it never speaks for junk of another kind.
    Rule("plain_prose", 1, "n_symbols <= 0.1 * n_words and n_shouts <= 0.15 * n_words and n_upper_words <= 0.4 * n_words "
                           "and n_repeat_words <= 0.2 * n_words and n_echo_words <= 0.2 * n_words"),
    Rule("sentences", 1, "n_stops > 0 and n_words <= 100 * n_stops and n_words >= 1.5 * n_stops and n_symbols <= 0.1 * n_words "
                         "and n_upper_words <= 0.4 * n_words and n_repeat_words <= 0.2 * n_words and n_echo_words <= 0.2 * n_words"),
)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole-text statistics of every document, stored in the shared folder."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column("text")):
                s = chunk_stats(c)
                yield pa.record_batch({"row": b.column("row").slice(c.lo, c.n), "doc_id": b.column("doc_id").slice(c.lo, c.n),
                                       **{k: pa.array(s[k].astype(np.int64)) for k in STATS}})

    return stored(rows.mapInArrow(run, "row long, doc_id long, " + ", ".join(f"{k} long" for k in STATS)), "doc-stats")


def votes(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A vote column per rule; a document without words gets no vote at all."""
    return stats.withColumns({f"vote_{r.name}": F.when(F.expr(f"n_words > 0 and ({r.when})"), r.says).otherwise(0) for r in rules})


@dataclass
class VoteModel:
    """P(good), and per rule the rates at which it votes on bad and on good documents."""
    prior: float
    rates: np.ndarray      # rules x (bad, good)

    def log_odds(self) -> np.ndarray:
        """rules x (abstains, votes): what each adds to the log odds of good."""
        return np.log(np.column_stack([(1 - self.rates[:, 1]) / (1 - self.rates[:, 0]), self.rates[:, 1] / self.rates[:, 0]]))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> VoteModel:
    """Vote rates from distinct vote patterns (rows of -1, 0, 1) and how often each occurs.

    The start takes any bad vote as a sign of a bad document. ``smooth`` pseudo-counts keep
    every rate inside (0, 1)."""
    m = patterns.shape[1]
    n, fired = counts.astype(float), patterns != 0
    good = np.where((patterns == -1).any(1), 0.05, 0.95)
    prior, rates = 0.5, np.full((m, 2), 0.5)
    for _ in range(rounds):
        prior = float((n @ good + smooth) / (n.sum() + 2 * smooth))
        for k, w in enumerate((n * (1 - good), n * good)):
            rates[:, k] = (fired.T @ w + smooth) / (w.sum() + 2 * smooth)
        voted, silent = np.log(rates[:, 1] / rates[:, 0]), np.log((1 - rates[:, 1]) / (1 - rates[:, 0]))
        odds = np.log(prior / (1 - prior)) + fired @ voted + (~fired) @ silent
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done = np.abs(new - good).max(initial=0) < 1e-9
        good = new
        if done:
            break
    return VoteModel(prior, rates)


def fit(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """Count vote patterns over all documents (bounded by 2^rules) and run EM on the counts."""
    cols = [f"vote_{r.name}" for r in rules]
    rows = votes(stats, rules).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(tuple(r) for r in rows)
    patterns = np.array([r[:-1] for r in rows], np.int64).reshape(len(rows), len(rules))
    return expectation_maximisation(patterns, np.array([r[-1] for r in rows], np.int64))


def posterior(model: VoteModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """P(good | votes) as a column over the vote columns."""
    odds = F.lit(float(np.log(model.prior / (1 - model.prior))))
    for r, add in zip(rules, model.log_odds(), strict=True):
        odds = odds + F.when(F.col(f"vote_{r.name}") != 0, float(add[1])).otherwise(float(add[0]))
    return 1 / (1 + F.exp(-odds))


def judge(stats: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Statistics, votes, ``p_good`` and ``verdict`` of every document."""
    model = fit(stats, rules)
    return votes(stats, rules).withColumn("p_good", posterior(model, rules)).withColumn("verdict", F.col("p_good") >= threshold)
