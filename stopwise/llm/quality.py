"""Quality classifier: regularised quadratic discriminant over document statistics.

Every document becomes a vector of transformed whole-text statistics (rates under a
square root, sizes under a logarithm). Fitting needs only, per class, the count, the sum
and the cross products of those vectors, which Spark adds up over all labelled rows. The
class covariances are shrunk towards the pooled covariance and its mean variance; their
Cholesky factors are computed once and travel to the tasks (a few kilobytes). A document's
score is the logistic of the tempered difference of the two log densities, each from a
Mahalanobis distance by forward substitution.

Defined results: a null or empty text has all statistics 0 and is scored like any other;
a document with several labels counts once per label row; null labels are ignored; with
only one labelled class every score is that class's; extra columns are ignored.
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

FEATURES = ("size", "word_length", "symbols", "upper", "echo", "repeat", "variety", "dup_lines", "punct", "shouts", "digits", "stops", "line_words")
TEMPERATURE = 4.0


def vectors(s: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, one row per text; 0 / 0 is 0."""
    def rate(a, b):
        return np.sqrt(a / np.maximum(b, 1))
    w, cp = s["n_words"], s["n_code_points"]
    return np.column_stack([
        np.log1p(w), np.log1p(s["word_chars"] / np.maximum(w, 1)), rate(s["n_symbols"], w), rate(s["n_upper_words"], w),
        rate(s["n_echo_words"], w), rate(s["n_repeat_words"], w), np.log1p(s["n_distinct_words"]) / np.maximum(np.log1p(w), 0.5),
        rate(s["n_dup_lines"], s["n_lines"]), rate(s["n_punct"], cp), rate(s["n_shouts"], w), rate(s["n_digits"], cp),
        rate(s["n_stops"], w), np.log1p(w / np.maximum(s["n_lines"], 1))]).astype(np.float64)


def featurize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, features array<double>) of every document, stored in the shared folder."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in tk.chunks(b.column("text")):
                x = vectors(chunk_stats(c))
                flat = pa.array(x.ravel())
                yield pa.record_batch({
                    "row": b.column("row").slice(c.lo, c.n), "doc_id": b.column("doc_id").slice(c.lo, c.n),
                    "features": pa.ListArray.from_arrays(pa.array(np.arange(c.n + 1, dtype=np.int32) * x.shape[1]), flat)})

    return stored(rows.mapInArrow(run, "row long, doc_id long, features array<double>"), "features")


@dataclass
class Discriminant:
    """Two Gaussian classes: means, Cholesky factors and log constants."""
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    temperature: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 minus that of class 0, priors included."""
        logs = []
        for mean, factor, const in zip(self.means, self.factors, self.constants, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(const - 0.5 * np.einsum("ij,ij->j", z, z))
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        d = np.clip(self.difference(x) / self.temperature, -500, 500)
        return 1.0 / (1.0 + np.exp(-d))


def moments(features: DataFrame, label: Column) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: count, sum and cross products, added up by Spark (d * d numbers reach the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, list] = {}
        for b in batches:
            y = b.column("label").to_numpy()
            x = np.array(b.column("features").flatten()).reshape(len(y), -1)
            for k in np.unique(y):
                v = x[y == k]
                a = acc.setdefault(int(k), [0.0, 0.0, 0.0])
                a[0], a[1], a[2] = a[0] + len(v), a[1] + v.sum(0), a[2] + v.T @ v
        for k, (n, s, c) in acc.items():
            flat = np.concatenate([[n], s, c.ravel()])
            yield pa.record_batch({"label": pa.array(np.full(len(flat), k)), "at": pa.array(np.arange(len(flat))), "value": pa.array(flat)})

    rows = (features.select(label.cast("long").alias("label"), "features").where("label is not null")
            .mapInArrow(run, "label long, at long, value double").groupBy("label", "at").agg(F.sum("value").alias("value")).collect())
    out = {}
    d = len(FEATURES)
    for k in (0, 1):
        flat = np.zeros(1 + d + d * d)
        for r in rows:
            if r.label == k:
                flat[r["at"]] = r.value
        out[k] = (flat[0], flat[1: d + 1], flat[d + 1:].reshape(d, d))
    return out


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float = 0.2, ridge: float = 0.02, temperature: float = TEMPERATURE) -> Discriminant:
    """Shrinkage covariances: (1 - shrink) * class + shrink * pooled, plus ``ridge`` times the mean variance."""
    d = len(FEATURES)
    total = max(sum(v[0] for v in sums.values()), 1.0)
    covs, means = {}, {}
    for k, (n, s, c) in sums.items():
        means[k] = s / max(n, 1.0)
        covs[k] = c / max(n, 1.0) - np.outer(means[k], means[k])
    pooled = sum(sums[k][0] / total * covs[k] for k in sums)
    scale = max(np.trace(pooled) / d, 1e-6)
    factors, consts = [], []
    for k in (0, 1):
        n = sums[k][0]
        keep = (1 - shrink) * n / (n + d)            # few rows lean on the pooled covariance
        cov = keep * covs[k] + (1 - keep) * pooled + ridge * scale * np.eye(d)
        f = np.linalg.cholesky(cov)
        factors.append(f)
        consts.append(float(np.log(max(n, 1e-3) / total) - np.log(np.diag(f)).sum()))
    return Discriminant([means[0], means[1]], factors, consts, temperature)


def train(features: DataFrame, labelled: DataFrame, label_col: str = "quality") -> Discriminant:
    """Fit on all rows of ``labelled`` (doc_id, label); the join moves the short vectors, never texts."""
    y = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("label"))
    return fit(moments(features.join(y, "doc_id"), F.col("label")))


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """(row, doc_id, score) of every row of ``features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("features").flatten()).reshape(b.num_rows, -1)
            yield pa.record_batch({"row": b.column("row"), "doc_id": b.column("doc_id"), "score": pa.array(model.score(x) if len(x) else np.empty(0))})

    return features.mapInArrow(run, "row long, doc_id long, score double")


def keep(docs: DataFrame, model: Discriminant, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [model.score(vectors(chunk_stats(c))) >= least for c in tk.chunks(b.column(text_col))]
            yield b.filter(pa.array(np.concatenate(ok))) if ok else b

    return docs.mapInArrow(run, docs.schema)
