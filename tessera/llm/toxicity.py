"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade <= j) = sigmoid(threshold_j - w.x) with one weight vector for all
thresholds; the result is the expected severity, the sum of P(grade > j).

Features are words (letters, lower-cased) and the beginnings of longer words;
x is 1 + log(occurrences).  The vocabulary is chosen from a bounded sample of labelled documents
(``MAX_LABELLED``): features whose share among labelled-toxic documents stands
out by ``MIN_Z`` standard errors, at most ``MAX_WORDS``.  Where the labels say
only toxic or not, toxic documents are graded 1 or 2 by whether they hold more
such words than the median toxic document.  Every document is then scored in
one pass over its whole text, without a shuffle.

Edge cases: null and empty texts have no features (the baseline severity);
ids labelled twice have their highest grade; rows with null label or id are not
fitted on; without labels of both kinds every severity is 0; repeated rows are
scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: Labelled documents (smallest hashes of their ids) the model is fitted on.
MAX_LABELLED = 10_000
MAX_WORDS, MIN_Z, MIN_DOCS, RIDGE = 500, 5.0, 5, 0.03
#: Bytes of a longer word that are a feature of their own.
BEGINNING = 6

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def text_words(text: bytes) -> list[bytes]:
    words = text.translate(_LETTERS).split()
    return words + [w[:BEGINNING] + b"-" for w in words if len(w) > BEGINNING]


@dataclass(frozen=True)
class Severity:
    words: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, x: list[dict[int, float]]) -> tuple[np.ndarray, np.ndarray]:
        """Expected severity and P(grade >= 1) of sparse rows."""
        eta = np.array([sum(self.weights[i] * v for i, v in r.items()) for r in x])
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None] - eta[:, None], -50, 50)))
        return (above.sum(1), above[:, 0]) if len(self.thresholds) else (np.zeros(len(x)), np.zeros(len(x)))

    def features(self, text: bytes) -> dict[int, float]:
        hits = Counter(w for w in text_words(text) if w in self.words)
        return {self.words[w]: float(1 + np.log(n)) for w, n in hits.items()}


def fit_cumulative(x: np.ndarray, grade: np.ndarray, ridge: float = RIDGE, steps: int = 1000, rate: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by Adam on the penalised likelihood.
    Thresholds are a first one and log gaps, so they stay in order."""
    top = int(grade.max())
    n, d = x.shape
    share = np.array([(grade <= j).mean() for j in range(top)])
    start = np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))
    theta = np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -50, 50)))
    for step in range(1, steps + 1):
        w, cuts = theta[:d], np.cumsum(np.concatenate([theta[d : d + 1], np.exp(theta[d + 1 :])]))
        below = np.column_stack([np.zeros(n), sigmoid(cuts[None] - (x @ w)[:, None]), np.ones(n)])  # P(grade < j)
        lo, hi = below[np.arange(n), grade], below[np.arange(n), grade + 1]
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p  # zero at the ends
        g_cut = np.array([d_hi[grade == j].sum() - d_lo[grade == j + 1].sum() for j in range(top)]) / n
        g_first, g_gap = g_cut.sum(), [g_cut[j:].sum() * np.exp(theta[d + j]) for j in range(1, top)]
        grad = np.concatenate([-(x.T @ (d_hi - d_lo)) / n - ridge * w / n, [g_first], g_gap])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:d], np.cumsum(np.concatenate([theta[d : d + 1], np.exp(theta[d + 1 :])]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_LABELLED) -> Severity:
    none = Severity({}, np.empty(0), np.empty(0))
    each = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col(label).cast("int").alias("y")).dropna()
    sample = each.groupBy("l_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("l_id"), "l_id").limit(most)
    # one text per labelled id, whichever rows repeat it: at most ``most``, for vocabulary and fit alike
    rows = docs.select(F.col("doc_id").cast("long").alias("k_id"), F.col("text").cast("string").cast("binary").alias("t")).join(F.broadcast(sample), F.col("k_id") == F.col("l_id"))
    rows = rows.groupBy("k_id", "y").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("m")).select("k_id", "y", "m.t")

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = Counter(), Counter()
        seen = [0, 0]
        for b in batches:
            for y, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                (bad if y else good).update(set(text_words(t or b"")))
                seen[bool(y)] += 1
        words = [*(good.keys() | bad.keys()), None]
        cols = [[good[w] for w in words[:-1]] + [seen[0]], [bad[w] for w in words[:-1]] + [seen[1]]]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *[pa.array(c, pa.int64()) for c in cols]], ["word", "good", "bad"])

    counts = rows.mapInArrow(vocabulary, "word binary, good long, bad long").groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    counts = counts.where(f"word IS NULL OR good + bad >= {MIN_DOCS}").persist()
    n = counts.where("word IS NULL").first()
    if n is None or not n["good"] or not n["bad"]:
        counts.unpersist()
        return none
    share = (F.col("good") + F.col("bad") + 1) / (n["good"] + n["bad"] + 2)
    z = (F.col("bad") / n["bad"] - F.col("good") / n["good"]) / F.sqrt(share * (1 - share) * (1 / n["bad"] + 1 / n["good"]))
    best = counts.where("word IS NOT NULL").select("word", z.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_WORDS).collect()
    counts.unpersist()
    words = {bytes(r["word"]): i for i, r in enumerate(best)}
    if not words:
        return none
    model = Severity(words, np.empty(0), np.empty(0))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [model.features(t or b"") for t in b.column(2).to_pylist()]
            cols = [pa.array([list(r) for r in x], pa.list_(pa.int32())), pa.array([list(r.values()) for r in x], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["k_id", "y", "at", "value"])

    fitted = sorted(rows.mapInArrow(sparse, "k_id long, y int, at array<int>, value array<double>").collect(), key=lambda r: r["k_id"])
    x, y = np.zeros((len(fitted), len(words))), np.array([r["y"] for r in fitted])
    for i, r in enumerate(fitted):
        x[i, r["at"]] = r["value"]
    if y.max() == 1:
        total = np.where(x > 0, np.exp(x - 1), 0).sum(1)
        y = y + ((y == 1) & (total > np.median(total[y == 1])))
    w, cuts = fit_cumulative(x, y)
    return Severity(words, w, cuts)


def score(docs: DataFrame, model: Severity) -> DataFrame:
    """k_id, severity (expected grade), p_toxic, toxic of every row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                expected, p = model.expected([model.features(t.as_py() or b"") for t in b.column(1)])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected), pa.array(p)], ["k_id", "severity", "p_toxic"])

    rows = docs.select(F.col("doc_id").cast("long").alias("k_id"), F.col("text").cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(run, "k_id long, severity double, p_toxic double").withColumn("toxic", F.col("p_toxic") >= 0.5)


def grade_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected severity."""
    docs = read(spark, sf_dir, "documents")
    s = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return s.select(F.col("k_id").alias("doc_id"), "severity", "p_toxic", "toxic")
