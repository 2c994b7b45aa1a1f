"""Quality classifier: hierarchical empirical Bayes.

1. Every document is reduced to a few text statistics, once.
2. A logistic model is fitted on a bounded sample of labelled rows
   (``MAX_LABELLED``) and gives each document a probability and an evidence:
   its log-odds less the log-odds of the sample's good share.
3. Grouped aggregation gives each host (``source``) and each path under it
   (``source``, ``lang``) its number of documents and mean probability.  The
   between-group variance at each level (one-way analysis of variance) sets
   how far a group is shrunk: path towards host, host towards the corpus.
4. A document's score is its evidence added to its path's posterior log-odds.

Group sums are combined per task before they are shuffled, and the posteriors
are joined back on salted keys, so a host with a third of all rows costs no
more than others.

Edge cases: null host or path are groups of their own; null, empty and blank
texts have all-zero statistics and are judged by them; repeated rows count
each; without usable labels of both kinds no evidence is given and everything
is kept; an empty table gives no rows; other columns pass through ``kept``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, read, same_row, with_rows

#: Labelled rows the document model is fitted on (smallest hashes of their ids).
MAX_LABELLED = 20_000
THRESHOLD, SALTS, RIDGE = 0.5, 32, 1.0
FEATURES = ("log_words", "upper", "symbol", "bar", "digit", "distinct", "repeat", "word_length", "distinct_runs", "empty")

_UPPER, _LOWER, _DIGIT, _BLANK, _SYMBOL = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = True, True, True
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL[33:127] = True
_SYMBOL &= ~(_UPPER | _LOWER | _DIGIT)
_SYMBOL[[ord(c) for c in ".,;:'\"()-?"]] = False  # ordinary punctuation


def text_statistics(text: bytes) -> list[float]:
    words = text.split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, size = len(words), len(text)
    at = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, int(at[_UPPER].sum() + at[_LOWER].sum()))
    ink = max(1, size - int(at[_BLANK].sum()))
    again = sum(map(bytes.__eq__, words, words[1:]))
    runs = max(1, n - 2)
    return [
        float(np.log1p(n)), at[_UPPER].sum() / letters, at[_SYMBOL].sum() / ink, at[124] / n, at[_DIGIT].sum() / ink,
        len(set(words)) / n, again / n, ink / n, len(set(zip(words, words[1:], words[2:]))) / runs, 0.0,  # noqa: B905
    ]


def statistics(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """k_id, k_text, host, path, x (the FEATURES) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [text_statistics(t.as_py() or b"") for t in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(x, pa.list_(pa.float64()))], ["k_id", "k_text", "host", "path", "x"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("k_id"), F.xxhash64("text").alias("k_text"),
        host.cast("string").alias("host"), path.cast("string").alias("path"), F.col("text").cast("string").cast("binary").alias("t"),
    )
    return rows.mapInArrow(run, "k_id long, k_text long, host string, path string, x array<double>")


def labelled_sample(labels: DataFrame, column: str, most: int) -> DataFrame:
    """l_id, y: at most ``most`` labelled ids, by hash; an id labelled twice has its mean."""
    each = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col(column).cast("double").alias("y")).dropna()
    return each.groupBy("l_id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("l_id"), "l_id").limit(most)


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept on the raw features (Newton steps on standardised ones)."""
    mean, sd = x.mean(0), x.std(0)
    sd[sd == 0] = 1
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    pull = np.diag([1e-6, *[ridge] * x.shape[1]])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + pull, z.T @ (y - p) - pull @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / sd
    return raw, float(w[0] - raw @ mean)


def _shrinkage(groups: DataFrame, mean: str, parent: str, n_parents: int) -> float:
    """Documents a parent's mean counts for: the variance within groups over the variance between them."""
    r = groups.agg(
        F.sum("n").alias("n"), F.count("*").alias("g"), F.sum("square").alias("square"),
        F.sum(F.col("n") * F.col(mean) ** 2).alias("own"), F.sum(F.col("n") * (F.col(mean) - F.col(parent)) ** 2).alias("between"),
        F.sum(F.col("n").cast("double") ** 2).alias("nn"),
    ).first()
    if not r["n"] or r["g"] <= n_parents or r["n"] <= r["g"]:
        return 1e9
    within = max((r["square"] - r["own"]) / (r["n"] - r["g"]), 1e-9)
    spread = (r["between"] - (r["g"] - n_parents) * within) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    return min(within / spread, 1e9) if spread > 0 else 1e9


def posteriors(scored: DataFrame) -> DataFrame:
    """From rows (``host``, ``path``, ``p``): host, path, ``host_posterior``, ``path_posterior``."""
    paths = checkpointed(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("sum"), F.sum(F.col("p") ** 2).alias("square")))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.count_distinct(F.coalesce("host", F.lit("")), F.col("host").isNull()).alias("hosts")).first()
    prior = (whole["sum"] or 0.0) / max(whole["n"] or 0, 1)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("square").alias("square"))
    hosts = hosts.withColumn("mean", F.col("sum") / F.col("n")).withColumn("prior", F.lit(prior))
    k = _shrinkage(hosts, "mean", "prior", 1)
    hosts = hosts.select(F.col("host").alias("h"), F.col("mean").alias("host_mean"), ((F.col("sum") + k * prior) / (F.col("n") + k)).alias("host_posterior"))
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["h"])).withColumn("mean", F.col("sum") / F.col("n"))
    k = _shrinkage(both, "mean", "host_mean", whole["hosts"])
    return both.select("host", "path", "host_posterior", ((F.col("sum") + k * F.col("host_posterior")) / (F.col("n") + k)).alias("path_posterior"))


def score(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, label: str = "quality", most: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """k_id, k_text, host, path, evidence, host_posterior, path_posterior, quality (probability), keep."""
    x = checkpointed(statistics(docs, F.col("source") if host is None else host, F.col("lang") if path is None else path))
    sample = labelled_sample(labels, label, most)
    # one row per labelled id, whichever rows repeat it: at most ``most``
    rows = x.join(F.broadcast(sample), F.col("k_id") == F.col("l_id")).groupBy("k_id", "y").agg(F.min(F.struct("k_text", "x")).alias("m")).orderBy("k_id").select("m.x", "y").collect()
    y = np.array([r["y"] for r in rows])
    if len(y) and 0 < y.mean() < 1:
        w, b = fit_logistic(np.array([r["x"] for r in rows]), y)
        terms = [F.get("x", i) * float(v) for i, v in enumerate(w)]
        odds = sum(terms, F.lit(b))
        base = float(np.log(y.mean() / (1 - y.mean())))
    else:
        odds, base = F.lit(20.0), 0.0
    scored = x.select("k_id", "k_text", "host", "path", odds.alias("odds"))
    scored = scored.withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest("odds", F.lit(-30.0)), F.lit(30.0)))))
    sites = posteriors(scored)
    salted = sites.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "host_posterior", "path_posterior", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s_salt"))
    mine = scored.withColumn("salt", F.pmod(F.xxhash64("k_id", "k_text"), F.lit(SALTS)).cast("int"))
    on = mine["host"].eqNullSafe(salted["s_host"]) & mine["path"].eqNullSafe(salted["s_path"]) & (mine["salt"] == salted["s_salt"])
    out = mine.join(salted, on).withColumn("evidence", F.col("odds") - base)
    total = F.col("evidence") + logit(F.col("path_posterior"))
    out = out.withColumn("quality", 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0)))))
    return out.select("k_id", "k_text", "host", "path", "evidence", "host_posterior", "path_posterior", "quality", (F.col("quality") >= threshold).alias("keep"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    gone = score(docs, labels).where("NOT keep").select("k_id", "k_text").distinct()
    full = with_rows(docs)
    out = full.join(gone, same_row(full, gone), "left_anti")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, posteriors, score and decision."""
    s = score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return s.select(F.col("k_id").alias("doc_id"), F.col("host").alias("source"), F.col("path").alias("lang"), "evidence", "host_posterior", "path_posterior", "quality", "keep")
