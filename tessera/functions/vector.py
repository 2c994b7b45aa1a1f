"""Column-expression building blocks.

Everything here returns a ``pyspark.sql.Column`` built from built-in functions,
so it stays inside whole-stage code generation.  Sums run left to right over
the features, the same order a plain loop over a row would use, so exact zeros
and ties come out the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
# Fixed value: probabilities are clamped to [EPS, 1 - EPS] before the logarithm.
LOG_LOSS_EPSILON = 1e-7

METRICS = ("euclidean", "manhattan")


def check_metric(metric: str) -> str:
    m = metric.lower()
    if m not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return m


def nonfinite(c: Column) -> Column:
    """True for null, NaN and +-Infinity (a Spark null counts as non-finite)."""
    return c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(INF))


def total(terms: Sequence[Column]) -> Column:
    """Left-to-right sum of terms."""
    return reduce(lambda a, b: a + b, terms)


def squared_distance(xs: Sequence[Column], ys: Sequence[Column | float]) -> Column:
    return total([(x - y) * (x - y) for x, y in zip(xs, ys)])


def euclidean(xs: Sequence[Column], ys: Sequence[Column | float]) -> Column:
    return F.sqrt(squared_distance(xs, ys))


def manhattan(xs: Sequence[Column], ys: Sequence[Column | float]) -> Column:
    return total([F.abs(x - y) for x, y in zip(xs, ys)])


def distance(xs: Sequence[Column], ys: Sequence[Column | float], metric: str = "euclidean") -> Column:
    return euclidean(xs, ys) if check_metric(metric) == "euclidean" else manhattan(xs, ys)


def array_distance(a: Column, b: Column, metric: str = "euclidean") -> Column:
    """Distance of two equal-length array<double> cells (validate lengths first:
    ``zip_with`` pads the shorter side with null instead of failing)."""
    if check_metric(metric) == "euclidean":
        sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))
    ab = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return F.aggregate(ab, F.lit(0.0), lambda acc, v: acc + v)


def dot(xs: Sequence[Column], ws: Sequence[float]) -> Column:
    return total([x * F.lit(float(w)) for x, w in zip(xs, ws)])


def affine(xs: Sequence[Column], weights: Sequence[float]) -> Column:
    """``w0 * 1.0 + w1 * x1 + ...``: weight 0 is the intercept."""
    return total([F.lit(1.0) * F.lit(float(weights[0]))] + [x * F.lit(float(w)) for x, w in zip(xs, weights[1:])])


def sigmoid(z: Column) -> Column:
    """``1 / (1 + exp(-z))``; saturates to 0.0 / 1.0 instead of failing."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log_loss(p: Column, y: Column) -> Column:
    """Binary cross-entropy with the probability clamped to [1e-7, 1 - 1e-7]."""
    q = F.least(F.greatest(p, F.lit(LOG_LOSS_EPSILON)), F.lit(1.0 - LOG_LOSS_EPSILON))
    return -y * F.log(q) - (F.lit(1.0) - y) * F.log(F.lit(1.0) - q)


def argmin(ds: Sequence[Column]) -> Column:
    """0-based index of the smallest value; ties go to the lowest index."""
    cands = F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(ds)])
    return F.array_min(cands)["i"]


def literal_longs(values: Sequence[int]) -> Column:
    """A constant array of integers as one literal, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def rounded(c: Column, digits: int) -> Column:
    """Round and fold -0.0 into 0.0 (for stable value hashes)."""
    return F.round(c, digits) + F.lit(0.0)
