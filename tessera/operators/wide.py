"""Steps of iterative fits on wide vectors, as matrix products.

Column expressions are the shorter way for a few features; k x d or d + 1 of
them stop compiling for wide vectors.  Here each task reads its rows as Arrow
batches of one array column, works with matrix products, adds up one partial
result and emits it once; the results are added level by level (``combine``).
Only the model-sized sums reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vector import LOG_LOSS_EPSILON
from .combine import NO_LONGS, n_tasks, partial_sums, tree_sum

#: Cluster count x width up to which k-means uses column expressions.
NARROW_CELLS = 64
#: Cells of the distance table that one matrix product fills.
CHUNK_CELLS = 1_000_000
EPS = float(np.finfo(np.float64).eps)


def vectors(column: pa.Array, d: int) -> np.ndarray:
    """The rows of an array<double> column (all of width d) as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), d)


def nearest(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Position of each row's nearest centroid, ties to the lowest.

    Squared distances come from one matrix product; a row whose two best lie
    within the product's rounding bound of each other (or overflow) is decided
    by distances summed feature by feature, as the column expressions do."""
    k, d = centroids.shape
    out = np.zeros(len(v), dtype=np.int32)
    step = max(1, CHUNK_CELLS // k)
    with np.errstate(all="ignore"):
        c2 = np.einsum("ij,ij->i", centroids, centroids)
        for at in range(0, len(v), step):
            x = v[at : at + step]
            x2 = np.einsum("ij,ij->i", x, x)
            score = (c2 - 2.0 * (x @ centroids.T)) + x2[:, None]
            best = score.argmin(axis=1)
            if k > 1:
                two = np.partition(score, 1, axis=1)
                bound = 8.0 * (d + 4) * EPS * (x2 + c2.max())
                close = np.flatnonzero(~(two[:, 1] - two[:, 0] > bound))
                for lo in range(0, len(close), step):
                    rows = close[lo : lo + step]
                    acc = np.zeros((len(rows), k))
                    for j in range(d):
                        diff = x[rows, j][:, None] - centroids[:, j]
                        acc += diff * diff
                    best[rows] = np.sqrt(acc).argmin(axis=1)
            out[at : at + step] = best
    return out


def nearest_column(arr: Column, centroids: np.ndarray) -> Column:
    """``nearest`` as a column over an array<double> column."""
    d = centroids.shape[1]

    def run(a: pa.Array) -> pa.Array:
        return pa.array(nearest(vectors(a, d), centroids), pa.int32())

    return F.arrow_udf(run, "int")(arr)


def affine_column(arr: Column, weights: np.ndarray) -> Column:
    """Intercept plus weighted sum over an array<double> column."""
    w = np.asarray(weights, dtype=float)

    def run(a: pa.Array) -> pa.Array:
        with np.errstate(all="ignore"):
            return pa.array(w[0] + vectors(a, len(w) - 1) @ w[1:])

    return F.arrow_udf(run, "double")(arr)


def scaled_column(arr: Column, shift: np.ndarray, scale: np.ndarray, components: np.ndarray | None = None) -> Column:
    """``(x - shift) / scale`` over an array<double> column, or its products
    with the rows of ``components``, as an array<double>."""
    d = len(shift)

    def run(a: pa.Array) -> pa.Array:
        v, step, parts = vectors(a, d), max(1, CHUNK_CELLS // d), []
        with np.errstate(all="ignore"):
            for at in range(0, len(v), step):
                z = (v[at : at + step] - shift) / scale
                parts.append(z if components is None else z @ components.T)
        width = d if components is None else len(components)
        flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * width, pa.int32()), pa.array(flat))

    return F.arrow_udf(run, "array<double>")(arr)


def product_sums(base: DataFrame, shift: np.ndarray, scale: np.ndarray, block: np.ndarray) -> np.ndarray:
    """``Z^T Z block`` with ``Z = (x - shift) / scale`` of the rows
    (``_v`` array<double>): d x width sums, no d x d matrix."""
    d, width = block.shape

    def add(b: pa.RecordBatch, total):
        v, step = vectors(b.column(0), d), max(1, CHUNK_CELLS // d)
        out = np.zeros((d, width)) if total is None else total[0]
        for at in range(0, len(v), step):
            z = (v[at : at + step] - shift) / scale
            out += z.T @ (z @ block)
        return out, NO_LONGS

    out = tree_sum(partial_sums(base.select("_v"), add), n_tasks(base))
    return (np.zeros(d * width) if out is None else out[0]).reshape(d, width)


def cluster_part(h: np.ndarray, v: np.ndarray, centroids: np.ndarray, clusters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of some rows: feature sums with the member count as last column (k x
    (d + 1)), and the xor of ``h`` per cluster (``clusters``, if known)."""
    k, d = centroids.shape
    sums, prints = np.zeros((k, d + 1)), np.zeros(k, dtype=np.int64)
    if len(v):
        c = nearest(v, centroids) if clusters is None else clusters
        sums[:, d] = np.bincount(c, minlength=k)
        order = np.argsort(c, kind="stable")
        starts = np.flatnonzero(np.diff(c[order], prepend=-1))
        which = c[order][starts]
        sums[which, :d] = np.add.reduceat(v[order], starts, axis=0)
        prints[which] = np.bitwise_xor.reduceat(h[order], starts)
    return sums, prints


def cluster_sums(base: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """From rows (``_h`` long, ``_v`` array<double>): members (k), feature sums
    (k x d), and per cluster that has members (count, xor of ``_h``)."""
    k, d = centroids.shape

    def add(b: pa.RecordBatch, total):
        sums, prints = cluster_part(b.column(0).to_numpy(zero_copy_only=False), vectors(b.column(1), d), centroids)
        return (sums, prints) if total is None else (total[0] + sums, total[1] ^ prints)

    out = tree_sum(partial_sums(base.select("_h", "_v"), add), n_tasks(base))
    sums, prints = out if out is not None else (np.zeros(k * (d + 1)), np.zeros(k, dtype=np.int64))
    sums = sums.reshape(k, d + 1)
    n = sums[:, d].astype(np.int64)
    return n, sums[:, :d], {int(c): (int(n[c]), int(prints[c])) for c in np.flatnonzero(n)}


def logistic_part(y: np.ndarray, v: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of some rows: the gradient sum ``X^T (p - y)`` (intercept first) and the summed log-loss."""
    with np.errstate(all="ignore"):
        p = 1.0 / (1.0 + np.exp(-(weights[0] + v @ weights[1:])))
        r = p - y
        q = np.clip(np.nan_to_num(p, nan=1.0), LOG_LOSS_EPSILON, 1.0 - LOG_LOSS_EPSILON)
        return np.concatenate([[r.sum()], r @ v, [(-y * np.log(q) - (1.0 - y) * np.log(1.0 - q)).sum()]])


def logistic_sums(base: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """From rows (``_y`` double, ``_v`` array<double>): ``logistic_part`` of all."""
    d = len(weights) - 1

    def add(b: pa.RecordBatch, total):
        part = logistic_part(b.column(0).to_numpy(zero_copy_only=False), vectors(b.column(1), d), weights)
        return (part, NO_LONGS) if total is None else (total[0] + part, NO_LONGS)

    out = tree_sum(partial_sums(base.select("_y", "_v"), add), n_tasks(base))
    total = out[0] if out is not None else np.zeros(d + 2)
    return total[: d + 1], float(total[d + 1])
