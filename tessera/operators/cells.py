"""Cells of the training rows for exact nearest-neighbour search.

A partition of space into cells, made from a bounded sample of rows, and for
any query a lower bound of its distance to every row of a cell.  A search that
knows a query's k-th distance so far need not visit a cell whose bound lies
beyond it.  Two geometries:

* ``Balls`` for wide vectors: Voronoi cells of sampled pivots.  A cell's rows
  lie between two radii around its pivot, and nearer to it than to any other
  pivot; both give bounds by the triangle inequality.
* ``Boxes`` for a few features: leaves of a k-d tree over the sample's medians,
  always cutting the feature that spreads the sample's rows best (so a value
  that nearly all rows share is not cut again and again), bounded by the
  smallest box around the rows they hold.

The sample decides where cells lie, never what a search returns.
"""

from __future__ import annotations

import numpy as np

#: Cells of a table of distances that is filled at once.
TABLE_CELLS = 1 << 18
EPS = float(np.finfo(np.float64).eps)


def table(x: np.ndarray, y: np.ndarray, euclid: bool) -> np.ndarray:
    """Distances of the rows of x to those of y, summed feature by feature."""
    out = np.zeros((len(x), len(y)))
    step = max(1, TABLE_CELLS // max(1, len(y)))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(x), step):
            part = out[at : at + step]
            for j in range(x.shape[1]):
                diff = x[at : at + step, j : j + 1] - y[None, :, j]
                part += diff * diff if euclid else np.abs(diff)
            if euclid:
                np.sqrt(part, out=part)
    return out


class Balls:
    """Voronoi cells of pivots."""

    def __init__(self, pivots: np.ndarray, euclid: bool):
        self.pivots, self.euclid = pivots, euclid
        self.n_cells = len(pivots)
        self.inner, self.outer = np.zeros(self.n_cells), np.zeros(self.n_cells)

    @classmethod
    def fit(cls, sample: np.ndarray, cells: int, euclid: bool) -> Balls:
        """Pivots far from one another: each the row of the sample farthest
        from those before it, out of every other one (so that lone far rows do
        not take all the pivots) until ``cells`` are found."""
        pool = np.unique(sample, axis=0)
        if len(pool) <= cells:
            return cls(pool, euclid)
        random = np.random.default_rng(17)
        pool = pool[random.permutation(len(pool))]
        half = cells // 2
        chosen = list(range(cells - half))
        near = table(pool, pool[chosen], euclid).min(axis=1)
        for _ in range(half):
            i = int(np.argmax(np.where(np.isfinite(near), near, -1.0)))
            chosen.append(i)
            near = np.minimum(near, table(pool, pool[i : i + 1], euclid)[:, 0])
        return cls(pool[np.unique(chosen)], euclid)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and its distance to the pivot."""
        d = table(x, self.pivots, self.euclid)
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(x)), cell]

    def bounded(self, inner: np.ndarray, outer: np.ndarray) -> None:
        """Smallest and largest distance to the pivot of each cell's rows."""
        self.inner, self.outer = inner, outer

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Distance that each row keeps from all rows of each cell, less a bound of its rounding."""
        d = table(x, self.pivots, self.euclid)
        with np.errstate(invalid="ignore", over="ignore"):
            own = d.min(axis=1, keepdims=True)
            low = np.maximum(np.maximum(d - self.outer, self.inner - d), (d - own) / 2)
            return low - 4 * (x.shape[1] + 4) * EPS * (d + self.outer)

    def nearest_first(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(table(x, self.pivots, self.euclid), axis=1, kind="stable")


class Boxes:
    """Leaves of a k-d tree."""

    def __init__(self, feature: list[int], cut: list[float], below: list[int], above: list[int], n_cells: int, width: int, euclid: bool):
        self.feature, self.cut = np.array(feature, np.int64), np.array(cut)
        self.below, self.above = np.array(below, np.int64), np.array(above, np.int64)  # a node, or -1 - cell
        self.n_cells, self.euclid = n_cells, euclid
        self.low, self.high = np.full((n_cells, width), np.inf), np.full((n_cells, width), -np.inf)

    @classmethod
    def fit(cls, sample: np.ndarray, cells: int, euclid: bool) -> Boxes:
        feature, cut, below, above = [], [], [], []
        n_cells, todo = 0, [(np.arange(len(sample)), None, 0)]
        least = max(1, len(sample) // max(1, cells))

        def settle(parent: tuple[list[int], int] | None, value: int) -> None:
            if parent is not None:
                parent[0][parent[1]] = value

        while todo:
            rows, parent, _ = todo.pop()
            best = None
            if len(rows) >= 2 * least:
                for j in range(sample.shape[1]):
                    v = np.sort(sample[rows, j])
                    # the cut between two values nearest the middle
                    at = np.flatnonzero(v[1:] > v[:-1]) + 1
                    if not len(at):
                        continue
                    k = int(at[np.argmin(np.abs(at - len(v) // 2))])
                    even = min(k, len(v) - k) / len(v)
                    lo, hi = v[len(v) // 10], v[-1 - len(v) // 10]
                    score = (even >= 0.25, (hi - lo) if np.isfinite(hi - lo) else np.inf, even)
                    if best is None or score > best[0]:
                        best = (score, j, float(v[k]))
            if best is None:
                settle(parent, -1 - n_cells)
                n_cells += 1
                continue
            _, j, c = best
            node = len(feature)
            feature.append(j)
            cut.append(c)
            below.append(0)
            above.append(0)
            settle(parent, node)
            under = sample[rows, j] < c
            todo.append((rows[~under], (above, node), 0))
            todo.append((rows[under], (below, node), 0))
        return cls(feature, cut, below, above, n_cells, sample.shape[1], euclid)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(x), np.int64) if len(self.feature) else np.full(len(x), -1)
        while (at >= 0).any():
            open_ = np.flatnonzero(at >= 0)
            node = at[open_]
            under = x[open_, self.feature[node]] < self.cut[node]
            at[open_] = np.where(under, self.below[node], self.above[node])
        return -1 - at, np.zeros(len(x))

    def bounded(self, low: np.ndarray, high: np.ndarray) -> None:
        """Smallest and largest value of each feature in each cell's rows."""
        self.low, self.high = low, high

    def _gaps(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.n_cells))
        with np.errstate(over="ignore", invalid="ignore"):
            for j in range(x.shape[1]):
                gap = np.maximum(np.maximum(self.low[None, :, j] - x[:, j : j + 1], x[:, j : j + 1] - self.high[None, :, j]), 0.0)
                out += gap * gap if self.euclid else gap
            return np.sqrt(out) if self.euclid else out

    def bounds(self, x: np.ndarray) -> np.ndarray:
        return self._gaps(x) * (1 - 8 * (x.shape[1] + 4) * EPS)

    def nearest_first(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(self._gaps(x), axis=1, kind="stable")


def first_cells(geometry, x: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the cells to look at first: the nearest, until they hold k rows."""
    order = geometry.nearest_first(x)
    held = np.cumsum(counts[order], axis=1)
    n = (held < k).sum(axis=1) + 1
    return [o[:m][counts[o[:m]] > 0] for o, m in zip(order, n, strict=True)]


def open_cells(geometry, x: np.ndarray, counts: np.ndarray, kth: np.ndarray, seen: list[np.ndarray]) -> list[np.ndarray]:
    """Per row the cells that may hold a row as near as ``kth`` and were not seen."""
    low = geometry.bounds(x)
    reach = kth * (1 + 8 * (x.shape[1] + 4) * EPS)
    may = ~(low > reach[:, None]) & (counts > 0)  # an undefined bound rules nothing out
    for row, done in zip(may, seen, strict=True):
        row[done] = False
    return [np.flatnonzero(row) for row in may]
