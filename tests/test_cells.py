"""Exact search over cells against brute force, and how little of the pairs it evaluates."""

import numpy as np
import pytest

from tessera.operators.cells import Balls, Boxes, first_cells, open_cells, table
from tessera.operators.knn import KNeighborsRegressor


def frame(spark, x, parts=4):
    rows = [(i, [float(v) for v in r], float(i % 7)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, f array<double>, y double").repartition(parts)


def brute(train, query, k, metric):
    out = {}
    for i, q in enumerate(query):
        diff = train - q
        with np.errstate(over="ignore"):
            d = np.zeros(len(train))
            for j in range(train.shape[1]):
                d += diff[:, j] ** 2 if metric == "euclidean" else np.abs(diff[:, j])
            d = np.sqrt(d) if metric == "euclidean" else d
        order = np.lexsort((np.arange(len(train)), d))[:k]
        out[i] = [(int(t), float(d[t])) for t in order]
    return out


def search(spark, train, query, k, metric="euclidean", **kw):
    model = KNeighborsRegressor(k, metric=metric, strategy="cells", **kw).fit(frame(spark, train), "f", "y")
    out = {}
    for r in model.neighbours(frame(spark, query), "f").orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["train_id"], r["distance"]))
    return out, model.work


def clusters(rng, n, d, centres, spread=0.05):
    c = rng.standard_normal((centres, d))
    return c[rng.integers(centres, size=n)] + spread * rng.standard_normal((n, d))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_clustered_wide_vectors(spark, metric):
    rng = np.random.default_rng(1)
    both = clusters(rng, 5000, 64, 60)
    train, query = both[:4000], both[4000:]
    got, work = search(spark, train, query, 5, metric, cell_rows=40)
    assert got == brute(train, query, 5, metric)
    assert work["share"] < 0.1 and work["copies_per_row"] < 60, work


def test_a_value_that_most_rows_share(spark):
    """95 % of rows agree in one feature: the others are cut instead."""
    rng = np.random.default_rng(2)
    both = rng.standard_normal((6000, 3))
    both[rng.random(6000) < 0.95, 0] = 1.0
    got, work = search(spark, both[:5000], both[5000:], 4, cell_rows=50)
    assert got == brute(both[:5000], both[5000:], 4, "euclidean")
    assert work["share"] < 0.1, work


@pytest.mark.parametrize("d", [1, 2, 4])
@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_few_features_with_ties(spark, d, metric):
    """Whole numbers: many equal distances, which go to the lower id."""
    rng = np.random.default_rng(d)
    both = rng.integers(0, 30, (3000, d)).astype(float)
    got, work = search(spark, both[:2500], both[2500:], 6, metric, cell_rows=20)
    assert got == brute(both[:2500], both[2500:], 6, metric)


def test_offsets_and_huge_values(spark):
    rng = np.random.default_rng(5)
    both = clusters(rng, 1500, 16, 20) + 1e8
    both[::97] *= 1e3
    both[5], both[6] = 1e200, -1e200
    got, _ = search(spark, both[:1200], both[1200:], 5, cell_rows=30)
    assert got == brute(both[:1200], both[1200:], 5, "euclidean")


def test_even_spread_falls_back_to_blocks(spark):
    rng = np.random.default_rng(6)
    both = rng.standard_normal((1500, 64))
    got, work = search(spark, both[:1200], both[1200:], 5, cell_rows=30)
    assert got == brute(both[:1200], both[1200:], 5, "euclidean") and work["blocks"]


def test_blocks_within_cells(spark):
    """Cells larger than a block, on both sides."""
    rng = np.random.default_rng(8)
    both = clusters(rng, 1600, 12, 3)
    got, work = search(spark, both[:1300], both[1300:], 5, cell_rows=300, train_block_rows=60, query_block_rows=25)
    assert got == brute(both[:1300], both[1300:], 5, "euclidean")


@pytest.mark.parametrize("kind", [Balls, Boxes])
@pytest.mark.parametrize("euclid", [True, False])
def test_bounds_hold(kind, euclid):
    rng = np.random.default_rng(9)
    x, q = clusters(rng, 2000, 4, 12, 0.3), clusters(rng, 300, 4, 12, 2.0)
    g = kind.fit(x[:500], 30, euclid)
    cell, dist = g.assign(x)
    counts = np.bincount(cell, minlength=g.n_cells)
    of = [np.flatnonzero(cell == c) for c in range(g.n_cells)]
    if kind is Balls:
        g.bounded(np.array([dist[i].min(initial=np.inf) for i in of]), np.array([dist[i].max(initial=-np.inf) for i in of]))
    else:
        g.bounded(np.array([x[i].min(0, initial=np.inf) for i in of]), np.array([x[i].max(0, initial=-np.inf) for i in of]))
    true = table(q, x, euclid)
    low = g.bounds(q)
    assert all((low[:, c] <= true[:, i].min(axis=1)).all() for c, i in enumerate(of) if len(i))
    first = first_cells(g, q, counts, 7)
    assert all(counts[f].sum() >= 7 and len(set(f)) == len(f) for f in first)
    kth = np.sort(true, axis=1)[:, 6]
    rest = open_cells(g, q, counts, kth, first)
    for i in range(len(q)):
        visited = set(first[i]) | set(rest[i])
        assert {cell[j] for j in np.flatnonzero(true[i] <= kth[i])} <= visited
        assert not set(first[i]) & set(rest[i])
