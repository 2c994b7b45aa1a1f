"""K-means steps that skip distances by bounds."""

import numpy as np
import pytest
from helpers import matrix

from tessera.operators import KMeans
from tessera.operators.bounds import Assignment
from tessera.operators.wide import nearest


def moving(v, centroids, steps):
    """Centroids of plain steps."""
    for _ in range(steps):
        yield centroids
        c = nearest(v, centroids)
        centroids = np.array([v[c == j].mean(axis=0) if (c == j).any() else centroids[j] for j in range(len(centroids))])


@pytest.mark.parametrize("kind", ["clustered", "even", "grid", "offset", "huge", "one"])
def test_clusters_equal_plain_steps(kind):
    r = np.random.default_rng(5)
    v = r.normal(size=(1500, 12))
    k = 1 if kind == "one" else 9
    if kind == "clustered":
        v += 10.0 * r.integers(0, 3, size=(1500, 1))
    if kind == "grid":  # many ties
        v = r.integers(0, 3, size=(1500, 2)).astype(float)
    if kind == "offset":
        v += 1e8
    if kind == "huge":
        v *= 1e160
    kept = Assignment(v)
    with np.errstate(all="ignore"):
        for centroids in moving(v, v[r.integers(0, len(v), k)], 25):
            assert np.array_equal(kept.step(centroids), nearest(v, centroids))


def test_later_steps_skip_most_distances():
    r = np.random.default_rng(2)
    middles = 20.0 * r.normal(size=(16, 64))
    v = middles[r.integers(0, 16, 4000)] + r.normal(size=(4000, 64))
    kept, shares = Assignment(v), []
    for centroids in moving(v, v[r.integers(0, 4000, 16)], 20):
        assert np.array_equal(kept.step(centroids), nearest(v, centroids))
        shares.append(kept.evaluated / (4000 * 16))
    assert shares[0] == 1.0 and np.mean(shares[2:]) < 0.2


def test_no_rows_and_jumping_centroids():
    assert len(Assignment(np.zeros((0, 3))).step(np.ones((2, 3)))) == 0
    r = np.random.default_rng(8)
    v, kept = r.normal(size=(400, 5)), None
    kept = Assignment(v)
    for _ in range(20):  # unrelated centroids each time
        c = r.normal(size=(6, 5)) * r.choice([1e-3, 1.0, 50.0])
        assert np.array_equal(kept.step(c), nearest(v, c))


def test_fit_in_one_job_reports_its_work(spark):
    r = np.random.default_rng(3)
    v = 15.0 * r.normal(size=(5, 8))[r.integers(0, 5, 600)] + r.normal(size=(600, 8))
    df = matrix(spark, v.tolist()).repartition(4)
    plain = KMeans(5, 40, 1e-9).fit(df, "f", seed=11)
    one = KMeans(5, 40, 1e-9, one_job=True).fit(df, "f", seed=11)
    assert np.allclose(plain.centroids, one.centroids, rtol=1e-12) and plain.sizes == one.sizes and plain.iterations == one.iterations
    assert len(one.work) == one.iterations and one.work[0] == 1.0 and one.work[-1] < 0.5 and plain.work == ()
