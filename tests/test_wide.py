"""Wide fits (matrix products per Arrow batch) against column expressions."""

import numpy as np
import pytest

import tessera.operators.kmeans as K
import tessera.operators.regression as R
from tessera import KMeans, LinearRegression, LogisticRegression
from tessera.operators.wide import nearest


def frame(spark, n=300, d=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + rng.integers(0, 3, size=(n, 1))
    rows = [(i, [float(v) for v in x[i]], float(x[i].sum() > 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, f array<double>, y double").repartition(5)


@pytest.mark.parametrize("named", [False, True])
def test_wide_equals_narrow(spark, monkeypatch, named):
    df, features = frame(spark), "f"
    if named:
        features = [f"x{i}" for i in range(6)]
        df = df.select("id", "y", *[df.f[i].alias(x) for i, x in enumerate(features)])
    got = []
    for cells, width in ((64, 32), (0, 0)):
        monkeypatch.setattr(K, "NARROW_CELLS", cells)
        monkeypatch.setattr(R, "WIDE", width)
        km = KMeans(4, 200, 1e-9).fit(df, features, seed=5)
        lo = LogisticRegression(0.2, 110).fit(df, features, "y")
        score = {r["id"]: r["prediction"] for r in lo.predict(df, features).collect()}
        got.append((km, {r["id"]: r["cluster"] for r in km.predict(df, features).collect()}, lo, score))
    (a, labels, lo, score), (b, wide_labels, wide_lo, wide_score) = got
    assert labels == wide_labels and a.sizes == b.sizes and a.iterations == b.iterations
    assert np.allclose(a.centroids, b.centroids, atol=1e-12)
    assert np.allclose(lo.weights, wide_lo.weights, atol=1e-12)
    assert list(lo.losses) == list(wide_lo.losses) and np.allclose(list(lo.losses.values()), list(wide_lo.losses.values()))
    assert all(abs(score[i] - wide_score[i]) < 1e-12 for i in score)


def test_wide_linear_scores(spark):
    df = frame(spark, 200, 40)
    m = LinearRegression(0.001, 5).fit(df, "f", "y")
    for r in m.predict(df, "f").collect():
        assert abs(r["prediction"] - (m.weights[0] + np.dot(m.weights[1:], r["f"]))) < 1e-9


def test_wide_scoring_checks_width(spark):
    model = KMeans(8, 100, 1e-6).fit(frame(spark, 100, 16), "f", seed=1)
    with pytest.raises(Exception, match="FeatureCountMismatch"):
        model.predict(frame(spark, 5, 15), "f", validate=False).collect()


def test_nearest_decides_close_rows_exactly():
    rng = np.random.default_rng(1)
    for scale in (1.0, 1e-150, 1e160, 1e200):
        c = rng.normal(size=(5, 9)) * scale
        c[3] = c[1]  # equal centroids: the lower one wins
        v = np.vstack([rng.normal(size=(40, 9)) * scale, (c[0] + c[2]) / 2, c])
        with np.errstate(all="ignore"):
            acc = np.zeros((len(v), 5))
            for j in range(9):
                acc += (v[:, j : j + 1] - c[:, j]) ** 2
            assert (nearest(v, c) == np.sqrt(acc).argmin(1)).all()


def test_many_clusters_and_empty_partitions(spark):
    df = frame(spark, 60, 10).repartition(40)
    model = KMeans(20, 100, 1e-9).fit(df, "f", seed=2)
    assert sum(model.sizes) == 60 and len(model.sizes) == 20
