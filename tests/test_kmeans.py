import math

import numpy as np
import pytest

from helpers import matrix
from tessera import errors as E
from tessera.operators import KMeans, initial_ranks

F5 = [[1, 1], [1.2, 0.9], [8, 8], [8.1, 7.9], [4, 4]]


def fit_predict(spark, rows, k, it, tol, seed):
    df = matrix(spark, rows)
    model = KMeans(k, it, tol).fit(df, "f", seed=seed)
    labels = [r["cluster"] for r in model.predict(df, "f").orderBy("id").collect()]
    return model, labels


def test_two_groups(spark):
    assert initial_ranks(7, 2, 4) == [2, 1]
    model, labels = fit_predict(spark, [[0, 0], [0, 1], [10, 10], [10, 11]], 2, 50, 1e-12, 7)
    assert labels == [1, 1, 0, 0]
    assert np.allclose(model.centroids, [[10, 10.5], [0, 0.5]])
    assert model.iterations == 2


def test_demo(spark):
    assert initial_ranks(42, 2, 4) == [1, 0]
    model, labels = fit_predict(spark, [[1, 1], [1.5, 2], [9, 8], [8, 9]], 2, 10, 1e-3, 42)
    assert labels == [1, 1, 0, 0]
    assert np.allclose(model.centroids, [[8.5, 8.5], [1.25, 1.5]])
    assert model.iterations == 3


def test_budget_exhausted(spark):
    with pytest.raises(E.ConvergenceFailure) as ex:
        fit_predict(spark, F5, 2, 1, 0.0, 7)
    assert ex.value == E.ConvergenceFailure(algorithm="KMeans", max_iterations=1)
    with pytest.raises(E.ConvergenceFailure) as ex:
        fit_predict(spark, F5, 2, 0, 1e-12, 7)
    assert ex.value.max_iterations == 0


def test_seeds(spark):
    assert initial_ranks(42, 2, 5) == [3, 3]
    _, labels = fit_predict(spark, F5, 2, 20, 1e-12, 42)
    assert labels == [0, 0, 1, 1, 0]
    _, again = fit_predict(spark, F5, 2, 20, 1e-12, 42)
    assert again == labels
    assert initial_ranks(3, 2, 5) == [3, 2]
    _, labels = fit_predict(spark, F5, 2, 25, 1e-12, 3)
    assert labels == [1, 1, 0, 0, 1]


def test_identical_rows_and_empty_clusters(spark):
    _, labels = fit_predict(spark, [[1, 1]] * 3, 2, 1, 0.0, 11)
    assert all(label < 2 for label in labels)
    _, labels = fit_predict(spark, [[1, 1]] * 2, 2, 10, 1e-4, 7)
    assert labels == [0, 0]
    _, labels = fit_predict(spark, [[1, 2], [2, 3], [3, 4]], 1, 10, 1e-4, 42)
    assert labels == [0, 0, 0]


def test_large_seed(spark):
    rows = [[0, 0], [0, 1], [10, 10], [10, 11], [20, 20], [20, 21]]
    assert initial_ranks(11082287182648, 2, 6) == [5, 0]
    _, labels = fit_predict(spark, rows, 2, 32, 1e-12, 11082287182648)
    assert labels == [1, 1, 1, 0, 0, 0]


def test_argument_errors_and_precedence(spark):
    df = matrix(spark, [[1, 2], [3, 4]])
    for k in (0, 3):
        with pytest.raises(E.InvalidClusterCount) as ex:
            KMeans(k, 0, -1.0).fit(df, "f")
        assert ex.value == E.InvalidClusterCount(clusters=k, sample_count=2)
    for tol in (-math.inf, -1.0, math.nan, math.inf):
        with pytest.raises(E.InvalidTolerance) as ex:
            KMeans(2, 0, tol).fit(df, "f")
        assert str(ex.value) == "KMeans tolerance must be finite and non-negative"
    bad = matrix(spark, [[1, math.nan], [3, 4]])
    with pytest.raises(E.NonFiniteInput):
        KMeans(0, 0, -1.0).fit(bad, "f")


def test_predict_feature_count(spark):
    model, _ = fit_predict(spark, [[0, 0], [0, 1], [10, 10], [10, 11]], 2, 50, 1e-12, 7)
    with pytest.raises(E.FeatureCountMismatch) as ex:
        model.predict(matrix(spark, [[1, 2, 3]]), "f")
    assert ex.value == E.FeatureCountMismatch(expected=2, actual=3)
    with pytest.raises(E.EmptyDataset):
        model.predict(matrix(spark, [[1, 2]]).filter("id < 0"), "f")


def test_failed_refit_keeps_model(spark):
    model, labels = fit_predict(spark, [[1, 1]] * 3, 2, 1, 0.0, 11)
    with pytest.raises(E.ConvergenceFailure):
        KMeans(2, 1, 0.0).fit(matrix(spark, F5), "f", seed=7)
    assert [r["cluster"] for r in model.predict(matrix(spark, [[1, 1]] * 3), "f").orderBy("id").collect()] == labels


def test_estimator_state(spark):
    est = KMeans(2, 0, 1e-12)
    with pytest.raises(E.ConvergenceFailure):
        est.fit(matrix(spark, F5), "f", seed=7)
    with pytest.raises(E.PredictionBeforeFit):
        est.predict(matrix(spark, F5), "f")
    ok = KMeans(2, 50, 1e-12)
    ok.fit(matrix(spark, [[0, 0], [0, 1], [10, 10], [10, 11]]), "f", seed=7)
    before = [r["cluster"] for r in ok.predict(matrix(spark, F5), "f").orderBy("id").collect()]
    ok.max_iter = 1
    ok.tolerance = 0.0
    with pytest.raises(E.ConvergenceFailure):
        ok.fit(matrix(spark, F5), "f", seed=7)
    after = [r["cluster"] for r in ok.predict(matrix(spark, F5), "f").orderBy("id").collect()]
    assert before == after


def test_ranks_of_any_orderable_id(spark):
    import tessera.operators.kmeans as KM

    df = spark.range(0, 200_000).selectExpr("id * 7 + (id % 13) AS id").repartition(7)
    ranks = [0, 1, 17, 99_999, 150_001, 199_999]
    assert KM.ids_at_ranks(df, "id", ranks) == {r: r * 7 + (r % 13) for r in ranks}
    text = df.selectExpr("lpad(id, 9, '0') AS id")
    assert KM.ids_at_ranks(text, "id", ranks) == {r: f"{r * 7 + (r % 13):09d}" for r in ranks}


def test_string_ids_beyond_fifty_thousand_rows(spark):
    df = spark.range(60_000).selectExpr("id", "lpad(id, 9, '0') AS name", "double(id % 7) AS x", "double(id % 11) AS y")
    a = KMeans(3, 200, 1e-6).fit(df, ["x", "y"], "id", seed=5)
    b = KMeans(3, 200, 1e-6).fit(df, ["x", "y"], "name", seed=5)
    assert np.allclose(a.centroids, b.centroids) and a.sizes == b.sizes
