import math

import numpy as np
import pytest

from helpers import matrix
from tessera import errors as E
from tessera.operators import LinearRegression, LogisticRegression


def per_row_gd(x, y, lr, iterations, logistic):
    """Plain per-row recurrence, used as the brute-force oracle."""
    x = np.asarray(x, dtype=float)
    xb = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(xb.shape[1])
    for _ in range(iterations):
        grad = np.zeros_like(w)
        for row, t in zip(xb, y):
            z = sum(a * b for a, b in zip(row, w))
            p = 1.0 / (1.0 + math.exp(-z)) if logistic else z
            grad += (p - t) * row
        w = w - lr * grad / len(xb)
    return w


def test_linear_reference_values(spark):
    m = LinearRegression(0.1, 5000).fit(matrix(spark, [[0], [1], [2], [3]], [1, 3, 5, 7]), "f", "y")
    assert np.allclose(m.weights, [1.0, 2.0], atol=1e-6)
    preds = [r["prediction"] for r in m.predict(matrix(spark, [[4], [5]]), "f").orderBy("id").collect()]
    assert abs(preds[0] - 9) < 5e-2 and abs(preds[1] - 11) < 5e-2
    m = LinearRegression(0.01, 1000).fit(matrix(spark, [[1, 2], [2, 3], [3, 4]], [3, 5, 7]), "f", "y")
    assert np.allclose(m.weights, [0.08894080163, 0.93118763363, 1.02012843526], atol=1e-10)
    m = LinearRegression(0.01, 2000).fit(matrix(spark, [[1], [2], [3]], [2, 4, 6]), "f", "y")
    assert np.allclose(m.weights, [0.06651448805, 1.97074016255], atol=1e-10)
    m = LinearRegression(0.01, 2000).fit(matrix(spark, [[1], [2], [3], [4]], [2, 4, 6, 8], named=True), ["x1"], "y")
    assert np.allclose(m.weights, [0.03047293506, 1.98963548601], atol=1e-10)


def test_linear_zero_iterations_and_loss_trace(spark):
    df = matrix(spark, [[1, 2], [2, 3], [3, 4]], [3, 5, 7])
    m = LinearRegression(0.5, 0).fit(df, "f", "y")
    assert list(m.weights) == [0.0, 0.0, 0.0]
    m = LinearRegression(0.01, 250).fit(df, "f", "y")
    assert sorted(m.losses) == [0, 100, 200]
    assert m.losses[0] == pytest.approx((9 + 25 + 49) / 3)
    assert np.allclose(m.weights, per_row_gd([[1, 2], [2, 3], [3, 4]], [3, 5, 7], 0.01, 250, False), atol=1e-12)


def test_linear_divergence_is_flagged(spark):
    m = LinearRegression(10.0, 200).fit(matrix(spark, [[1], [2], [30]], [1, 2, 3]), "f", "y")
    assert m.diverged


def test_logistic_reference_recurrence():
    # long budgets checked on the plain recurrence (one Spark job per step)
    w = per_row_gd([[0], [1], [2], [3]], [0, 0, 1, 1], 0.2, 2000, True)
    assert np.allclose(w, [-8.15517588928, 5.60469439472], atol=1e-9)
    w = per_row_gd([[1], [2], [3]], [0, 0, 1], 0.01, 1000, True)
    assert np.allclose(w, [-1.23033802394, 0.4859260991], atol=1e-9)


def test_logistic_matches_recurrence(spark):
    x, y = [[0], [1], [2], [3]], [0, 0, 1, 1]
    m = LogisticRegression(0.2, 40).fit(matrix(spark, x, y), "f", "y")
    assert np.allclose(m.weights, per_row_gd(x, y, 0.2, 40, True), atol=1e-12)
    scores = [r["prediction"] for r in m.predict(matrix(spark, [[-1], [0], [1], [2], [3]]), "f").orderBy("id").collect()]
    assert all(0 <= s <= 1 for s in scores) and scores == sorted(scores)
    assert m.losses[0] == pytest.approx(math.log(2))


def test_logistic_targets(spark):
    for y in ([0, -0.1], [0, 1.1]):
        with pytest.raises(E.TargetOutOfRange) as ex:
            LogisticRegression(0.1, 1).fit(matrix(spark, [[1, 2], [3, 4]], y), "f", "y")
        assert ex.value.index == 2
    LogisticRegression(0.1, 1).fit(matrix(spark, [[1, 2], [3, 4]], [0.3, 1]), "f", "y")


def test_shared_input_errors(spark):
    for est in (LinearRegression(0.1, 1), LogisticRegression(0.1, 1)):
        with pytest.raises(E.EmptyTargets):
            est.fit(matrix(spark, [[1, 2], [3, 4]], []), "f", "y")
        with pytest.raises(E.NonFiniteInput):
            est.fit(matrix(spark, [[1, math.nan], [3, 4]], [0, 1]), "f", "y")
    m = LinearRegression(0.1, 1).fit(matrix(spark, [[1, 2], [3, 4]], [0, 1]), "f", "y")
    with pytest.raises(E.FeatureCountMismatch):
        m.predict(matrix(spark, [[1, 2, 3]]), "f")


def test_sigmoid_and_log_loss(spark):
    from pyspark.sql import functions as F

    from tessera.functions import log_loss, sigmoid

    r = spark.range(1).select(
        sigmoid(F.lit(0.0)).alias("s0"), sigmoid(F.lit(-800.0)).alias("lo"), sigmoid(F.lit(800.0)).alias("hi"),
        log_loss(F.lit(0.5), F.lit(1.0)).alias("ll"), log_loss(F.lit(0.0), F.lit(1.0)).alias("clamped"),
    ).first()
    assert r["s0"] == 0.5 and r["lo"] == 0.0 and r["hi"] == 1.0
    assert r["ll"] == pytest.approx(math.log(2))
    assert r["clamped"] == pytest.approx(-math.log(1e-7))
