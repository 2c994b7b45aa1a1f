import math

import numpy as np
import pytest

from helpers import matrix
from tessera import errors as E
from tessera.operators import PCA

# Inputs and projections that must come out as the compatible library's.
TEN = [[2.5, 2.4], [0.5, 0.7], [2.2, 2.9], [1.9, 2.2], [3.1, 3.0], [2.3, 2.7], [2.0, 1.6], [1.0, 1.1], [1.5, 1.6], [1.1, 0.9]]


def project(spark, rows, k, **kw):
    df = matrix(spark, rows)
    model = PCA(k, **kw).fit(df, "f")
    out = model.transform(df, "f").orderBy("id").collect()
    return model, np.array([[r[f"pc{j + 1}"] for j in range(k)] for r in out])


def test_reference_projection(spark):
    model, z = project(spark, [[2, 1], [4, 2], [5, 4], [7, 6]], 2)
    expected = [
        [2.2156832913419713, 0.18623901573433854],
        [0.8039267517097521, 0.3235422902944901],
        [0.5784329433089035, 0.09804848189364146],
        [2.44117709974282, 0.03925479266651011],
    ]
    assert np.allclose(np.abs(z), expected, atol=1e-8)
    assert np.allclose(model.eigenvalues, [1.4811851214825453, 0.0188148785174546], atol=1e-12)
    assert np.allclose(model.components, [[1, 1], [-1, 1]], atol=1e-12)
    assert abs(z[:, 0].mean()) < 1e-12 and abs(np.dot(z[:, 0], z[:, 1])) < 1e-9


def test_ten_rows(spark):
    model, z = project(spark, TEN, 2)
    assert z.shape == (10, 2)
    assert np.allclose(model.eigenvalues, [1.733336345423021, 0.06666365457697898], atol=1e-12)
    assert np.var(z[:, 0]) >= np.var(z[:, 1])
    _, z1 = project(spark, TEN[:5], 1)
    assert z1.shape == (5, 1) and np.all(np.isfinite(z1))


def test_collinear_is_finite(spark):
    _, z = project(spark, [[1, 2], [3, 4]], 1)
    assert np.all(np.isfinite(z))
    _, z = project(spark, [[0, -1.9], [1.1, -0.8], [2.4, 0.5]], 2, scaling="unit")
    assert np.all(np.isfinite(z))


def test_uncorrelated_needs_unit_scaling(spark):
    rows = [[0, 0], [0, 1], [1, 0], [1, 1]]
    with pytest.raises(E.UnscalableComponent, match="scaling='unit'"):
        project(spark, rows, 2)
    model, z = project(spark, rows, 2, scaling="unit")
    assert np.allclose(model.components @ model.components.T, np.eye(2), atol=1e-12)


def test_errors(spark):
    for n in (0, 3):
        with pytest.raises(E.InvalidPcaComponentCount) as ex:
            PCA(n).fit(matrix(spark, [[1, 2], [3, 4]]), "f")
        assert ex.value == E.InvalidPcaComponentCount(components=n, feature_count=2)
    cases = [
        ([[1, math.inf], [3, 4]], E.NonFiniteInput(row=1, column=2)),
        ([[1, 2]], E.InsufficientSamples(samples=1)),
        ([[1, 5], [3, 5], [4, 5]], E.ZeroVarianceFeature(column=2)),
        ([[], [1, 2]], E.EmptyRow(row=1)),
    ]
    for rows, err in cases:
        with pytest.raises(type(err)) as ex:
            PCA(1).fit(matrix(spark, rows), "f")
        assert ex.value == err
    with pytest.raises(E.EmptyDataset):
        PCA(1).fit(matrix(spark, [[1.0, 2.0]]).filter("id < 0"), "f")
    with pytest.raises(E.InvalidTolerance) as ex:
        PCA(1, tolerance=-1.0).fit(matrix(spark, [[1, 2], [3, 5]]), "f")
    assert str(ex.value) == "PCA/QR tolerance must be finite and non-negative"
