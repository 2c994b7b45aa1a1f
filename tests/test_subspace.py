"""PCA without a d x d matrix."""

import numpy as np
import pytest
from helpers import matrix

from tessera import errors as E
from tessera.operators import PCA
from tessera.operators.gram import MAX_FEATURES
from tessera.operators.subspace import leading


def factors(n, d, strengths, seed=0, noise=0.05):
    """Rows with a few strong directions."""
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, len(strengths))) * strengths) @ r.normal(size=(len(strengths), d)) + noise * r.normal(size=(n, d))


def direct(x, k):
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    _, s, v = np.linalg.svd(z, full_matrices=False)
    return s[:k] ** 2 / len(x), v[:k]


def same_directions(a, b, tol):
    signs = np.sign(np.einsum("ij,ij->i", a, b))
    return np.allclose(a * signs[:, None], b, atol=tol)


@pytest.mark.parametrize("d,k", [(1, 1), (5, 5), (60, 7), (300, 3)])
def test_leading_equals_eigh(d, k):
    r = np.random.default_rng(d)
    c = r.normal(size=(d, d))
    c = c @ c.T
    values, vectors = leading(lambda b: c @ b, d, k)
    want, turn = np.linalg.eigh(c)
    assert np.allclose(values[:k], want[::-1][:k], rtol=1e-10)
    assert same_directions(vectors[:k], turn[:, ::-1].T[:k], 1e-8)


def test_rank_below_the_count_and_repeated_values():
    x = np.random.default_rng(1).normal(size=(3, 50))
    values, vectors = leading(lambda b: x.T @ (x @ b), 50, 6)
    assert np.allclose(values[3:], 0.0, atol=1e-9) and np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-9)
    values, _ = leading(lambda b: 2.0 * b, 30, 4)
    assert np.allclose(values, 2.0)
    values, _ = leading(lambda b: 0.0 * b, 30, 4)
    assert np.allclose(values, 0.0)


def test_no_convergence_is_an_error():
    c = np.diag(np.linspace(1.0, 1.001, 400))
    with pytest.raises(E.ConvergenceFailure):
        leading(lambda b: c @ b, 400, 3, max_steps=2)


@pytest.mark.parametrize("scaling", ["unit", "last_one"])
def test_subspace_equals_direct_solver(spark, scaling):
    df = matrix(spark, factors(120, 40, [9.0, 6.0, 4.0, 2.0]).tolist()).repartition(4)
    a = PCA(3, scaling=scaling, solver="direct").fit(df, "f")
    b = PCA(3, scaling=scaling, solver="subspace").fit(df, "f")
    assert np.allclose(a.eigenvalues, b.eigenvalues, rtol=1e-10) and np.allclose(a.components, b.components, rtol=1e-7, atol=1e-8)
    za, zb = (m.transform(df, "f").orderBy("id").toPandas().to_numpy() for m in (a, b))
    assert np.allclose(za, zb, rtol=1e-7, atol=1e-7)


def test_ten_components_of_ten_thousand_features(spark):
    d = 10_000
    assert d > MAX_FEATURES
    x = factors(150, d, np.linspace(12.0, 3.0, 10), seed=4)
    df = matrix(spark, x.tolist()).repartition(6)
    model = PCA(10, scaling="unit").fit(df, "f")
    values, vectors = direct(x, 10)
    assert np.allclose(model.eigenvalues, values, rtol=1e-9)
    assert same_directions(model.components, vectors, 1e-8)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    got = model.transform(df, "f").orderBy("id").toPandas().drop(columns="id").to_numpy()
    assert np.allclose(got, z @ model.components.T, atol=1e-8)


def test_unknown_solver():
    with pytest.raises(ValueError):
        PCA(1, solver="other")
