"""The blocked (numpy per batch) Gram path agrees with the column path."""

import numpy as np

import tessera.operators.gram as G
from tessera.operators import PCA, LinearRegression
from tessera.operators.scaling import covariance_of_standardised


def test_wide_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6))
    x[:, 1] += 0.8 * x[:, 0]
    y = x @ np.arange(1, 7) + 0.5
    df = spark.createDataFrame(
        [(i, [float(v) for v in x[i]], float(y[i])) for i in range(300)], "id long, f array<double>, y double"
    ).repartition(4)
    narrow_cov, _ = covariance_of_standardised(df, "f")
    narrow_lin = LinearRegression(0.05, 200).fit(df, "f", "y").weights
    narrow_pca = PCA(2).fit(df, "f").components
    monkeypatch.setattr(G, "WIDE", 2)
    import tessera.operators.regression as R
    import tessera.operators.scaling as S

    monkeypatch.setattr(S, "WIDE", 2)
    monkeypatch.setattr(R, "WIDE", 2)
    wide_cov, _ = covariance_of_standardised(df, "f")
    wide_lin = LinearRegression(0.05, 200).fit(df, "f", "y").weights
    wide_pca = PCA(2).fit(df, "f").components
    assert np.allclose(narrow_cov, wide_cov, atol=1e-12)
    assert np.allclose(narrow_lin, wide_lin, atol=1e-10)
    assert np.allclose(narrow_pca, wide_pca, atol=1e-9)


def test_driver_matrix_limit(spark, monkeypatch):
    import pytest
    from pyspark.sql import functions as F

    monkeypatch.setattr(G, "MAX_FEATURES", 3)
    with pytest.raises(ValueError, match="on the driver"):
        G.blocked_gram(spark.range(3), [F.col("id")] * 4)
