"""Scoring input of another width fails, in batch, unvalidated and on a stream;
arguments below their range are typed errors."""

import numpy as np
import pytest
from helpers import matrix
from pyspark.errors import PySparkException

from tessera import PCA, KMeans, KNeighborsRegressor, LinearRegression, LogisticRegression, Standardiser
from tessera import errors as E
from tessera.operators.knn import block_top_k
from tessera.streaming import score_stream

ROWS = [[1.0, 2.0], [2.0, 1.0], [8.0, 9.5], [9.0, 7.0], [4.0, 4.5]]
WIDER = [r + [5.0] for r in ROWS]


@pytest.fixture(scope="module")
def models(spark):
    df = matrix(spark, ROWS, [0.0, 0.0, 1.0, 1.0, 1.0])
    return {
        "standardiser": Standardiser().fit(df, "f"),
        "pca": PCA(2, scaling="unit").fit(df, "f"),
        "kmeans": KMeans(2, 50, 1e-6).fit(df, "f", seed=1),
        "linear": LinearRegression(0.01, 10).fit(df, "f", "y"),
        "logistic": LogisticRegression(0.01, 10).fit(df, "f", "y"),
    }


def score(model, df, features, **kw):
    return getattr(model, "predict", None) and model.predict(df, features, **kw) or model.transform(df, features, **kw)


@pytest.mark.parametrize("name", ["standardiser", "pca", "kmeans", "linear", "logistic"])
def test_other_widths_fail(spark, models, name, tmp_path):
    model = models[name]
    for rows in (WIDER, [r[:1] for r in ROWS], [ROWS[0], WIDER[1]]):
        df = matrix(spark, rows)
        with pytest.raises((E.FeatureCountMismatch, E.RaggedMatrix)):
            score(model, df, "f").collect()
        with pytest.raises(PySparkException, match="feature count . does not match expected 2"):
            score(model, df, "f", validate=False).collect()
    named = matrix(spark, WIDER, named=True)
    for validate in (True, False):
        with pytest.raises(E.FeatureCountMismatch):
            score(model, named, ["x1", "x2", "x3"], validate=validate)
    assert len(score(model, matrix(spark, ROWS), "f", validate=False).collect()) == len(ROWS)

    path = str(tmp_path / "in")
    matrix(spark, WIDER).write.parquet(path)
    stream = spark.readStream.schema("id long, f array<double>, y double").parquet(path)
    q = score_stream(stream, model, "f").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    with pytest.raises(PySparkException, match="does not match expected 2"):
        q.awaitTermination()


def test_nan_rows_fail_in_validated_transforms(spark, models):
    df = matrix(spark, [[1.0, float("nan")], [1.0, 2.0]])
    for name in ("pca", "standardiser"):
        with pytest.raises(E.NonFiniteInput):
            models[name].transform(df, "f")


def test_arguments_below_their_range(spark):
    df = matrix(spark, ROWS, [0.0, 0.0, 1.0, 1.0, 1.0])
    with pytest.raises(E.InvalidPcaComponentCount):
        PCA(-1).fit(df, "f")
    with pytest.raises(E.InvalidClusterCount):
        KMeans(-1, 5, 1e-3).fit(df, "f")
    with pytest.raises(E.InvalidIterations):
        KMeans(2, -1, 1e-3).fit(df, "f")
    with pytest.raises(E.InvalidK):
        KNeighborsRegressor(-1).fit(df, "f", "y")
    for kind in (LinearRegression, LogisticRegression):
        with pytest.raises(E.InvalidIterations):
            kind(0.1, -5).fit(df, "f", "y")


def test_repeated_query_ids_fail(spark):
    df = matrix(spark, ROWS, [0.0, 0.0, 1.0, 1.0, 1.0])
    model = KNeighborsRegressor(1).fit(df, "f", "y")
    with pytest.raises(E.DuplicateId):
        model.predict(df.unionByName(df.limit(1)), "f")


@pytest.mark.parametrize("d", [4, 7, 8, 64])
def test_huge_finite_values_are_searched(d):
    """Both sides of the width from which candidates are screened."""
    rng = np.random.default_rng(d)
    t, q = rng.normal(size=(50, d)) * 1e200, rng.normal(size=(6, d)) * 1e200
    ids = np.arange(50)
    with np.errstate(over="ignore"):
        got = block_top_k(np.arange(6), q, ids, t, ids * 1.0, 3, "euclidean")
        small = block_top_k(np.arange(6), q * 1e-200, ids, t * 1e-200, ids * 1.0, 3, "euclidean")
    assert len(got[0]) == len(small[0]) == 18


def test_package_is_shipped_with_the_functions(spark):
    import pickletools

    from pyspark import cloudpickle

    from tessera.operators import knn

    names = [a for op, a, _ in pickletools.genops(cloudpickle.dumps(knn.block_top_k)) if op.name in ("GLOBAL", "SHORT_BINUNICODE", "BINUNICODE")]
    import subprocess
    import sys

    code = "import sys, pickle; f = pickle.loads(sys.stdin.buffer.read()); assert 'tessera' not in sys.modules; print(f.__name__)"
    out = subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(knn.block_top_k), capture_output=True, check=True, cwd="/")
    assert names and out.stdout.strip() == b"block_top_k"
