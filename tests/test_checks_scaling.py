import math

import numpy as np
import pytest

from helpers import matrix, named
from tessera import errors as E
from tessera.frames import as_matrix
from tessera.operators import checks, column_moments, covariance_of_standardised, standardise


# The moments and error cases here must come out as the compatible library's.
def test_moments(spark):
    df = matrix(spark, [[1], [2], [3], [4]], named=True)
    row = column_moments(df, ["x1"]).first()
    assert row["mean"] == 2.5
    assert abs(row["stddev"] - 1.2909944487358056) < 1e-15


def test_standardise_fixture(spark):
    df = matrix(spark, [[1, 2], [2, 4], [3, 6]])
    out = sorted(standardise(df, "f").collect())
    assert [list(r["f"]) for r in out] == [[-1.0, -1.0], [0.0, 0.0], [1.0, 1.0]]
    out = standardise(matrix(spark, [[1, 2], [2, 4], [3, 6]], named=True), named(2)).orderBy("id").collect()
    assert [[r["x1"], r["x2"]] for r in out] == [[-1.0, -1.0], [0.0, 0.0], [1.0, 1.0]]


@pytest.mark.parametrize(
    "rows,err",
    [
        ([[1, 2]], E.InsufficientSamples(samples=1)),
        ([[1, 2], [3]], E.RaggedMatrix(row=2, expected=2, actual=1)),
        ([[1, math.inf], [3, 4]], E.NonFiniteInput(row=1, column=2)),
        ([[1, 2], [1, 4], [1, 6]], E.ZeroVarianceFeature(column=1)),
        ([[1, 2], [3, 2], [5, 2]], E.ZeroVarianceFeature(column=2)),
        ([[1, 2], []], E.EmptyRow(row=2)),
        ([[], [1, 2]], E.EmptyRow(row=1)),
        ([[1, 5], [3, 5], [4, 5]], E.ZeroVarianceFeature(column=2)),
    ],
)
def test_standardise_errors(spark, rows, err):
    with pytest.raises(type(err)) as ex:
        standardise(matrix(spark, rows), "f")
    assert ex.value == err


def test_empty_dataset(spark):
    df = matrix(spark, [[1.0, 2.0]]).filter("id < 0")
    with pytest.raises(E.EmptyDataset):
        standardise(df, "f")
    with pytest.raises(E.EmptyDataset):
        checks.scan(as_matrix(matrix(spark, [[1.0]], named=True).filter("id < 0"), ["x1"]))


def test_null_counts_as_nonfinite(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, None, 3.0)], "id long, a double, b double")
    with pytest.raises(E.NonFiniteInput) as ex:
        checks.scan(as_matrix(df, ["a", "b"]))
    assert ex.value == E.NonFiniteInput(row=2, column=1)


def test_row_positions_follow_id_order(spark):
    df = spark.createDataFrame([(30, [1.0]), (10, [1.0]), (20, [math.nan])], "id long, f array<double>")
    with pytest.raises(E.NonFiniteInput) as ex:
        checks.scan(as_matrix(df, "f"))
    assert ex.value == E.NonFiniteInput(row=2, column=1)


def test_targets(spark):
    m = as_matrix(matrix(spark, [[1, 2], [3, 4]], targets=[]), "f")
    with pytest.raises(E.EmptyTargets):
        checks.scan(m, target="y")
    m = as_matrix(matrix(spark, [[1, 2], [3, 4]], targets=[1]), "f")
    with pytest.raises(E.TargetLengthMismatch) as ex:
        checks.scan(m, target="y")
    assert ex.value == E.TargetLengthMismatch(samples=2, targets=1)
    m = as_matrix(matrix(spark, [[1, 2], [3, 4]], targets=[1, math.nan]), "f")
    with pytest.raises(E.NonFiniteTarget) as ex:
        checks.scan(m, target="y")
    assert ex.value.index == 2
    m = as_matrix(matrix(spark, [[1, 2], [3, 4]], targets=[0, 1.1]), "f")
    with pytest.raises(E.TargetOutOfRange) as ex:
        checks.scan(m, target="y", logistic=True)
    assert ex.value.index == 2
    m = as_matrix(matrix(spark, [[1, 2], [3, 4]], targets=[0, 0.3]), "f")
    checks.scan(m, target="y", logistic=True)  # fractions are accepted


def test_covariance_divides_by_n(spark):
    cov, _ = covariance_of_standardised(matrix(spark, [[1, 2], [2, 4], [3, 7]]), "f")
    assert abs(cov[0, 0] - 2 / 3) < 1e-15 and abs(cov[1, 1] - 2 / 3) < 1e-15
    assert np.allclose(cov, cov.T)


def test_reports(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [math.nan, 1.0]), (2, [])], "id long, f array<double>")
    r = checks.matrix_report(as_matrix(df, "f")).first()
    assert (r["n_rows"], r["n_empty_rows"], r["n_nonfinite_cells"], r["n_bad_rows"], r["first_bad_id"]) == (3, 1, 1, 2, 1)
    v = checks.variance_report(as_matrix(matrix(spark, [[1, 2], [1, 3]], named=True), named(2))).collect()
    assert [r["is_constant"] for r in sorted(v)] == [True, False]
