"""One pass over array rows: checks, moments, co-moments."""

import datetime
import math

import numpy as np
import pyarrow as pa
import pytest
from helpers import matrix, named

from tessera import errors as E
from tessera.frames import as_matrix
from tessera.operators import array_scan as A
from tessera.operators import checks, scaling
from tessera.operators.combine import partial_states, tree_fold


def rows_of(n, d, seed=0, offset=0.0):
    return np.random.default_rng(seed).normal(size=(n, d)) * np.arange(1, d + 1) + offset


@pytest.mark.parametrize("d", [1, 5, 40, 600])
def test_moments_and_covariance_equal_numpy(spark, d):
    x = rows_of(90, d, d, offset=1e4)
    df = matrix(spark, x.tolist()).repartition(7)
    res = scaling.scan_with_covariance(as_matrix(df, "f"))
    assert (res.n_rows, res.n_features) == (90, d)
    assert np.allclose(res.mean, x.mean(axis=0), rtol=1e-13) and np.allclose(res.sd, x.std(axis=0, ddof=1), rtol=1e-10)
    assert np.array_equal(res.lo, x.min(axis=0)) and np.array_equal(res.hi, x.max(axis=0))
    assert (res.comoment is None) == (d > A.COMOMENT_FEATURES)
    model = scaling.model_from_scan(res)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    assert np.allclose(scaling.standardised_covariance(res, model), z.T @ z / 90, atol=1e-9)


def test_named_columns_beyond_the_limit(spark):
    d = checks.WIDE_COLUMNS + 3
    x = rows_of(30, d)
    df = matrix(spark, x.tolist(), named=True)
    res = scaling.scan_with_covariance(as_matrix(df, named(d)))
    assert np.allclose(res.sd, x.std(axis=0, ddof=1)) and res.comoment.shape == (d, d)
    x[4, 33] = math.nan
    with pytest.raises(E.NonFiniteInput) as ex:
        scaling.scan_with_covariance(as_matrix(matrix(spark, x.tolist(), named=True), named(d)))
    assert ex.value == E.NonFiniteInput(row=5, column=34)


BAD = [
    ([], E.EmptyDataset()),
    ([[], [1, 2]], E.EmptyRow(row=1)),
    ([[1, 2], None, [3, 4]], E.EmptyRow(row=2)),
    ([[1, 2], [3], [4, math.inf]], E.RaggedMatrix(row=2, expected=2, actual=1)),
    ([[1, 2], [4, math.inf], [3]], E.NonFiniteInput(row=2, column=2)),
    ([[1, 2], [3, 4], [math.nan, math.inf]], E.NonFiniteInput(row=3, column=1)),
]


@pytest.mark.parametrize("rows,err", BAD)
def test_errors_as_without_moments(spark, rows, err):
    m = as_matrix(matrix(spark, rows).repartition(3), "f")
    for kw in ({}, {"moments": True}):
        with pytest.raises(type(err)) as ex:
            checks.scan(m, **kw)
        assert ex.value == err


@pytest.mark.parametrize("ids", [["b", "a", "ä", "c"], [datetime.date(2020, 1, i) for i in (4, 1, 3, 2)], [2, None, 5, 1]])
def test_first_row_by_ids_of_any_type(spark, ids):
    kind = "string" if isinstance(ids[0], str) else "date" if isinstance(ids[0], datetime.date) else "long"
    df = spark.createDataFrame([(i, [1.0, float(n)]) for n, i in enumerate(ids)], f"id {kind}, f array<double>").repartition(3)
    state = A.scan_states(df.select("id", "f"), True)
    least = df.selectExpr("min(struct(id, size(f))) AS m").first()["m"]["id"]
    assert state["first"][1] == least and state["n"] == 4


def test_null_cells_and_other_id_types(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [None, 2.0])], "id long, f array<double>")
    with pytest.raises(E.NonFiniteInput) as ex:
        checks.scan(as_matrix(df, "f"), moments=True)
    assert ex.value == E.NonFiniteInput(row=2, column=1)
    pairs = spark.createDataFrame([((0, "a"), [1.0, 2.0]), ((1, "b"), [3.0, 5.0])], "id struct<a:int,b:string>, f array<double>")
    assert not A.supports(as_matrix(pairs, "f"))
    assert checks.scan(as_matrix(pairs, "f"), moments=True).mean.tolist() == [2.0, 3.5]


def test_one_data_pass(spark):
    """Every row is read once for checks, moments and covariances together."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = matrix(spark, rows_of(200, 6).tolist()).repartition(5).mapInArrow(count, "id long, f array<double>, y double")
    cov, _ = scaling.covariance_of_standardised(df, "f")
    assert cov.shape == (6, 6) and seen.value == 200


def test_merging_in_any_order():
    x = rows_of(60, 4, 3)
    parts = [A.batch_state(pa.array(range(lo, lo + 12)), pa.array(x[lo : lo + 12].tolist()), True) for lo in range(0, 60, 12)]
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        state = parts[order[0]]
        for i in order[1:]:
            state = A.merge_states(state, parts[i])
        assert state["n"] == 60 and state["first"] == (True, 0, 4)
        assert np.allclose(state["moments"]["product"], np.cov(x.T) * 59)


def test_fold_over_many_tasks(spark):
    df = spark.range(0, 5000, 1, 300)
    states = partial_states(df, lambda b, s: (s or 0) + sum(b.column(0).to_pylist()))
    assert tree_fold(states, lambda a, b: a + b) == 5000 * 4999 // 2
    assert tree_fold(partial_states(df.filter("id < 0"), lambda b, s: 1), max) is None


def test_wide_standardiser_equals_expressions(spark):
    x = rows_of(25, 40, 9)
    df = matrix(spark, x.tolist())
    got = scaling.standardise(df, "f").orderBy("id").collect()
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    assert np.allclose([r["f"] for r in got], z, atol=1e-12)
