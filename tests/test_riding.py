"""Checks counted while rows are scored."""

import math
import os
import tempfile
import time

import pytest
from helpers import matrix, named

from tessera import errors as E
from tessera.operators import KMeans, LinearRegression, checks
from tessera.operators.riding import RidingCheck, StreamCheck
from tessera.streaming import parquet_stream, score_stream

GOOD = [[1, 2], [3, 5], [4, 4], [8, 1]]
BAD = [
    [[1, 2], None, [3, 4]],
    [[1, 2], [3], [4, math.inf]],
    [[1, 2], [4, math.inf], [3]],
    [[1, 2], [3, 4], [math.nan, math.inf]],
    [[1, 2, 3], [4, 5, 6]],
]


def model(spark):
    return LinearRegression(0.01, 20).fit(matrix(spark, GOOD, [1, 2, 3, 4]), "f", "y")


def test_good_rows_score_as_before(spark):
    m, df = model(spark), matrix(spark, GOOD)
    check = RidingCheck(df, "f", 2)
    got = sorted(m.predict(check.rows, "f", validate=False).collect(), key=lambda r: r["id"])
    check.raise_if_bad()
    assert check.counts["n_rows"] == 4 and check.counts["n_bad_rows"] == 0
    assert [r["prediction"] for r in got] == [r["prediction"] for r in m.predict(df, "f").orderBy("id").collect()]


@pytest.mark.parametrize("rows", BAD)
def test_errors_equal_those_of_a_check_beforehand(spark, rows):
    m, df = model(spark), matrix(spark, rows).repartition(3)
    with pytest.raises(E.TesseraError) as before:
        m.predict(df, "f")
    check = RidingCheck(df, "f", 2)
    m.predict(check.rows, "f", validate=False).collect()
    with pytest.raises(type(before.value)) as after:
        check.raise_if_bad()
    assert after.value == before.value


def test_rows_counted_twice_give_the_same_error(spark):
    """A sort samples its input first, so every row is seen twice."""
    check = RidingCheck(matrix(spark, BAD[1]), "f", 2)
    model(spark).predict(check.rows, "f", validate=False).orderBy("prediction").collect()
    with pytest.raises(E.RaggedMatrix) as ex:
        check.raise_if_bad()
    assert check.counts["n_rows"] >= 3 and ex.value == E.RaggedMatrix(row=2, expected=2, actual=1)


def test_named_columns_empty_input_and_width(spark):
    df = matrix(spark, [[1, 2], [math.nan, 3], [4, 5]], named=True)
    check = RidingCheck(df, named(2), 2)
    model(spark).predict(check.rows, named(2), validate=False).collect()
    with pytest.raises(E.NonFiniteInput) as ex:
        check.raise_if_bad()
    assert ex.value == E.NonFiniteInput(row=2, column=1)
    with pytest.raises(E.FeatureCountMismatch):
        RidingCheck(df, named(2), 3)
    check = RidingCheck(df.filter("id < 0"), named(2), 2)
    check.rows.collect()
    with pytest.raises(E.EmptyDataset):
        check.raise_if_bad()


def test_batch_scoring_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = matrix(spark, GOOD * 10).mapInArrow(count, "id long, f array<double>, y double")
    check = RidingCheck(df, "f", 2)
    assert len(model(spark).predict(check.rows, "f", validate=False).collect()) == 40
    check.raise_if_bad()
    assert seen.value == 40


def test_stream_reports_bad_rows(spark):
    root = tempfile.mkdtemp(prefix="tessera-riding-")
    src = os.path.join(root, "src")
    matrix(spark, GOOD).write.parquet(src)
    km = KMeans(2, 20, 1e-9).fit(matrix(spark, GOOD), "f", seed=3)
    calls = []
    check = StreamCheck("km_check", "f", 2, on_bad=lambda batch, row: calls.append((batch, row["first_bad"]["id"])))
    spark.streams.addListener(check)
    try:
        stream = parquet_stream(spark, src, matrix(spark, GOOD).schema, files_per_trigger=100)
        q = score_stream(check.observe(stream), km, "f").writeStream.format("memory").queryName("km_checked").start()
        q.processAllAvailable()
        matrix(spark, [[0, 0], [1, math.nan], [1], [2, 2]]).selectExpr("id + 10 AS id", "f", "y").write.mode("append").parquet(src)
        q.processAllAvailable()
        q.stop()
        for _ in range(100):  # listeners hear of a trigger a little later
            if check.counts["n_rows"] == 8:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(check)
    assert (check.counts["n_rows"], check.counts["n_bad_rows"], check.counts["n_wrong_width"]) == (8, 2, 1)
    assert calls == [(1, 11)] and check.counts["first_bad"] == {"id": 11, "width": 2, "column": 2}
    with pytest.raises(E.NonFiniteInput):
        check.raise_if_bad()
    assert spark.sql("SELECT count(*) AS n FROM km_checked").first()["n"] == 8
