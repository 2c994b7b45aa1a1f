import math

import pytest

from tessera import errors as E
from tessera.operators import column_distance, distance_to_group_mean, pairwise_distance


def pairs(spark, rows):
    return spark.createDataFrame(
        [(i, [float(v) for v in a], [float(v) for v in b]) for i, (a, b) in enumerate(rows)],
        "id long, l array<double>, r array<double>",
    )


def dist(spark, a, b, metric):
    out = pairwise_distance(pairs(spark, [(a, b)]), "l", "r", metric).first()
    return out["distance"]


def test_reference_values(spark):
    df = pairs(spark, [([0, 0], [3, 4]), ([3, 4], [0, 0]), ([3, 4], [3, 4]), ([1, 2], [4, 6]), ([1, 2, 3], [4, 5, 6])])
    e = {r["id"]: r["distance"] for r in pairwise_distance(df, "l", "r", "euclidean").collect()}
    m = {r["id"]: r["distance"] for r in pairwise_distance(df, "l", "r", "manhattan").collect()}
    assert e == {0: 5.0, 1: 5.0, 2: 0.0, 3: 5.0, 4: 5.196152422706632}
    assert m[0] == 7.0 and m[1] == 7.0 and m[2] == 0.0 and m[4] == 9.0


def test_vector_errors(spark):
    with pytest.raises(E.EmptyVector):
        dist(spark, [], [3], "euclidean")
    with pytest.raises(E.EmptyVector):
        dist(spark, [3], [], "euclidean")
    with pytest.raises(E.VectorLengthMismatch) as ex:
        dist(spark, [1, 2], [3], "euclidean")
    assert (ex.value.left, ex.value.right) == (2, 1)
    assert str(ex.value) == "left vector has length 2 but right vector has length 1"
    with pytest.raises(E.VectorLengthMismatch) as ex:
        dist(spark, [3], [1, 2], "manhattan")
    assert (ex.value.left, ex.value.right) == (1, 2)
    with pytest.raises(E.NonFiniteVectorInput) as ex:
        dist(spark, [1, math.nan], [1, 2], "euclidean")
    assert ex.value.index == 2
    with pytest.raises(E.NonFiniteVectorInput) as ex:
        dist(spark, [1, 2], [1, math.inf], "euclidean")
    assert ex.value.index == 2


def test_first_bad_row_decides(spark):
    df = pairs(spark, [([1], [1]), ([1, 2], [3]), ([], [1])])
    with pytest.raises(E.VectorLengthMismatch):
        pairwise_distance(df, "l", "r")


def test_column_distance(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0, 3.0, 4.0)], "id long, a double, b double, c double, d double")
    assert column_distance(df, ["a", "b"], ["c", "d"]).first()["distance"] == 5.0
    assert column_distance(df, ["a", "b"], ["c", "d"], "manhattan").first()["distance"] == 7.0


def test_distance_to_group_mean(spark):
    df = spark.createDataFrame(
        [(0, "a", [0.0, 0.0]), (1, "a", [2.0, 0.0]), (2, "b", [5.0, 5.0])], "id long, g string, v array<double>"
    )
    out = {r["id"]: r["distance"] for r in distance_to_group_mean(df, "v", "id", "g").collect()}
    assert out == {0: 1.0, 1: 1.0, 2: 0.0}
