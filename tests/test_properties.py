"""Property checks; each hypothesis example batches 32 cases into one DataFrame."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import KNeighborsRegressor, pairwise_distance, standardise

CASES = 32
vec_pair = st.integers(1, 8).flatmap(
    lambda n: st.tuples(
        st.lists(st.integers(-20, 20).map(lambda v: v / 3), min_size=n, max_size=n),
        st.lists(st.integers(-20, 20).map(lambda v: v / 3), min_size=n, max_size=n),
    )
)
slow = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


@slow
@given(st.lists(vec_pair, min_size=CASES, max_size=CASES))
def test_distance_properties(spark, pairs):
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows += [(3 * i, a, b), (3 * i + 1, b, a), (3 * i + 2, a, a)]
    df = spark.createDataFrame(rows, "id long, l array<double>, r array<double>")
    for metric in ("euclidean", "manhattan"):
        d = {r["id"]: r["distance"] for r in pairwise_distance(df, "l", "r", metric).collect()}
        for i in range(len(pairs)):
            assert d[3 * i] >= 0 and d[3 * i] == d[3 * i + 1] and d[3 * i + 2] == 0.0


@slow
@given(st.integers(3, 7), st.integers(2, 5), st.floats(-5, 5), st.floats(0.5, 3))
def test_standardised_columns(spark, n, d, intercept, slope):
    rows = [(i, [intercept + slope * i + 0.25 * j + (0.1 * j * i * i) for j in range(d)]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, f array<double>")
    z = np.array([r["f"] for r in standardise(df, "f").orderBy("id").collect()])
    assert np.allclose(z.mean(axis=0), 0, atol=1e-10)
    assert np.allclose(z.std(axis=0, ddof=1), 1, atol=1e-10)


@slow
@given(st.lists(st.integers(-50, 50).map(lambda v: v / 5), min_size=3, max_size=6), st.integers(1, 6))
def test_uniform_knn_within_target_range(spark, targets, k):
    k = min(k, len(targets))
    x = [[float(2 * i)] for i in range(len(targets))]
    train = spark.createDataFrame([(i, x[i], float(t)) for i, t in enumerate(targets)], "id long, f array<double>, y double")
    queries = spark.range(21).select(F.col("id"), F.array((F.col("id") / 2 - 0.5).cast("double")).alias("f"))
    preds = KNeighborsRegressor(k).fit(train, "f", "y").predict(queries, "f").collect()
    assert len(preds) == 21
    assert all(min(targets) - 1e-12 <= r["prediction"] <= max(targets) + 1e-12 for r in preds)


@slow
@given(st.integers(3, 8), st.floats(0.1, 2.0), st.floats(-1.0, 1.0))
def test_pca_shape_and_finite(spark, n, slope, curve):
    from tessera.operators import PCA

    rows = [(i, [float(i), slope * i + curve * i * i]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, f array<double>")
    out = PCA(2, scaling="unit").fit(df, "f").transform(df, "f").collect()
    assert len(out) == n
    assert all(np.isfinite([r["pc1"], r["pc2"]]).all() for r in out)


@slow
@given(st.integers(0, 2**63))
def test_kmeans_same_outcome_for_a_seed(spark, seed):
    from tessera import errors as E
    from tessera.operators import KMeans

    rows = [(i, v) for i, v in enumerate([[0.0, 0.0], [0.0, 1.0], [10.0, 10.0], [10.0, 11.0], [20.0, 20.0], [20.0, 21.0]])]
    df = spark.createDataFrame(rows, "id long, f array<double>")

    def outcome():
        try:
            m = KMeans(2, 32, 1e-12).fit(df, "f", seed=seed)
            return ("ok", m.centroids.tolist(), m.iterations)
        except E.TesseraError as err:
            return ("error", repr(err))

    assert outcome() == outcome()


@slow
@given(st.sampled_from([0.01, 0.05, 0.25]), st.integers(5, 25))
def test_logistic_bounded_and_monotone(spark, lr, iterations):
    from tessera.operators import LogisticRegression

    train = spark.createDataFrame([(i, [x], y) for i, (x, y) in enumerate([(-2.0, 0.0), (-1.0, 0.0), (1.0, 1.0), (2.0, 1.0)])],
                                  "id long, f array<double>, y double")
    model = LogisticRegression(lr, iterations).fit(train, "f", "y")
    grid = spark.createDataFrame([(i, [x]) for i, x in enumerate([-3.0, -1.0, 0.0, 1.0, 3.0])], "id long, f array<double>")
    scores = [r["prediction"] for r in model.predict(grid, "f").orderBy("id").collect()]
    assert all(0.0 <= s <= 1.0 for s in scores) and scores == sorted(scores)
