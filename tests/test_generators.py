import numpy as np

from tessera.operators import KMeans, LinearRegression, initial_ranks
from tessera.sources import generators as G

FEATURES = ["x1", "x2", "x3", "x4"]


def test_kmeans_bench_data(spark):
    assert initial_ranks(7, 4, 100) == [98, 97, 76, 51]
    assert initial_ranks(7, 4, 1000) == [898, 697, 676, 51]
    for n in (100, 1000):
        df = G.kmeans_rows(spark, n)
        model = KMeans(G.BENCH_KMEANS_K, G.BENCH_KMEANS_MAX_ITER, G.BENCH_KMEANS_TOL).fit(
            df, FEATURES, seed=G.BENCH_KMEANS_SEED
        )
        assert model.iterations == 2
        assert sorted(model.sizes) == [n // 4] * 4
        q = model.predict(G.kmeans_queries(spark, 8), FEATURES).orderBy("id").collect()
        assert len({r["cluster"] for r in q}) == 4


def test_regression_bench_data(spark):
    df = G.with_linear_target(G.regression_rows(spark, 128))
    assert df.filter("y IS NULL").count() == 0
    m = LinearRegression(*G.BENCH_LINEAR).fit(df, FEATURES, "y")
    assert np.all(np.isfinite(m.weights))
    logistic = G.with_logistic_target(G.regression_rows(spark, 128))
    assert logistic.agg({"y": "min"}).first()[0] == 1.0  # every target is 1 for this formula
    assert G.pca_rows(spark, 64).count() == 64
