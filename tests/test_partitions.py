"""Same answer whatever the partitioning (1, 4 and 16 partitions)."""

import numpy as np

from tessera.operators import KMeans, KNeighborsRegressor, LinearRegression, standardise
from tessera.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_partition_independence(spark):
    parts = T.part_features(spark, SF)
    results = []
    for n in (1, 4, 16):
        df = standardise(parts.repartition(n), ["p_size", "p_retailprice"], "p_partkey")
        km = KMeans(3, 100, 1e-9).fit(df, ["p_size", "p_retailprice"], "p_partkey", seed=7)
        lin = LinearRegression(0.1, 50).fit(df.withColumn("y", df.p_size * 2.0), ["p_retailprice"], "y", "p_partkey")
        knn = KNeighborsRegressor(3, "distance").fit(df.withColumn("y", df.p_size), ["p_retailprice"], "y", "p_partkey")
        preds = sorted(tuple(r) for r in knn.predict(df, ["p_retailprice"], "p_partkey").collect())
        results.append((km.centroids, km.iterations, lin.weights, preds))
    for c, it, w, p in results[1:]:
        assert np.allclose(c, results[0][0], atol=1e-12) and it == results[0][1]
        assert np.allclose(w, results[0][2], atol=1e-12)
        assert [a[0] for a in p] == [a[0] for a in results[0][3]]
        assert np.allclose([a[1] for a in p], [a[1] for a in results[0][3]], atol=1e-9)
