"""Where semantics coincide, results agree with Spark MLlib's estimators."""

import numpy as np
from pyspark.ml.clustering import KMeans as MLKMeans
from pyspark.ml.feature import PCA as MLPCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression as MLLinear

from tessera.operators import PCA, KMeans, LinearRegression, Standardiser


def test_kmeans_same_partition_on_separated_data(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0], [20, 0], [0, 20]])
    x = centres[np.arange(90) % 3] + rng.normal(0, 1, (90, 2))
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)], "id long, f array<double>")
    ours = {r["id"]: r["cluster"] for r in KMeans(3, 50, 1e-9).fit(df, "f", seed=7).predict(df, "f").collect()}
    ml = MLKMeans(k=3, seed=1, featuresCol="v").fit(df.withColumn("v", array_to_vector("f")))
    theirs = {r["id"]: r["prediction"] for r in ml.transform(df.withColumn("v", array_to_vector("f"))).collect()}
    pairs = {(ours[i], theirs[i]) for i in ours}
    assert len(pairs) == 3  # the same three groups, labels permuted


def test_pca_unit_scaling_matches_mllib_up_to_sign(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3)) @ np.array([[2.0, 0.5, 0.1], [0.0, 1.0, 0.3], [0.0, 0.0, 0.2]])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, f array<double>")
    ours = PCA(2, scaling="unit").fit(df, "f").transform(df, "f").orderBy("id").collect()
    z = Standardiser().fit(df, "f").transform(df, "f").withColumn("v", array_to_vector("f"))
    ml = MLPCA(k=2, inputCol="v", outputCol="p").fit(z)
    theirs = ml.transform(z).select("id", vector_to_array("p").alias("p")).orderBy("id").collect()
    a = np.array([[r["pc1"], r["pc2"]] for r in ours])
    b = np.array([r["p"] for r in theirs])
    for j in range(2):
        assert np.allclose(np.abs(a[:, j]), np.abs(b[:, j]), atol=1e-9)


def test_linear_reaches_the_least_squares_optimum(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    y = 1.5 + x @ np.array([2.0, -1.0]) + rng.normal(0, 0.1, 200)
    df = spark.createDataFrame([(i, [float(a), float(b)], float(t)) for i, ((a, b), t) in enumerate(zip(x, y))],
                               "id long, f array<double>, y double")
    ours = LinearRegression(0.5, 3000).fit(df, "f", "y").weights
    ml = MLLinear(featuresCol="v", labelCol="y", regParam=0.0, solver="normal").fit(df.withColumn("v", array_to_vector("f")))
    assert np.allclose(ours, [ml.intercept, *ml.coefficients.toArray()], atol=1e-8)
