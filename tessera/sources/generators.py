"""Deterministic synthetic inputs for benchmarks and tests, built with
``spark.range`` so they are generated in parallel on the executors.

Row ``i`` is the id; features are ``x1..xd``.  These are not registered
reports (the reports read the driver tables); they reproduce the shapes the
compatible library benchmarks with: k-means 100 / 1,000 rows x 4 (k=4,
seed 7), PCA 64 / 128 x 4, regression 128 / 1,024 x 4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Benchmark data formulas, for row i and feature f (0-based),
# g = f + 1 and c = i % 4.
#   k-means rows:     10c + 0.5f + 0.05 * sin(0.137i + 0.413f) + 0.01c
#   k-means queries:  10c + 0.25f + 0.001i
#   PCA rows:         sin(i*g*0.031) + cos(i*g*0.017) + i*g*0.002
#   regression rows:  sin(i*g*0.011) + i*g*0.004 + 0.5g
#   linear target:    1.25 + 2.5x1 - 1.2x2 + 0.75x3 + 0.33x4
#   logistic target:  1 if -0.5 + 0.8x1 - 1.1x2 + 0.6x3 + 0.4x4 >= 0 else 0
BENCH_KMEANS_K, BENCH_KMEANS_SEED, BENCH_KMEANS_MAX_ITER, BENCH_KMEANS_TOL = 4, 7, 100, 1e-8
BENCH_LINEAR = (0.05, 400)
BENCH_LOGISTIC = (0.08, 500)


def _frame(spark: SparkSession, n: int, d: int, cell) -> DataFrame:
    i = F.col("id").cast("double")
    return spark.range(n).select(F.col("id"), *[cell(i, f).alias(f"x{f + 1}") for f in range(d)])


def kmeans_rows(spark: SparkSession, n: int, d: int = 4) -> DataFrame:
    def cell(i: Column, f: int) -> Column:
        c = (F.col("id") % 4).cast("double")
        centre = c * 10.0 + F.lit(0.5 * f)
        return centre + F.sin(i * 0.137 + F.lit(f * 0.413)) * 0.05 + c * 0.01

    return _frame(spark, n, d, cell)


def kmeans_queries(spark: SparkSession, n: int, d: int = 4) -> DataFrame:
    def cell(i: Column, f: int) -> Column:
        c = (F.col("id") % 4).cast("double")
        return c * 10.0 + F.lit(f * 0.25) + i * 0.001

    return _frame(spark, n, d, cell)


def pca_rows(spark: SparkSession, n: int, d: int = 4) -> DataFrame:
    def cell(i: Column, f: int) -> Column:
        g = float(f + 1)
        return F.sin(i * g * 0.031) + F.cos(i * g * 0.017) + i * g * 0.002

    return _frame(spark, n, d, cell)


def regression_rows(spark: SparkSession, n: int, d: int = 4) -> DataFrame:
    def cell(i: Column, f: int) -> Column:
        g = float(f + 1)
        return F.sin(i * g * 0.011) + i * g * 0.004 + F.lit(g * 0.5)

    return _frame(spark, n, d, cell)


def with_linear_target(df: DataFrame, name: str = "y") -> DataFrame:
    x = [F.col(f"x{j}") for j in range(1, 5)]
    return df.withColumn(name, F.lit(1.25) + x[0] * 2.5 - x[1] * 1.2 + x[2] * 0.75 + x[3] * 0.33)


def with_logistic_target(df: DataFrame, name: str = "y") -> DataFrame:
    x = [F.col(f"x{j}") for j in range(1, 5)]
    score = F.lit(-0.5) + x[0] * 0.8 - x[1] * 1.1 + x[2] * 0.6 + x[3] * 0.4
    return df.withColumn(name, F.when(score >= 0.0, 1.0).otherwise(0.0))
