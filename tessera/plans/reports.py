"""Registered reports: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every report reads whole tables (or data Spark derives from them).  Floating
results are rounded (and -0.0 folded into 0.0) so that value hashes agree
across engines whose summation orders differ.

Fitted models and derived feature tables are memoised per session and data
folder (until a file in it changes), so the reports of one model (weights / predictions / loss) share a
single fit, and a derived table feeding several jobs is computed once
(``release()`` drops them).  Fits run when a report is built; scoring stays
lazy until the returned DataFrame is used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import as_matrix
from ..functions import vector as V
from ..functions.vector import rounded
from ..operators import checks, distance, scaling
from ..operators.kmeans import KMeans
from ..operators.knn import KNeighborsRegressor, predictions_from_neighbours
from ..operators.pca import PCA
from ..operators.regression import LinearRegression, LogisticRegression
from ..session import folder_version, persist, session_key
from ..sources import tables as T

Report = Callable[[SparkSession, str], DataFrame]

ORDER_FEATURES = ["o_totalprice", "n_lines", "sum_qty", "sum_price"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _round_cols(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[rounded(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# --- 2.1 checks --------------------------------------------------------------


def check_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = T.embeddings(spark, sf_dir)
    return checks.matrix_report(as_matrix(emb, "embedding", "vec_id"))


def check_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.read_table(spark, sf_dir, "documents", ["doc_id"])
    labels = T.read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return checks.target_report(docs.join(labels, "doc_id", "left"), "doc_id", "quality")


def check_logistic_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = T.read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return checks.logistic_target_report(labels, "doc_id", "toxic")


def check_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = T.read_table(spark, sf_dir, "lineitem", ["l_orderkey"] + LINE_COLUMNS)
    return checks.variance_report(as_matrix(li, LINE_COLUMNS, "l_orderkey"))


# --- 2.3 statistics and scaling -------------------------------------------------


def column_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scaling.column_moments(T.order_features(spark, sf_dir), ORDER_FEATURES, "o_orderkey")
    return _round_cols(df, {"mean": 6, "stddev": 6})


def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _shared(spark, "orders", sf_dir, lambda: T.order_features(spark, sf_dir))
    df = scaling.standardise(orders, ORDER_FEATURES, "o_orderkey")
    return _round_cols(df, {c: 6 for c in ORDER_FEATURES})


def covariance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _shared(spark, "orders", sf_dir, lambda: T.order_features(spark, sf_dir))
    df = scaling.covariance_matrix(orders, ORDER_FEATURES, "o_orderkey")
    return _round_cols(df, {"covariance": 6})


# --- 2.2 distances ---------------------------------------------------------------


def _to_class_centre(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    emb = T.embeddings(spark, sf_dir)
    means = _memo(
        spark, "label_means", sf_dir,
        lambda: (lambda m: (persist(m[0]), m[1]))(distance.group_means(emb, "embedding", "vec_id", "label")),
    )
    df = distance.distance_to_group_mean(emb, "embedding", "vec_id", "label", metric, means=means)
    return _round_cols(df, {"distance": 6})


def distance_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's Euclidean distance to its label's mean vector."""
    return _to_class_centre(spark, sf_dir, "euclidean")


def distance_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_class_centre(spark, sf_dir, "manhattan")


def _pairwise(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Each embedding beside its label's mean vector, through the checked
    pair distance (null-safe on the label, so no row is lost)."""
    emb = T.embeddings(spark, sf_dir)
    means, _ = distance.group_means(emb, "embedding", "vec_id", "label")
    means = means.withColumnRenamed("label", "_label")
    pairs = emb.join(means, emb["label"].eqNullSafe(means["_label"])).select("vec_id", "label", "embedding", "_centre")
    out = distance.pairwise_distance(pairs, "embedding", "_centre", metric, "vec_id")
    return _round_cols(out.select("vec_id", "label", "distance"), {"distance": 6})


def pairwise_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairwise(spark, sf_dir, "euclidean")


def pairwise_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairwise(spark, sf_dir, "manhattan")


def distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-neighbour join of all embeddings against all embeddings: the
    5 nearest (itself included, rank 1 at distance 0)."""
    emb = T.embeddings(spark, sf_dir)
    model = KNeighborsRegressor(5).fit(emb.withColumn("y", F.col("label").cast("double")), "embedding", "y", "vec_id")
    nb = model.neighbours(emb, "embedding", "vec_id")
    return _round_cols(nb.select("query_id", "rank", "train_id", "distance"), {"distance": 6})


# --- 2.4 k-means --------------------------------------------------------------------

KMEANS_K, KMEANS_MAX_ITER, KMEANS_TOL, KMEANS_SEED = 3, 100, 1e-9, 7
PART_FEATURES = ["p_size", "p_retailprice"]
_FITS: dict = {}


def _memo(spark: SparkSession, name: str, sf_dir: str, fn):
    """One result per session and folder, made again when a file of the
    folder changes (name, size or time)."""
    key, version = (name, sf_dir, session_key(spark)), folder_version(spark, sf_dir)
    if key in _FITS and _FITS[key][0] != version:
        _drop(_FITS.pop(key)[1])
    if key not in _FITS:
        _FITS[key] = (version, fn())
    return _FITS[key][1]


def _drop(held) -> None:
    for item in held if isinstance(held, tuple) else (held,):
        if isinstance(item, DataFrame):
            item.unpersist()


def _shared(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """A derived feature table used by several jobs (checks, moments, fit,
    loss, scoring), computed once per session and kept with MEMORY_AND_DISK."""
    return _memo(spark, name, sf_dir, lambda: persist(build()))


def release() -> None:
    """Drop memoised models and unpersist shared feature tables."""
    for _, held in _FITS.values():
        _drop(held)
    _FITS.clear()


def _standardised_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _shared(spark, "parts", sf_dir, lambda: T.part_features(spark, sf_dir))
    return scaling.standardise(parts, PART_FEATURES, "p_partkey")


def _kmeans(spark: SparkSession, sf_dir: str):
    z = _standardised_parts(spark, sf_dir)
    return z, _memo(
        spark, "kmeans", sf_dir,
        lambda: KMeans(KMEANS_K, KMEANS_MAX_ITER, KMEANS_TOL).fit(z, PART_FEATURES, "p_partkey", seed=KMEANS_SEED),
    )


def kmeans_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _kmeans(spark, sf_dir)
    return _round_cols(model.centroids_frame(spark), {"c1": 6, "c2": 6})


def kmeans_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, model = _kmeans(spark, sf_dir)
    return model.predict(z, PART_FEATURES, "p_partkey", validate=False).select("p_partkey", "cluster")


EMBEDDING_K, EMBEDDING_MAX_ITER = 8, 200


def kmeans_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide vectors: the cluster of every 64-d embedding."""
    emb = _shared(spark, "embeddings", sf_dir, lambda: T.embeddings(spark, sf_dir))
    model = _memo(
        spark, "kmeans_embeddings", sf_dir,
        lambda: KMeans(EMBEDDING_K, EMBEDDING_MAX_ITER, KMEANS_TOL).fit(emb, "embedding", "vec_id", seed=KMEANS_SEED),
    )
    return model.predict(emb, "embedding", "vec_id", validate=False).select("vec_id", "cluster")


# --- 2.5 PCA ------------------------------------------------------------------------

REVENUE = ["gross", "net"]


def _pca(spark: SparkSession, sf_dir: str):
    rev = _shared(spark, "revenue", sf_dir, lambda: T.order_revenue(spark, sf_dir))
    return rev, _memo(spark, "pca", sf_dir, lambda: PCA(2).fit(rev, REVENUE, "l_orderkey"))


def pca_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev, model = _pca(spark, sf_dir)
    return _round_cols(model.transform(rev, REVENUE, "l_orderkey", validate=False), {"pc1": 6, "pc2": 6})


def pca_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _pca(spark, sf_dir)
    return _round_cols(model.components_frame(spark), {"eigenvalue": 6, "loading": 6})


# --- 2.6 nearest-neighbour regression ---------------------------------------------------

KNN_K = 5
KNN_FEATURES = ["n_lines", "sum_qty"]


def _knn_split(spark: SparkSession, sf_dir: str):
    """Train on orders before the last year, predict the orders of the last
    year (together: the whole orders table)."""
    of = _shared(spark, "orders", sf_dir, lambda: T.order_features(spark, sf_dir))
    latest = F.coalesce(F.year("o_orderdate") >= F.lit(T.KNN_QUERY_YEAR), F.lit(False))  # no date: training side
    return of.filter(~latest), of.filter(latest)


def _knn_neighbours(spark: SparkSession, sf_dir: str, features: list[str], metric: str) -> DataFrame:
    """The k nearest training orders of every query order; the weighting only
    changes the final fold, so one neighbour table serves every weighting."""

    def build():
        train, query = _knn_split(spark, sf_dir)
        model = KNeighborsRegressor(KNN_K, "uniform", metric).fit(train, features, "o_totalprice", "o_orderkey")
        return model.neighbours(query, features, "o_orderkey")

    return _shared(spark, f"knn:{','.join(features)}:{metric}", sf_dir, build)


def _knn_predict(spark, sf_dir, weighting, metric, features) -> DataFrame:
    nb = _knn_neighbours(spark, sf_dir, features, metric)
    pred = predictions_from_neighbours(nb, weighting)
    return _round_cols(pred, {"prediction": 4})


def knn_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    nb = _knn_neighbours(spark, sf_dir, KNN_FEATURES, "euclidean")
    return _round_cols(nb.select("query_id", "rank", "train_id", "distance"), {"distance": 6})


def knn_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_predict(spark, sf_dir, "uniform", "euclidean", KNN_FEATURES)


def knn_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_predict(spark, sf_dir, "distance", "euclidean", KNN_FEATURES)


def knn_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance weighting on the line count alone: nearly every query has
    zero-distance neighbours, so the exact-match rule and the id tie-break
    decide the result."""
    return _knn_predict(spark, sf_dir, "distance", "euclidean", ["n_lines"])


def knn_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_predict(spark, sf_dir, "distance", "manhattan", KNN_FEATURES)


# --- 2.7 linear regression ------------------------------------------------------------

LINEAR_FEATURES = ["n_lines", "sum_qty", "sum_price"]
LINEAR_LR, LINEAR_ITERATIONS = 0.1, 300


def _linear(spark: SparkSession, sf_dir: str):
    of = _shared(spark, "orders", sf_dir, lambda: T.order_features(spark, sf_dir))
    of = of.withColumn("price_k", F.col("o_totalprice") / F.lit(1000.0))
    scaler = _memo(spark, "linear scaler", sf_dir, lambda: scaling.Standardiser().fit(of, LINEAR_FEATURES, "o_orderkey"))
    z = scaler.transform(of, LINEAR_FEATURES, "o_orderkey", keep=["price_k"], validate=False)
    return z, _memo(
        spark, "linear", sf_dir,
        lambda: LinearRegression(LINEAR_LR, LINEAR_ITERATIONS).fit(z, LINEAR_FEATURES, "price_k", "o_orderkey"),
    )


def linear_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _linear(spark, sf_dir)
    return _round_cols(model.weights_frame(spark), {"weight": 6})


def linear_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, model = _linear(spark, sf_dir)
    out = model.predict(z, LINEAR_FEATURES, "o_orderkey", validate=False)
    return _round_cols(out.select("o_orderkey", "prediction"), {"prediction": 6})


def linear_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _linear(spark, sf_dir)
    return _round_cols(model.loss_frame(spark), {"loss": 4})


# --- 2.8 logistic regression -------------------------------------------------------------

DOC_FEATURES = ["n_chars", "n_spaces"]
LOGISTIC_LR, LOGISTIC_ITERATIONS = 0.1, 150


def _logistic(spark: SparkSession, sf_dir: str):
    docs = _shared(spark, "labelled_docs", sf_dir, lambda: T.labelled_documents(spark, sf_dir))
    scaler = _memo(spark, "logistic scaler", sf_dir, lambda: scaling.Standardiser().fit(docs, DOC_FEATURES, "doc_id"))
    z = scaler.transform(docs, DOC_FEATURES, "doc_id", keep=["quality"], validate=False)
    return z, _memo(
        spark, "logistic", sf_dir,
        lambda: LogisticRegression(LOGISTIC_LR, LOGISTIC_ITERATIONS).fit(z, DOC_FEATURES, "quality", "doc_id"),
    )


def logistic_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _logistic(spark, sf_dir)
    return _round_cols(model.weights_frame(spark), {"weight": 6})


def logistic_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, model = _logistic(spark, sf_dir)
    out = model.predict(z, DOC_FEATURES, "doc_id", validate=False)
    return _round_cols(out.select("doc_id", "prediction"), {"prediction": 6})


def logistic_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _logistic(spark, sf_dir)
    return _round_cols(model.loss_frame(spark), {"loss": 6})


EMBEDDING_LR, EMBEDDING_ITERATIONS = 0.5, 40


def logistic_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide vectors: weights of a fit on every labelled 64-d embedding, its
    label mapped into [0, 1) as label / (label + 1)."""
    emb = _shared(spark, "embeddings", sf_dir, lambda: T.embeddings(spark, sf_dir))
    rows = emb.filter("label IS NOT NULL").withColumn("share", F.col("label") / (F.col("label") + F.lit(1.0)))
    model = _memo(
        spark, "logistic_embeddings", sf_dir,
        lambda: LogisticRegression(EMBEDDING_LR, EMBEDDING_ITERATIONS).fit(rows, "embedding", "share", "vec_id"),
    )
    return _round_cols(model.weights_frame(spark), {"weight": 6})


def sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sigmoid of every document's standardised length."""
    docs = T.document_features(spark, sf_dir)
    z = scaling.standardise(docs, ["n_chars"], "doc_id")
    return _round_cols(z.select("doc_id", V.sigmoid(F.col("n_chars")).alias("score")), {"score": 6})


def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per labelled document: log-loss of the sigmoid of its standardised
    length against its quality label."""
    z = scaling.standardise(T.labelled_documents(spark, sf_dir), ["n_chars"], "doc_id", keep=["quality"])
    p = V.sigmoid(F.col("n_chars"))
    return _round_cols(z.select("doc_id", V.log_loss(p, F.col("quality")).alias("loss")), {"loss": 6})


REPORTS: dict[str, Report] = {
    "check_matrix": check_matrix,
    "check_targets": check_targets,
    "check_logistic_targets": check_logistic_targets,
    "check_variance": check_variance,
    "column_moments": column_moments,
    "standardise": standardise,
    "covariance_matrix": covariance_matrix,
    "distance_euclidean": distance_euclidean,
    "distance_manhattan": distance_manhattan,
    "pairwise_euclidean": pairwise_euclidean,
    "pairwise_manhattan": pairwise_manhattan,
    "distance_join": distance_join,
    "kmeans_centroids": kmeans_centroids,
    "kmeans_predict": kmeans_predict,
    "kmeans_embeddings": kmeans_embeddings,
    "pca_transform": pca_transform,
    "pca_components": pca_components,
    "knn_neighbours": knn_neighbours,
    "knn_uniform": knn_uniform,
    "knn_distance": knn_distance,
    "knn_exact_match": knn_exact_match,
    "knn_manhattan": knn_manhattan,
    "linear_weights": linear_weights,
    "linear_predict": linear_predict,
    "linear_loss": linear_loss,
    "sigmoid": sigmoid,
    "log_loss": log_loss,
    "logistic_weights": logistic_weights,
    "logistic_predict": logistic_predict,
    "logistic_loss": logistic_loss,
    "logistic_embeddings": logistic_embeddings,
}

#: Tables that several reports share; the bench times each on its own.
SHARED: dict[str, Report] = {
    "shared_orders": lambda spark, sf_dir: _shared(spark, "orders", sf_dir, lambda: T.order_features(spark, sf_dir)),
    "shared_neighbours": lambda spark, sf_dir: _knn_neighbours(spark, sf_dir, KNN_FEATURES, "euclidean"),
    "shared_documents": lambda spark, sf_dir: _shared(spark, "labelled_docs", sf_dir, lambda: T.labelled_documents(spark, sf_dir)),
}
