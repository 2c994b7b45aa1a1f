"""Parquet sources and the feature tables the registered queries use.

Every reader names its columns, so Catalyst prunes the Parquet scan to them
(``ReadSchema``) and pushes filters into it (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Orders of this year and later are the "query" side of the nearest-neighbour
# reports (predict the latest year from all earlier orders).
KNN_QUERY_YEAR = 2001


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order (whole orders table): order price, date and
    per-order line aggregates.  Orders without lines get zero counts.

    Line aggregation is partial per task then final per key, and the
    aggregated side is keyed by order like the orders table, so the join is a
    co-partitioned shuffle join (or a broadcast if AQE measures it small).
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"])
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.sum("l_extendedprice").alias("sum_price"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("sum_net"),
    )
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    j = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey"),
        F.col("o_orderdate"),
        F.col("o_totalprice"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("double").alias("n_lines"),
        F.coalesce(F.col("sum_qty"), F.lit(0.0)).alias("sum_qty"),
        F.coalesce(F.col("sum_price"), F.lit(0.0)).alias("sum_price"),
        F.coalesce(F.col("sum_net"), F.lit(0.0)).alias("sum_net"),
    )


def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order gross and net line revenue (two strongly correlated columns),
    from the whole lineitem table; id = l_orderkey."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    return li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("gross"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net"),
    )


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", ["p_partkey", "p_size", "p_retailprice"]).select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice"
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: id, length in characters and number of spaces (a
    word-count proxy), computed over the whole text."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars", "text"])
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry a label, with the quality flag as target."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return document_features(spark, sf_dir).join(labels, "doc_id").select(
        "doc_id", "n_chars", "n_spaces", F.col("quality").cast("double").alias("quality"), "toxic"
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
