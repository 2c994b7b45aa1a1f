"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def connected(edges: DataFrame) -> DataFrame:
    """From undirected edges (``u``, ``v``; long) one row per node that has an
    edge: ``node``, ``root`` (the smallest node of its component).

    Alternating large-star and small-star steps (O(log n) rounds in practice);
    each round is checkpointed to the shared folder, so lineage stays short
    and a lost executor costs no more than a round.  Minima are taken by
    partial aggregation; the joins back are plain shuffles that Spark may
    split where a node has very many edges."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    e = checkpointed(e)
    state = _state(e)
    while True:
        # large star: the larger neighbours of each node move to its minimum
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        big = both.join(low, both["u"] == low["n"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours meet at the minimum
        low = big.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        sub = big.join(low, big["u"] == low["n"])
        moved = sub.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(moved.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct())
        now = _state(e)
        if now == state:
            break
        state = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
