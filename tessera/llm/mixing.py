"""Mixing sources to target weights.

Each document gets a hash-random key; within each source the documents are
range-sorted by that key, a distributed prefix sum of their sizes is taken,
and the source is cut at exactly its budget.  A budget above the source's
size repeats whole epochs first, and the rest is cut from the same order.

Targets share ``share`` times the total size by weight; a source whose part
would exceed ``cap`` times its own size stops there and the excess is shared
among the others by weight, until none is above (closed form: sources sorted
by cap / weight, one running sum over the source table).

Edge cases: null source is a source of its own (last); null or blank texts
have size 0 and are never taken; a very long text counts by its words and may
be taken in part like any other; repeated rows are separate rows of the mix,
equal ones in any order (keys do not tie otherwise); an empty table gives an empty mix.  The document a budget ends in is taken in
part, so that each source's words equal its target to the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checkpointed, counted, n_words, prefix_sums, read, row_key, same_row, with_rows, words

WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2, 7
#: Hex digits of the key that make a range of their own: 4096 ranges a source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """From one row per source (``source``, ``source_size``) the ``target`` of each."""
    all_rows = W.partitionBy(F.lit(0))
    ranked = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(all_rows.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("double").alias("w"),
        (F.col("source_size") * cap).cast("double").alias("most"),
        (F.sum("source_size").over(all_rows) * F.lit(float(share))).alias("total"),
    ).withColumn("weight_sum", F.sum("w").over(all_rows))
    before = all_rows.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    filled = ranked.select(
        "*", F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("most_before"), F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w_before")
    ).withColumn("full", F.col("most") / F.col("w") <= (F.col("total") - F.col("most_before")) / (F.col("weight_sum") - F.col("w_before")))
    rest = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(all_rows)
    rest_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(all_rows)
    level = (F.col("total") - rest) / F.nullif(rest_w, F.lit(0.0))
    return filled.select("source", "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.col("w") * level).alias("target"))


def random_keys(df: DataFrame, seed: int) -> DataFrame:
    """``key``, the MD5 of seed and id; where an id (or a null one) repeats, of
    seed, id, text hash and copy number, so no key is common to many rows."""
    ids = counted(df.groupBy("k_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("k_id").alias("r_id"), F.lit(True).alias("repeated")))
    both = df.join(ids, df["k_id"].eqNullSafe(ids["r_id"]), "left").drop("r_id")
    start = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k_id").cast("string"), F.lit("")))
    alone = both.where("repeated IS NULL").drop("repeated").withColumn("key", F.md5(start))
    # copies are numbered within each input partition, on from those before it
    many = both.where("repeated").drop("repeated").withColumn("part", F.shiftright("row", 33)).withColumn("one", F.lit(1).cast("long"))
    many = prefix_sums(many, {"copy": "one"}, ["k_id", "k_md5", "source"], "part", ["row"])
    many = many.withColumn("key", F.md5(F.concat_ws(":", start, F.col("k_md5"), F.col("copy").cast("string"))))
    return alone.unionByName(many.drop("part", "one", "copy"))


def mix(df: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """From the rows of ``sized`` the same rows with ``source_size``, ``target`` and ``taken``, the words the mix takes of each.

    The order within a source depends on the seed and the rows alone, so
    reruns and any partitioning agree."""
    rows = random_keys(df, seed).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    sizes = df.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap).withColumnRenamed("source", "t_source")
    ordered = prefix_sums(rows, {"before": "size"}, ["source"], "range", ["key", "k_id", "size", "k_text"])
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("CAST(floor(target + 0.5) AS BIGINT) DIV source_size")).otherwise(0)
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("before")
    return (
        ordered.join(targets, ordered["source"].eqNullSafe(targets["t_source"]))
        .withColumn("epochs", epochs)
        .withColumn("taken", (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long"))
        .select(*df.columns, "source_size", "target", "taken")
    )


def sized(docs: DataFrame) -> DataFrame:
    """Narrow rows of the documents; counted once and kept."""
    text = F.col("text").cast("string")
    return checkpointed(docs.select(
        *row_key(docs), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("k_md5"), F.monotonically_increasing_id().alias("row"),
        F.col("source").cast("string").alias("source"), n_words(text).alias("size"),
    ))


def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words of it that the mix takes."""
    taken = mix(sized(read(spark, sf_dir, "documents")))
    return taken.select(F.col("k_id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as
    its words are taken; the last copy of the one document a budget ends in
    has just the words that fit (joined by single spaces)."""
    rows = sized(docs)
    taken = mix(rows, weights, share, cap, seed).where("taken > 0")
    # repeats of one record are one row here, with the words of all of them
    per_key = taken.groupBy("k_id", "k_text").agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
    full = with_rows(docs)
    one = full.groupBy("k_id", "k_text").agg(F.first("row").alias("row")) if _repeats(rows) else full
    joined = one.join(per_key, same_row(one, per_key)).select("row", "taken", "size")
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    left = (F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    cut = F.when(left < F.col("size"), F.concat_ws(" ", F.slice(words(F.col("row.text")), 1, left))).otherwise(F.col("row.text"))
    return copies.select(*[(cut if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("k_id", "k_text").count().where("count > 1").isEmpty()
