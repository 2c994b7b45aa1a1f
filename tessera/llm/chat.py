"""Chat formatting with cumulative-snapshot collapse.

A chat service that logs a conversation after every turn leaves many records
that are prefixes of longer ones.  A rolling hash of each turn prefix (role
and text of every turn so far, in order) identifies them: a conversation whose
whole hash is the hash of a proper prefix of another one is dropped by an
anti-join, equal conversations keep the smallest id, and the maximal ones are
rendered.

The rolling hash is a running sum of position-tagged turn hashes, four sums
of 32 bits each (128 bits): it needs no ordered fold, so a long conversation
is summed in blocks of turns and never gathered in one task.

Edge cases: rows repeated in all four columns count once; turns of equal
number go by their hash; a null turn comes last, a null role or text differs
from an empty one and renders as empty; rows without conv_id are one
conversation; an empty table gives no rows.  A conversation is rendered in
segments of ``SEGMENT`` turn numbers, one row each (one row for nearly all).
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, prefix_sums, read

SEGMENT = 1024
LAST_TURN = 2**62
HALF = 2**32


def _turns(conv: DataFrame) -> DataFrame:
    return conv.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )


def turn_hashes() -> tuple[Column, Column]:
    parts = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *reversed(parts))


def prefix_hashes(conv: DataFrame) -> DataFrame:
    """conv_id, length, p1, p2: the rolling hash after each turn."""
    h1, h2 = turn_hashes()
    rows = _turns(conv).select("conv_id", "turn", h1.alias("h1"), h2.alias("h2")).distinct()
    rows = rows.withColumn("part", F.floor(F.col("turn") / SEGMENT)).withColumn("one", F.lit(1).cast("long"))
    order = ["turn", "h1", "h2"]
    placed = prefix_sums(rows, {"pos": "one"}, ["conv_id"], "part", order)
    tags = [F.xxhash64("pos", "h1", "h2"), F.xxhash64("h2", "h1", "pos")]
    for i, t in enumerate(tags):
        placed = placed.withColumn(f"a{i}", F.pmod(t, F.lit(HALF))).withColumn(f"b{i}", F.shiftrightunsigned(t, 32))
    names = ["a0", "b0", "a1", "b1"]
    rolled = prefix_sums(placed, {f"s_{c}": c for c in names}, ["conv_id"], "part", order)
    sums = [F.col(f"s_{c}") + F.col(c) for c in names]
    return rolled.select("conv_id", (F.col("pos") + 1).alias("length"), F.xxhash64(sums[0], sums[1]).alias("p1"), F.xxhash64(sums[2], sums[3]).alias("p2"))


def maximal(conv: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no longer one
    starts with; of equal ones the smallest id."""
    prefixes = checkpointed(prefix_hashes(conv))
    key = ["length", "p1", "p2"]
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("w")).select("conv_id", "w.*")
    groups = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    # a hash reached by more conversations than end there is a proper prefix
    reached = prefixes.groupBy(*key).agg(F.count("*").alias("n_reached"))
    proper = reached.join(groups, key, "left").where("n_reached > coalesce(n_copies, 0)").select(*key)
    return groups.join(proper, key, "left_anti").select("conv_id", F.col("length").alias("n_turns"), "n_copies")


def render(conv: DataFrame, kept: DataFrame) -> DataFrame:
    """conv_id, segment, n_turns, n_copies, text: ``<|role|>`` line, text and
    ``<|end|>`` per turn; ``<|`` within a text is written ``<||``."""
    h1, h2 = turn_hashes()
    turns = _turns(conv)
    k = kept.withColumnRenamed("conv_id", "k_conv")
    mine = turns.join(k, turns["conv_id"].eqNullSafe(k["k_conv"])).drop("k_conv").withColumn("h1", h1).withColumn("h2", h2)
    safe = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("<||"))
    shown = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), safe, F.lit("<|end|>\n"))
    segment = F.when(F.col("turn") == LAST_TURN, F.lit(LAST_TURN)).otherwise(F.floor(F.col("turn") / SEGMENT)).alias("segment")
    one = mine.select("conv_id", segment, "n_turns", "n_copies", F.struct("turn", "h1", "h2", shown.alias("shown")).alias("t"))
    out = one.groupBy("conv_id", "segment", "n_turns", "n_copies").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return out.select("conv_id", "segment", "n_turns", "n_copies", F.array_join(F.col("t.shown"), "").alias("text"))


def format_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    conv = read(spark, sf_dir, "conversations")
    return render(conv, maximal(conv))
