"""Benchmark decontamination with SimHash over item-sized windows.

Texts are lower-cased and cut into words of letters and digits; a shingle is
five consecutive words (a shorter item is one shingle).  A benchmark item of L
words is compared with L-word windows of the documents:

1. A window can only be similar if it shares a shingle with the item, so
   windows are laid where a document shingle equals an item shingle: one so
   that the two coincide, and, for passages whose parts come in another order,
   one that starts with the shared shingle.  The best window can slide right,
   losing nothing, until it starts with one; a window cut at the document's
   start can slide left in the same way until it ends with one, so that is
   laid too.  Of these last two kinds, windows with too few shared shingles
   for ``SIMILARITY`` are not laid.
2. Each window gets the 64-bit SimHash of its shingles.
3. Multi-index Hamming blocks: the fingerprint is cut into 8 blocks of 8 bits
   and the item side is entered under every block value within 2 bits.  Two
   fingerprints at most 23 bits apart agree within 2 bits in some block, so
   every pair within ``RADIUS`` bits meets; the distance is then checked.
4. The candidates' exact weighted similarity (shingles weigh their number of
   occurrences: sum of minima over sum of maxima) must reach ``SIMILARITY``.

Equal windows of different documents are fingerprinted and verified once.
All of it is built-in column work: no Python runs on the executors.

Edge cases: null, blank or wordless texts and items never match; a window is
cut at the document's ends (so a document shorter than the item can match);
repeated rows share the decision of their (id, text); an empty benchmark or
corpus gives no matches; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, counted, read, row_key, same_row, with_rows

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
#: Anchor rows (24 bytes each) up to which the benchmark side is broadcast, and
#: windows (12 bytes) and matched documents likewise; more join by shuffle.
BROADCAST_ROWS = 1_000_000


def normal_words(text: Column) -> Column:
    """Lower-cased words of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, k: int = SHINGLE) -> Column:
    """Hashes of all k-word runs in order; fewer words: one hash; none: empty."""
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Bit b is set where over half of the hashes have it."""

    def add(acc, b):
        ones = F.size(F.filter(hashes, lambda h: F.call_function("getbit", h, b) == 1))
        return F.when(ones * 2 > F.size(hashes), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), add)


def block(fp: Column, i: Column | int) -> Column:
    shift = F.lit(i) * BLOCK_BITS if isinstance(i, int) else i * BLOCK_BITS
    return F.call_function("shiftrightunsigned", fp, shift).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int")


def near_masks() -> list[int]:
    """Every pattern of at most BLOCK_RADIUS differing bits of a block."""
    return [sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), r)]


def item_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, key (of id and text: ids may be null or repeat), n (words), k
    (shingle length), sh (hashes), fp."""
    item = F.col(id_col).cast("long")
    rows = benchmark.select(item.alias("item_id"), F.xxhash64(item.isNull(), item, F.col(text_col)).alias("key"), normal_words(F.col(text_col)).alias("w"))
    w = rows.where(F.size("w") > 0).dropDuplicates(["key"])
    out = w.select("item_id", "key", F.size("w").alias("n"), F.least(F.size("w"), F.lit(SHINGLE)).alias("k"), shingles(F.col("w")).alias("sh"))
    return out.withColumn("fp", simhash(F.col("sh")))


def _starts(similarity: float) -> Column:
    """Starts of the windows of one document and item size, from ``in_place``,
    ``p`` (sorted places of shared shingles), ``size`` (words), ``n``, ``k``."""
    m, k, n = F.col("n") - F.col("k") + 1, F.col("k"), F.col("n")

    def needed(t):
        """Shared shingles without which t against m are not similar."""
        return F.greatest(F.ceil(similarity * (t + m) / (1 + similarity) - 1e-6), F.lit(1)).cast("int")

    def starts(x, i):
        t = F.least(m, F.col("size") - k + 1 - x)
        return F.coalesce(F.get("p", i + needed(t) - 1) < x + m, F.lit(False))

    def ends(x, i):
        return (x + k < n) & (i + 1 >= needed(x + 1))

    ending = F.transform(F.filter("p", ends), lambda x: x + k - n)
    return F.array_union(F.array_union("in_place", F.filter("p", starts)), ending)


def _windows(docs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """k_id, k_text, n, k, starts: the item-sized windows that share a shingle
    with an item of their size, in its place, at the start or (cut) at the end."""
    anchors = items.select("n", "k", F.posexplode("sh").alias("off", "h")).distinct()
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # 1 to 5
    small = anchors.count() <= BROADCAST_ROWS
    rows = docs.select(*row_key(docs), normal_words(F.col("text")).alias("w"))
    found = []
    for k in sizes:
        mine = anchors.where(F.col("k") == k)
        at = rows.select("k_id", "k_text", F.size("w").alias("size"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "h"))
        hit = at.join(F.broadcast(mine) if small else mine, "h")
        found.append(hit.select("k_id", "k_text", "n", "k", "size", "pos", (F.col("pos") - F.col("off")).alias("start")))
    places = reduce(DataFrame.unionAll, found).groupBy("k_id", "k_text", "n", "k", "size")
    places = places.agg(F.collect_set("start").alias("in_place"), F.sort_array(F.collect_set("pos")).alias("p"))
    return places.select("k_id", "k_text", "n", "k", _starts(similarity).alias("starts"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per (document, item) with a similar window: ``k_id``,
    ``k_text``, ``item_id``, ``start`` (word), ``n_words``, ``distance``,
    ``similarity`` of the best window (the first of equals)."""
    if radius >= (BLOCK_RADIUS + 1) * BLOCKS:
        raise ValueError(f"the blocks guarantee fewer than {(BLOCK_RADIUS + 1) * BLOCKS} bits")
    items = checkpointed(item_table(benchmark))
    schema = "k_id long, k_text long, item_id long, start int, n_words int, distance int, similarity double"
    if items.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    laid = checkpointed(_windows(docs, items, similarity))
    n_laid = laid.agg(F.sum(F.size("starts"))).first()[0] or 0
    laid = laid.select("k_id", "k_text", F.transform("starts", lambda x: F.struct(x.alias("start"), "n", "k")).alias("laid"))
    per_doc = laid.groupBy("k_id", "k_text").agg(F.flatten(F.collect_list("laid")).alias("laid"))
    rows = docs.select(*row_key(docs), "text")
    # few documents have windows: their list goes to the texts, not the texts to it
    per_doc = F.broadcast(per_doc) if n_laid <= BROADCAST_ROWS else per_doc
    joined = rows.join(per_doc, same_row(rows, per_doc)).select(rows["k_id"], rows["k_text"], normal_words(F.col("text")).alias("w"), "laid")

    def cut(x):
        lo = F.greatest(x["start"], F.lit(0))
        return F.struct(x["start"].alias("start"), x["n"].alias("n"), F.slice(F.col("w"), lo + 1, F.greatest(x["start"] + x["n"] - lo, F.lit(0))).alias("words"))

    cuts = joined.select("k_id", "k_text", F.explode(F.transform("laid", cut)).alias("x"))
    placed = cuts.select("k_id", "k_text", "x.start", "x.n", F.size("x.words").alias("n_words"), shingles(F.col("x.words")).alias("sh"))
    placed = checkpointed(placed.withColumn("c1", F.xxhash64("sh")).withColumn("c2", F.hash("sh")))

    contents = placed.groupBy("n", "c1", "c2").agg(F.first("sh").alias("sh")).withColumn("fp", simhash(F.col("sh")))
    contents = checkpointed(contents)
    left = contents.select("n", "c1", "c2", "fp", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("b"))
    left = left.withColumn("v", block(F.col("fp"), F.col("b")))
    masks = F.array(*[F.lit(m) for m in near_masks()])
    right = items.select("key", F.col("n").alias("i_n"), F.col("fp").alias("i_fp"), F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("i_b"))
    right = right.withColumn("m", F.explode(masks)).withColumn("i_v", block(F.col("i_fp"), F.col("i_b")).bitwiseXOR(F.col("m")))
    meet = left.join(right, (left["n"] == right["i_n"]) & (left["b"] == right["i_b"]) & (left["v"] == right["i_v"]))
    near = meet.select("n", "c1", "c2", "key", F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp"))).alias("distance"))
    near = near.where(F.col("distance") <= radius).distinct()

    # exact similarity of each candidate content and item
    mine = near.join(contents.select("n", "c1", "c2", "sh"), ["n", "c1", "c2"])
    mine = mine.select("n", "c1", "c2", "key", "distance", F.size("sh").alias("total"), F.explode("sh").alias("h"))
    mine = mine.groupBy("n", "c1", "c2", "key", "distance", "total", "h").agg(F.count("*").alias("a"))
    theirs = items.select("key", F.size("sh").alias("i_total"), F.explode("sh").alias("h")).groupBy("key", "i_total", "h").agg(F.count("*").alias("z"))
    shared = mine.join(theirs, ["key", "h"]).groupBy("n", "c1", "c2", "key", "distance", "total", "i_total").agg(F.sum(F.least("a", "z")).alias("both"))
    shared = shared.withColumn("similarity", F.col("both") / (F.col("total") + F.col("i_total") - F.col("both")))
    good = shared.where(F.col("similarity") >= similarity).join(items.select("key", "item_id"), "key").select("n", "c1", "c2", "item_id", "distance", "similarity")

    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words", "distance")).alias("m")
    out = placed.join(good, ["n", "c1", "c2"]).groupBy("k_id", "k_text", "item_id").agg(best)
    return out.select(
        "k_id", "k_text", "item_id", F.greatest(-F.col("m.back"), F.lit(0)).alias("start"), F.col("m.n_words").alias("n_words"),
        F.col("m.distance").alias("distance"), F.col("m.similarity").alias("similarity"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match, with all their columns."""
    hit = counted(matches(docs, benchmark).select("k_id", "k_text").distinct(), BROADCAST_ROWS)
    full = with_rows(docs)
    kept = full.join(hit, same_row(full, hit), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a similar window."""
    found = matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("k_id").alias("doc_id"), "item_id", "start", "n_words", "distance", F.round("similarity", 6).alias("similarity"))
