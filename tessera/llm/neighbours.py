"""Approximate nearest neighbours over shifted space-filling curves.

Each curve projects the vectors onto its own random directions, turns each
projection into its share of ranks (by approximate quantiles, so a few vectors
of any size leave the others' places as they are), shifts the grid, and orders
the vectors by Hilbert key.  The (curve, key, id) order is
range-partitioned and sorted by Spark, which gives every vector its rank on
each curve.  A query looks at the vectors within a window of ranks on each
curve; windows are cut at blocks of ``BLOCK`` ranks, a task holds one block at
a time and streams the queries whose window touches it, and the best of all
blocks and curves merge into the ranked result.  Distances are exact.

Equal vectors stand on a curve once, with their smallest ids, so a vector that
a third of all rows repeat costs no more than another and ties come out by id.

The window is ``share`` of the ranks (at least ``MIN_WINDOW``): vectors spread
evenly in many dimensions leave little for any ordering to prune, so recall
is bought with the window; see the README for recall against share.

Edge cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; ids of repeated rows count once;
rows of null id are neither queries nor found; fewer candidates than ``k`` give
fewer rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checkpointed, read

K, CURVES, DIMS, BITS, SHARE = 10, 8, 8, 8, 0.2
BLOCK, MIN_WINDOW, SEED = 4096, 256, 11
QUANTILES = 257
#: Components beyond this have squares whose sum could overflow.
HUGE = 1e150


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (n x d, unsigned):
    per bit plane the axes' orientation is undone, then Gray code is read off."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for plane in range(bits - 1, 0, -1):
        low = (one << np.uint64(plane)) - one
        for axis in x:
            up = (axis >> np.uint64(plane)) & one == one
            swap = np.where(up, np.uint64(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(up, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for plane in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(plane)) & one == one, (one << np.uint64(plane)) - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for plane in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | ((axis >> np.uint64(plane)) & one)
    return key


def _curves(d: int, curves: int, dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions (d x dims; short, so that no projection overflows) and grid
    shift of each curve."""
    made = []
    for c in range(curves):
        rng = np.random.default_rng([seed, c])
        axes = np.linalg.qr(rng.normal(size=(d, min(d, dims))))[0]
        made.append((axes * 2.0**-32, rng.random(axes.shape[1]) / 2))
    return made


def _projections(made, d: int):
    """Rows (v) to rows (p: the projections of all curves)."""
    axes = np.hstack([a for a, _ in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = np.array(b.column(0).flatten()).reshape(b.num_rows, d) @ axes
                at = np.arange(b.num_rows + 1, dtype=np.int32) * p.shape[1]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, p.ravel())], ["p"])

    return run


def _curve_keys(made, quantiles: np.ndarray, d: int, bits: int):
    """Rows (id, v) to rows (curve, key, id); ``quantiles`` has a row per projection."""
    ranks = np.linspace(0, 1, quantiles.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(1).flatten()).reshape(b.num_rows, d)
            i = 0
            for c, (axes, shift) in enumerate(made):
                even = np.column_stack([np.interp(p, q, ranks) for p, q in zip((x @ axes).T, quantiles[i : i + len(shift)], strict=True)])
                i += len(shift)
                cells = np.minimum((even / 2 + shift) * 2**bits, 2**bits - 1)
                key = (hilbert_keys(cells, bits) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, c, np.int32)), pa.array(key), b.column(0)], ["curve", "key", "id"])

    return run


def _distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """From one vector to each row, without overflow of the squares."""
    with np.errstate(over="ignore"):
        diff = np.abs(v - q)
        top = diff.max(1)
        unit = np.where((top > 0) & np.isfinite(top), top, 1.0)
        return unit * np.sqrt(((diff / unit[:, None]) ** 2).sum(1))


def _block_search(k: int, d: int):
    """Rows sorted by (curve, block, query, id), base rows first: for each query row
    the ``k`` nearest base rows with a rank in its window."""

    def best(q, base):
        ids, ranks, v, centre, moved, norm, top = base
        bound = 8 * (d + 4) * np.finfo(float).eps
        out = []
        for s in range(0, len(q[0]), 1024):
            qid, lo, hi, qv = (a[s : s + 1024] for a in q)
            huge = max(top, np.abs(qv).max()) > HUGE
            if huge:  # exact at once; beyond the range of doubles: last
                rough = np.minimum([_distances(x, v) for x in qv], np.finfo(float).max)
            else:  # about the block's centre, so a common offset costs no digits
                shifted = qv - centre
                rough = norm[None] - 2 * (shifted @ moved.T)
            rough[(ranks[None] < lo[:, None]) | (ranks[None] > hi[:, None])] = np.inf
            m = min(len(ids), k + 8)
            near = np.argpartition(rough, m - 1, axis=1)[:, :m]
            if not huge:
                # what rounding may have put beyond the m nearest: those queries get all distances
                held = np.sort(np.take_along_axis(rough, near, 1), axis=1)
                slack = 2 * bound * ((shifted**2).sum(1) + norm.max())
                unsure = np.flatnonzero((m < len(ids)) & np.isfinite(held[:, -1]) & ~(held[:, -1] - held[:, min(k, m) - 1] > slack))
                for i in unsure:
                    full = np.where(np.isfinite(rough[i]), _distances(qv[i], v), np.inf)
                    near[i] = np.lexsort((ids, full))[:m]
            seen = np.isfinite(np.take_along_axis(rough, near, 1))
            exact = np.array([_distances(x, v[i]) for x, i in zip(qv, near, strict=True)]) if huge else np.sqrt(((qv[:, None, :] - v[near]) ** 2).sum(2))
            order = np.lexsort((ids[near], exact, ~seen), axis=1)[:, :k]
            dist = np.take_along_axis(exact, order, 1)
            found = np.take_along_axis(seen, order, 1)
            out.append((np.repeat(qid, found.sum(1)), np.take_along_axis(ids[near], order, 1)[found], dist[found]))
        return [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, base = None, [], None
        for b in batches:
            curve, block, query, ids, lo, hi = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            v = np.array(b.column(6).flatten()).reshape(b.num_rows, d)
            cut = np.flatnonzero((np.diff(curve) != 0) | (np.diff(block) != 0) | (np.diff(query) != 0)) + 1
            for s, e in zip([0, *cut], [*cut, b.num_rows], strict=True):
                if s == e:
                    continue
                if (curve[s], block[s]) != now:
                    now, parts, base = (curve[s], block[s]), [], None
                if not query[s]:
                    parts.append((ids[s:e], lo[s:e], v[s:e]))
                    continue
                if base is None and parts:
                    i, r, x = (np.concatenate(c) for c in zip(*parts, strict=True))
                    with np.errstate(over="ignore"):
                        centre = x.mean(0)
                        moved = x - centre
                        base = (i, r, x, centre, moved, (moved**2).sum(1), np.abs(x).max())
                if base is not None:
                    yield pa.RecordBatch.from_arrays(best((ids[s:e], lo[s:e], hi[s:e], v[s:e]), base), ["q", "c", "score"])

    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (doubles; no negative zero) of the rows that take part."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fine & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query, k: int = K, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, share: float = SHARE, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows of
    ``vectors`` (``vec_id``, ``embedding``) where the column ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = lengths["d"]
    rows = rows.where(F.size("v") == d).distinct()

    by_id = W.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    base = few.groupBy("v").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    base = checkpointed(base)
    asked = rows.where(is_query).withColumnRenamed("vec_id", "query_id").join(base.select("v", "id"), "v").select("query_id", F.col("id").alias("q"))
    asked = checkpointed(asked)

    made = _curves(d, curves, dims, seed)
    shares = [i / (QUANTILES - 1) for i in range(QUANTILES)]
    projected = base.select("v").mapInArrow(_projections(made, d), "p array<double>").select(F.posexplode("p").alias("i", "x"))
    cuts = {r["i"]: r["q"] for r in projected.groupBy("i").agg(F.percentile_approx("x", shares).alias("q")).collect()}
    quantiles = np.array([cuts[i] for i in range(len(cuts))])
    keyed = base.select("id", "v").mapInArrow(_curve_keys(made, quantiles, d, bits), "curve int, key long, id long")
    order = ["curve", "key", "id"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ranged.select("curve", "id", F.monotonically_increasing_id().alias("m")).withColumn("part", F.shiftright("m", 33)))
    runs = placed.groupBy("curve", "part").agg(F.min("m").alias("m0"), F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("curve", "part", (F.coalesce(before, F.lit(0)) - F.col("m0")).alias("shift"))
    ranks = placed.join(runs, ["curve", "part"]).select("curve", "id", (F.col("m") + F.col("shift")).alias("rank"))
    full = checkpointed(ranks.join(base.select("id", "v"), "id"))

    n = base.count()
    half = max(MIN_WINDOW, -(-int(share * n) // 2))
    held = full.select("curve", F.expr(f"rank DIV {block}").alias("block"), F.lit(0).alias("query"), "id", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "v")
    lo, hi = F.greatest(F.col("rank") - half, F.lit(0)), F.least(F.col("rank") + half, F.lit(n - 1))
    seek = full.join(asked.select(F.col("q").alias("id")).distinct(), "id").withColumn("lo", lo).withColumn("hi", hi)
    seek = seek.select("curve", F.explode(F.expr(f"sequence(lo DIV {block}, hi DIV {block})")).alias("block"), F.lit(1).alias("query"), "id", "lo", "hi", "v")
    dealt = held.unionByName(seek).repartition("curve", "block").sortWithinPartitions("curve", "block", "query", "id")
    found = dealt.mapInArrow(_block_search(k + 1, d), "q long, c long, score double").distinct()

    top = found.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy("score", "c"))).where(F.col("n") <= k + 1).drop("n")
    named = top.join(base.select(F.col("id").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    pairs = asked.join(named, "q").where("vec_id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings of each embedding whose id is divisible by 100."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
