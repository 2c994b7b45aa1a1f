"""Exact k-nearest-neighbours regression.

No cross join, no broadcast of the training table, no all-pairs rows.

Training rows are first reduced to distinct vectors (each with its k lowest
ids) and queries to distinct query vectors; the k nearest rows of a query lie
in its k nearest distinct vectors, ordered by distance and lowest id, so the
search runs between distinct vectors and its result is joined back.  A vector
that a third of all rows repeat is searched once.

Distinct rows are routed to groups that each hold a bounded block of training rows and
a bounded block of query rows (each row carries the list of its groups).  The
two sides are stacked with a side flag and partitioned by group number, so that
every task gets exactly one group (AQE does not coalesce these compute-heavy tasks).  ``groupBy(group)
.applyInPandas`` emits, per group, only each query's k best candidates,
ordered by (distance, training id); a window ``row_number() <= k`` per query
merges groups.  Ids are unique and hashed, so no key can make a group hot.
Beyond ``MAX_TASKS`` groups a task works through several, one after another;
its memory stays that of one group.

Group layouts:

* blocks - exact brute force: training hashed into ``B_t`` blocks, queries
  into ``B_q`` blocks, one group per pair (at least one group per core).
* bands - exact pruned search for low-dimensional features: slabs of the
  feature that quantiles cut best, a query searched in nearby slabs only, accepted when its
  k-th distance is provably inside them; widening rounds, then blocks, for
  the rest.

* cells - exact pruned search in any number of dimensions (``cells.py``):
  Voronoi cells of pivots, or k-d boxes for a few features.  A query looks in
  its nearest cells first; its k-th distance there rules out every cell whose
  lower bound lies beyond, and the others are searched in a second round.
  Where the bounds rule out too little, the block plan takes over.

Inside a group (``block_top_k``) distances are summed feature by feature, so
exact zeros stay exact; wide vectors are screened by one matrix product within a rounding bound and the
survivors recomputed exactly.

The prediction folds the k neighbours in rank order: uniform mean, or
inverse-distance weights ``sum(y/d) / sum(1/d)`` (0.0 when the total weight is
0); with distance weighting, any zero-distance neighbour among the k makes the
prediction the mean of those targets.  Ties at equal distance go to the lower
training id (the earlier training row).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors as E
from ..frames import Matrix, as_matrix
from ..functions.vector import check_metric, literal_longs
from ..session import cut_lineage, parallelism
from .cells import Balls, Boxes, first_cells, open_cells
from .checks import check_feature_count, scan
from .estimator import FittedState
from .gram import blocked_gram
from .wide import vectors

WEIGHTINGS = ("uniform", "distance")
STRATEGIES = ("auto", "cells", "bands", "blocks")
# Distance-matrix chunk (queries x training rows) kept under this many cells,
# small enough to stay cache-resident while every core runs a block.
CHUNK_CELLS = 65_536
# From this many features on, candidates are screened with one matrix product.
GEMM_MIN_FEATURES = 8
SCREEN_CHUNK_CELLS = 1_048_576
# Banded search: used for at most this many features (pruning on one
# feature weakens as dimensions grow), with bands of at least MIN_BAND_ROWS
# training rows and at most MAX_BANDS bands.
BAND_MAX_FEATURES = 4
MIN_BAND_ROWS = 1_000
MAX_BANDS = 4_096
# ``auto`` bands only when training x query pairs reach this many.
BAND_MIN_PAIRS = 10**10
# Cells: rows of one at least, cells at most (their geometry is model-sized),
# sampled rows per cell, and the pairs from which ``auto`` uses them.
MIN_CELL_ROWS = 250
MAX_CELLS = 2_048
SAMPLE_PER_CELL = 16
CELL_MIN_PAIRS = 10**10
# Tasks of a cell search: so many a core, or one for so many pairs.
TASKS_PER_CORE, PAIRS_PER_TASK = 2, 10**9
# Share of all pairs from which the block plan is cheaper than a second round.
WORTHWHILE = 0.5
# Up to this many groups each gets its own task exactly; beyond, hashing
# spreads groups evenly enough.
EXACT_PLACEMENT_GROUPS = 4_096
# Partitions of a search at most; more groups share them.
MAX_TASKS = 65_536
EPS = float(np.finfo(np.float64).eps)


def sum_columns(cols):
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def _is_integral(df: DataFrame, id_col: str) -> bool:
    return isinstance(df.schema[id_col].dataType, T.IntegralType)


def ordered_keys(df: DataFrame, id_col: str) -> DataFrame:
    """(_orig, _key): a long per id that rises with it, for ids of any
    orderable type: a range-partitioned sort of the id column, written to the
    checkpoint folder so that the keys never change."""
    ids = df.select(F.col(id_col).alias("_orig")).distinct().repartitionByRange("_orig").sortWithinPartitions("_orig")
    return cut_lineage(ids.select("_orig", F.monotonically_increasing_id().alias("_key")))


_PARTITION_KEYS: dict[int, list[int]] = {}


def partition_keys(spark, n: int) -> list[int]:
    """For each partition p < n, a long key that hash partitioning into n
    partitions sends to p (Spark partitions by ``pmod(hash(key), n)``, so the
    keys depend on n only and are kept per n).  The searches place groups by number instead."""
    if n not in _PARTITION_KEYS:
        found: dict[int, int] = {}
        span, start = 16 * n, 0
        while len(found) < n:
            ids = spark.range(start, start + span).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p"))
            for r in ids.groupBy("p").agg(F.min("id").alias("id")).collect():
                found.setdefault(r["p"], r["id"])
            start += span
        _PARTITION_KEYS[n] = [found[p] for p in range(n)]
    return _PARTITION_KEYS[n]


def _first_equal(row: np.ndarray, value: float, count: int) -> np.ndarray:
    """Positions of the first ``count`` entries equal to ``value``, scanning
    growing segments so that frequent values stop early."""
    found: list[np.ndarray] = []
    start, step, left = 0, 1024, count
    while left > 0 and start < len(row):
        hit = np.flatnonzero(row[start : start + step] == value)[:left] + start
        found.append(hit)
        left -= len(hit)
        start += step
        step *= 4
    return np.concatenate(found)


def _distances(qx: np.ndarray, t_cols: list[np.ndarray], euclid: bool) -> np.ndarray:
    """Query x training distances, summed feature by feature."""
    acc = np.zeros((len(qx), len(t_cols[0])))
    buf = np.empty_like(acc)
    for j, tc in enumerate(t_cols):
        np.subtract(qx[:, j : j + 1], tc[None, :], out=buf)
        if euclid:
            np.multiply(buf, buf, out=buf)
        else:
            np.abs(buf, out=buf)
        acc += buf
    if euclid:
        np.sqrt(acc, out=acc)
    return acc


def _exact_rows(q_x, t_x, rows, cols, euclid: bool) -> np.ndarray:
    """Exact distances for selected (query, training) pairs, summed feature
    by feature like the direct kernel."""
    acc = np.zeros(len(rows))
    for j in range(q_x.shape[1]):
        diff = q_x[rows, j] - t_x[cols, j]
        acc += diff * diff if euclid else np.abs(diff)
    return np.sqrt(acc) if euclid else acc


def _squares_fit(q_x: np.ndarray, t_x: np.ndarray) -> bool:
    """Whether the squared norms the screening adds up stay finite."""
    largest = max(np.abs(q_x).max(initial=0.0), np.abs(t_x).max(initial=0.0))
    return largest < 1e150 / max(1, q_x.shape[1])


def _top_k_screened(q_ids, q_x, t_ids, t_x, t_y, kk: int):
    """Euclidean top-k for wide vectors.  ``|q|^2 + |t|^2 - 2 q.t`` from one
    matrix product estimates every squared distance within a rounding bound
    ``e = 8 (d + 4) eps (|q|^2 + |t|^2)``; a training row whose lower bound
    exceeds the k-th smallest upper bound (plus a relative guard against
    ties created by the square root) cannot be among the k nearest.  The
    remaining candidates get exact distances and the exact (distance, id)
    selection."""
    d = q_x.shape[1]
    factor = 8.0 * (d + 4) * EPS
    t_norm = np.einsum("ij,ij->i", t_x, t_x)
    chunk = max(1, SCREEN_CHUNK_CELLS // max(len(t_ids), 1))
    outs = []
    for s in range(0, len(q_ids), chunk):
        qx = q_x[s : s + chunk]
        m = len(qx)
        q_norm = np.einsum("ij,ij->i", qx, qx)
        scale = q_norm[:, None] + t_norm[None, :]
        approx = scale - 2.0 * (qx @ t_x.T)
        err = factor * scale
        upper = approx + err
        tau = np.partition(upper, kk - 1, axis=1)[:, kk - 1]
        guard = np.abs(tau) * 8.0 * EPS + factor * 1e-300
        rows, cols = np.nonzero(approx - err <= (tau + guard)[:, None])
        dist = _exact_rows(qx, t_x, rows, cols, True)
        order = np.lexsort((cols, dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        starts = np.searchsorted(rows, np.arange(m))
        take = (starts[:, None] + np.arange(kk)[None, :]).ravel()
        outs.append(
            (
                np.repeat(q_ids[s : s + m], kk),
                t_ids[cols[take]],
                dist[take],
                t_y[cols[take]],
                np.tile(np.arange(1, kk + 1), m),
            )
        )
    return tuple(np.concatenate(p) for p in zip(*outs))


def block_top_k(q_ids, q_x, t_ids, t_x, t_y, k: int, metric: str):
    """Top-k training rows per query for one block pair, as flat arrays
    (query id, training id, distance, target, rank within block).

    Exact: candidates are the k smallest distances; when the k-th distance is
    tied, the tied training rows with the lowest ids are taken, as a stable
    sort in id order would.
    """
    order = np.argsort(t_ids, kind="stable")
    t_ids, t_y, t_x = t_ids[order], t_y[order], t_x[order]
    nt = len(t_ids)
    kk = min(k, nt)
    if metric == "euclidean" and t_x.shape[1] >= GEMM_MIN_FEATURES and kk < nt and _squares_fit(q_x, t_x):
        return _top_k_screened(q_ids, q_x, t_ids, t_x, t_y, kk)
    t_cols = [np.ascontiguousarray(t_x[:, j]) for j in range(t_x.shape[1])]
    chunk = max(1, CHUNK_CELLS // max(nt, 1))
    euclid = metric == "euclidean"
    outs = []
    for s in range(0, len(q_ids), chunk):
        qx = q_x[s : s + chunk]
        m = len(qx)
        dist = _distances(qx, t_cols, euclid)
        if kk < nt:
            cols = np.argpartition(dist, kk - 1, axis=1)[:, :kk]
            dsel = np.take_along_axis(dist, cols, axis=1)
            kth = dsel.max(axis=1)
            n_le = np.count_nonzero(dist <= kth[:, None], axis=1)
            # rows with ties at the k-th distance: keep the lowest positions
            # (the k smallest always contain every strictly closer row)
            for r in np.flatnonzero(n_le > kk):
                v = kth[r]
                below = cols[r][dsel[r] < v]
                cols[r] = np.concatenate([below, _first_equal(dist[r], v, kk - len(below))])
            dsel = np.take_along_axis(dist, cols, axis=1)
        else:
            cols = np.tile(np.arange(nt), (m, 1))
            dsel = dist
        # order each query's candidates by (distance, training position)
        rk = np.lexsort((cols, dsel), axis=1)
        cols = np.take_along_axis(cols, rk, axis=1)
        dsel = np.take_along_axis(dsel, rk, axis=1)
        outs.append(
            (
                np.repeat(q_ids[s : s + m], kk),
                t_ids[cols.ravel()],
                dsel.ravel(),
                t_y[cols.ravel()],
                np.tile(np.arange(1, kk + 1), m),
            )
        )
    if not outs:
        return None
    return tuple(np.concatenate(p) for p in zip(*outs))


@dataclass
class KNNModel:
    train: DataFrame  # (_tid, _x0.._x{d-1}, _y)
    n_train: int
    n_features: int
    k: int
    weighting: str
    metric: str
    id_type: T.DataType
    train_block_rows: int
    query_block_rows: int
    spread: np.ndarray | None = None  # per-feature standard deviation of the training rows
    strategy: str = "auto"
    band_rows: int | None = None
    id_keys: DataFrame | None = None  # (_orig, _key) where ids are not integers
    cell_rows: int | None = None
    work: dict = field(default_factory=dict)  # what the last cell search evaluated

    # --- shared executor ---------------------------------------------------

    def _top_k_groups(self, t: DataFrame, q: DataFrame, n_groups: int, carry: list[str] = (), tasks: int | None = None) -> DataFrame:
        """Training rows ``t`` and query rows ``q`` carry ``_gs``, the groups
        they belong to; every group is one task computing its queries' k best
        candidates (or one of several in a row, with fewer ``tasks``).
        ``carry`` query columns are passed through."""
        d, k, metric = self.n_features, self.k, self.metric
        xcols = [f"_x{i}" for i in range(d)]
        carry = list(carry)
        t = t.select(F.explode("_gs").alias("_g"), F.lit(0).alias("_side"), "_id", *xcols, "_y",
                     *[F.lit(None).cast("double").alias(c) for c in carry])
        q = q.select(F.explode("_gs").alias("_g"), F.lit(1).alias("_side"), "_id", *xcols,
                     F.lit(None).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in carry])
        if n_groups <= EXACT_PLACEMENT_GROUPS:
            # one group per task (an explicit partition count is never coalesced away by AQE)
            stacked = t.unionByName(q).withColumn("_g", F.col("_g").cast("int")).repartitionById(min(n_groups, tasks or n_groups), "_g")
        else:
            stacked = t.unionByName(q).repartition(min(n_groups, MAX_TASKS), "_g")
        fields = [
            T.StructField("query_id", T.LongType()),
            T.StructField("train_id", T.LongType()),
            T.StructField("distance", T.DoubleType()),
            T.StructField("target", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ] + [T.StructField(c, T.DoubleType()) for c in carry]
        schema = T.StructType(fields)
        names = [f.name for f in fields]

        def per_block(pdf: pd.DataFrame) -> pd.DataFrame:
            tr, qr = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
            if len(tr) == 0 or len(qr) == 0:
                return pd.DataFrame({n: [] for n in names})
            qids = qr["_id"].to_numpy()
            out = block_top_k(
                qids,
                qr[xcols].to_numpy(dtype=np.float64),
                tr["_id"].to_numpy(),
                tr[xcols].to_numpy(dtype=np.float64),
                tr["_y"].to_numpy(dtype=np.float64),
                k,
                metric,
            )
            if out is None:
                return pd.DataFrame({n: [] for n in names})
            cols = dict(zip(names, out))
            if carry:
                pos = pd.Index(qids).get_indexer(out[0])
                for c in carry:
                    cols[c] = qr[c].to_numpy(dtype=np.float64)[pos]
            return pd.DataFrame(cols)

        return stacked.groupBy("_g").applyInPandas(per_block, schema)

    @staticmethod
    def _merge(cands: DataFrame, k: int) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy("distance", "train_id")
        return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    # --- distinct vectors --------------------------------------------------------

    def _search(self, q: DataFrame, n_query: int) -> DataFrame:
        """(query_id, rank, train_id, distance) between rows as they are."""
        if self._use_cells(n_query):
            out = self._celled(q, n_query)
        else:
            out = self._banded(q, n_query) if self._use_bands(q.sparkSession, n_query) else self._blocked(q, n_query)
        return out.select("query_id", "rank", "train_id", "distance")

    def _search_distinct(self, q: DataFrame) -> DataFrame:
        """(query_id, rank, train_id, distance, target) of every query row,
        by a search between distinct vectors."""
        xs = [f"_x{i}" for i in range(self.n_features)]
        vector = F.array(*xs).alias("_v")
        apart = [F.col("_v")[i].alias(x) for i, x in enumerate(xs)]
        # Spark limits the rows of a vector to k in each task before it shuffles them
        lowest = Window.partitionBy("_v").orderBy("_tid")
        few = self.train.select(F.col("_tid").cast("long").alias("_tid"), "_y", vector)
        few = few.withColumn("_n", F.row_number().over(lowest)).filter(F.col("_n") <= self.k)
        rows = F.sort_array(F.collect_list(F.struct("_tid", "_y"))).alias("_rows")
        reps = cut_lineage(few.groupBy("_v").agg(F.min("_tid").alias("_rep"), rows))
        asked = cut_lineage(q.select("_id", vector).groupBy("_v").agg(F.min("_id").alias("_id")))
        n_reps = reps.count()
        inner = replace(
            self, train=reps.select(F.col("_rep").alias("_tid"), *apart, F.lit(0.0).alias("_y")), n_train=n_reps, k=min(self.k, n_reps)
        )
        near = inner._search(asked.select("_id", *apart), asked.count())
        named = near.join(reps.select(F.col("_rep").alias("train_id"), "_rows"), "train_id")
        named = named.select("query_id", "distance", F.explode("_rows").alias("_r"))
        best = Window.partitionBy("query_id").orderBy("distance", "_r._tid")
        named = named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= self.k)
        lists = named.groupBy("query_id").agg(
            F.sort_array(F.collect_list(F.struct("rank", F.col("_r._tid").alias("train_id"), "distance", F.col("_r._y").alias("target")))).alias("_nb")
        )
        found = asked.join(lists, asked["_id"] == lists["query_id"]).select("_v", "_nb")
        mine = q.select(F.col("_id").alias("query_id"), vector).join(found, "_v")
        return mine.select("query_id", F.explode("_nb").alias("_n")).select("query_id", "_n.*")

    # --- brute force over blocks -------------------------------------------------

    def _blocked(self, q: DataFrame, n_query: int) -> DataFrame:
        """Every query against every training row, in (train block, query
        block) groups."""
        spark = q.sparkSession
        b_t = max(1, math.ceil(self.n_train / self.train_block_rows))
        par = parallelism(spark)
        b_q = max(1, min(max(math.ceil(n_query / self.query_block_rows), par // b_t), max(n_query, 1)))
        qq = q.withColumn(
            "_gs",
            F.transform(F.sequence(F.lit(0), F.lit(b_t - 1)), lambda tb: tb * b_q + F.pmod(F.xxhash64("_id"), F.lit(b_q))),
        )
        tt = self.train.select(F.col("_tid").cast("long").alias("_id"), *[c for c in self.train.columns if c.startswith("_x")], "_y")
        tt = tt.withColumn(
            "_gs",
            F.transform(F.sequence(F.lit(0), F.lit(b_q - 1)), lambda qb: F.pmod(F.xxhash64("_id"), F.lit(b_t)) * b_q + qb),
        )
        cands = self._top_k_groups(tt, qq, b_t * b_q)
        return self._merge(cands, self.k) if b_t > 1 else cands

    # --- cells -----------------------------------------------------------------

    def _use_cells(self, n_query: int) -> bool:
        return self.strategy == "cells" or (self.strategy == "auto" and self.n_train * n_query >= CELL_MIN_PAIRS)

    def _geometry(self, rows: DataFrame):
        """Cells from the rows of lowest id hash, a bounded sample."""
        want = max(1, min(MAX_CELLS, self.n_train // (self.cell_rows or max(MIN_CELL_ROWS, self.k))))
        sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_PER_CELL * want).select("_v").collect()
        x = np.array([r["_v"] for r in sample], dtype=float)
        kind = Boxes if self.n_features <= BAND_MAX_FEATURES else Balls
        return kind.fit(x, want, self.metric == "euclidean")

    def _celled(self, q: DataFrame, n_query: int) -> DataFrame:
        """Exact search that visits the cells whose bound lies within a query's k-th distance."""
        d, k = self.n_features, min(self.k, self.n_train)
        xs = [f"_x{i}" for i in range(d)]
        apart = [F.col("_v")[i].alias(x) for i, x in enumerate(xs)]
        train = self.train.select(F.col("_tid").cast("long").alias("_id"), F.array(*xs).alias("_v"), "_y")
        geometry = self._geometry(train)
        n_cells = geometry.n_cells

        def place(batches):
            for b in batches:
                if b.num_rows:
                    cell, dist = geometry.assign(vectors(b.column(1), d))
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(dist)], ["_id", "_v", "_y", "_cell", "_dist"])

        t = cut_lineage(train.mapInArrow(place, "_id long, _v array<double>, _y double, _cell int, _dist double"))
        edges = [F.min("_dist").alias("a0"), F.max("_dist").alias("b0")] if isinstance(geometry, Balls) else [
            f(F.col("_v")[i]).alias(f"{n}{i}") for i in range(d) for f, n in ((F.min, "a"), (F.max, "b"))]
        stats = t.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), *edges).collect()  # a row per cell
        counts = np.zeros(n_cells, np.int64)
        if isinstance(geometry, Balls):
            low, high = np.full(n_cells, np.inf), np.full(n_cells, -np.inf)
        else:
            low, high = np.full((n_cells, d), np.inf), np.full((n_cells, d), -np.inf)
        for r in stats:
            counts[r["_cell"]] = r["n"]
            if isinstance(geometry, Balls):
                low[r["_cell"]], high[r["_cell"]] = r["a0"], r["b0"]
            else:
                low[r["_cell"]], high[r["_cell"]] = [r[f"a{i}"] for i in range(d)], [r[f"b{i}"] for i in range(d)]
        geometry.bounded(low, high)
        t_blocks = -(-counts // self.train_block_rows)
        names = ["_id", "_v", "_cells"]

        def listed(b, lists):
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists).astype(np.int32)))], names)

        def steps(b):
            size = max(1, (1 << 22) // max(1, n_cells))
            for at in range(0, b.num_rows, size):
                yield b.slice(at, size)

        def begin(batches):
            for b in batches:
                for part in steps(b):
                    yield listed(part, first_cells(geometry, vectors(part.column(1), d), counts, k))

        def go_on(batches):
            for b in batches:
                for part in steps(b):
                    seen = [np.array(x, dtype=np.int64) for x in part.column(2).to_pylist()]
                    kth = part.column(3).to_numpy(zero_copy_only=False)
                    yield listed(part, open_cells(geometry, vectors(part.column(1), d), counts, kth, seen))

        def planned(asked: DataFrame):
            """Queries of each cell, their blocks and the pairs they make."""
            held = np.zeros(n_cells, np.int64)
            for r in asked.select(F.explode("_cells").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():
                held[r["c"]] = r["n"]
            return held, -(-held // self.query_block_rows), int((held * counts).sum())

        def search(asked: DataFrame, held_by: np.ndarray, q_blocks: np.ndarray) -> DataFrame:
            # cell c has t_blocks x q_blocks groups, numbered from first[c] on
            groups = t_blocks * q_blocks
            first = literal_longs((np.cumsum(groups) - groups).tolist())
            tb, qb = literal_longs(t_blocks.tolist()), literal_longs(q_blocks.tolist())

            def of(arr, c):
                return F.element_at(arr, c + 1)

            def mine(n):
                return F.pmod(F.xxhash64("_id"), F.greatest(n, F.lit(1)))

            c = F.col("_cell")
            t_side = t.select("_id", "_y", *apart, F.when(of(qb, c) > 0, F.transform(
                F.sequence(F.lit(0).cast("long"), of(qb, c) - 1), lambda j: of(first, c) + mine(of(tb, c)) * of(qb, c) + j)).alias("_gs"))
            q_side = asked.select("_id", *apart, F.flatten(F.transform("_cells", lambda c: F.transform(
                F.sequence(F.lit(0).cast("long"), of(tb, c) - 1), lambda i: of(first, c) + i * of(qb, c) + mine(of(qb, c))))).alias("_gs"))
            # cells are small: several groups a task, by the pairs they hold
            n = int(groups.sum())
            tasks = max(TASKS_PER_CORE * parallelism(q.sparkSession), math.ceil(int((held_by * counts).sum()) / PAIRS_PER_TASK))
            return self._merge(self._top_k_groups(t_side.where("_gs IS NOT NULL"), q_side, n, tasks=tasks), self.k)

        schema = "_id long, _v array<double>, _cells array<int>"
        rows = q.select("_id", F.array(*xs).alias("_v"))
        asked = cut_lineage(rows.mapInArrow(begin, schema))
        held, q_blocks, pairs = planned(asked)
        near = cut_lineage(search(asked, held, q_blocks).select("query_id", "rank", "train_id", "distance", "target"))
        kth = near.groupBy("query_id").agg(F.max("distance").alias("_kth"))
        more = asked.join(kth, asked["_id"] == kth["query_id"]).select("_id", "_v", "_cells", "_kth").mapInArrow(go_on, schema)
        more = cut_lineage(more.where(F.size("_cells") > 0))
        again, q_more, pairs_more = planned(more)
        everything = self.n_train * max(1, n_query)
        n_more = more.count()
        self.work.update(
            cells=n_cells, pairs=pairs + pairs_more, share=(pairs + pairs_more) / everything,
            cells_per_query=float((held + again).sum() / max(1, n_query)),
            copies_per_row=float((counts * (q_blocks + q_more)).sum() / max(1, self.n_train)), second_round=n_more,
        )
        if not n_more:
            return near
        if pairs_more > WORTHWHILE * self.n_train * n_more:  # bounds that rule out little: plain blocks
            self.work.update(pairs=pairs + self.n_train * n_more, share=(pairs + self.n_train * n_more) / everything, blocks=True)
            rest = self._blocked(more.select("_id", *apart), n_more).select(*near.columns)
            done = near.join(more.select(F.col("_id").alias("query_id")), "query_id", "left_anti")
            return done.select(*near.columns).unionByName(rest)
        found = search(more, again, q_more).select(*near.columns)
        return self._merge(near.drop("rank").unionByName(found.drop("rank")), self.k).select(*near.columns)

    # --- banded search ---------------------------------------------------------

    def _band_count(self, spark) -> int:
        """Bands about twice as wide as the expected k-th neighbour distance:
        for n rows in d dimensions that radius spans about
        ``n^(1-1/d) k^(1/d)`` rows of a slab."""
        d, n = self.n_features, max(self.n_train, 1)
        if self.band_rows:
            rows = self.band_rows
        else:
            rows = math.ceil(2 * n ** (1 - 1 / d) * self.k ** (1 / d))
            rows = max(MIN_BAND_ROWS, min(self.train_block_rows, rows))
        return max(1, min(MAX_BANDS, math.ceil(n / rows)))

    def _principal_axis(self) -> np.ndarray:
        """Unit first principal direction of the training features (mean
        job, then one Gram job; d x d on the driver)."""
        d = self.n_features
        xs = [F.col(f"_x{i}") for i in range(d)]
        mean = np.array(self.train.agg(*[F.avg(x) for x in xs]).first(), dtype=float)
        cov = blocked_gram(self.train, xs, shift=mean)
        _, vectors = np.linalg.eigh(cov)
        u = vectors[:, -1]
        return u / np.linalg.norm(u)

    def _use_bands(self, spark, n_query: int) -> bool:
        """``auto``: bands when the brute-force work is large enough to repay
        the band set-up jobs, for low-dimensional features."""
        if self.strategy in ("blocks", "cells") or self.spread is None:
            return False
        if self.strategy == "bands":
            return True
        return (
            self.n_features <= BAND_MAX_FEATURES
            and self.n_train * n_query >= BAND_MIN_PAIRS
            and self._band_count(spark) >= 4
        )

    def _banded(self, q: DataFrame, n_query: int) -> DataFrame:
        """Exact search in slabs of one feature, widening as needed.

        Training rows are cut into bands at quantiles of feature ``a``, the one
        whose quantiles differ most (a value that most rows share would make
        one band of them), the widest of equals.  In a
        round of radius r, a query in band b is searched in bands b-r..b+r
        (hot bands split into bounded sub-blocks by id).  Every training row
        outside those bands differs from the query by at least ``gap`` in
        feature ``a`` - and so is at least ``gap`` away in either metric - so
        a query whose k-th distance is strictly below ``gap`` is final.  The
        other queries (too few rows nearby, or a wide k-th distance) go to
        the next round with a window four times wider; once a window would
        span every band, the block plan searches what is left.
        """
        spark = q.sparkSession
        d = self.n_features
        xs = [F.col(f"_x{i}") for i in range(d)]
        n_bands = self._band_count(spark)
        probs = [i / n_bands for i in range(1, n_bands)]

        def quantiles(axes):
            return [F.percentile_approx(a, probs, max(10_000, 10 * n_bands)) if probs else F.array().cast("array<double>") for a in axes]

        if d <= BAND_MAX_FEATURES:
            # the feature itself: exact values, no rounding to account for
            cuts = self.train.agg(*[c.alias(f"q{i}") for i, c in enumerate(quantiles(xs))]).first()
            spread = self.spread if self.spread is not None else np.zeros(d)
            a = max(range(d), key=lambda i: (len(set(cuts[f"q{i}"])), spread[i], -i))
            axis, slack, qs = xs[a], F.lit(0.0), cuts[f"q{a}"]
        else:
            # projection on the first principal direction u (|u| = 1), so
            # |u.(t - q)| <= |t - q|_2 <= |t - q|_1; ``slack`` bounds the
            # rounding of each computed projection
            u = self._principal_axis()
            axis = sum_columns([x * F.lit(float(w)) for x, w in zip(xs, u)])
            slack = sum_columns([F.abs(x) * F.lit(abs(float(w))) for x, w in zip(xs, u)]) * F.lit(4.0 * (d + 2) * EPS)
            qs = None
        acol = "_ax"
        train = self.train.withColumn(acol, axis).withColumn("_slack", slack)
        q = q.withColumn(acol, axis).withColumn("_slack", slack)
        train_slack = 0.0
        if qs is None:
            stats = train.agg(quantiles([F.col(acol)])[0].alias("q"), F.max("_slack").alias("slack")).first()
            qs, train_slack = stats["q"], float(stats["slack"] or 0.0)
        bounds = sorted(set(float(v) for v in qs or []))
        splits = [-math.inf] + bounds + [math.inf]
        nb = len(splits) - 1

        def with_band(df: DataFrame) -> DataFrame:
            # band = number of bounds <= value (binary search in the JVM)
            if not bounds:
                return df.withColumn("_band", F.lit(0))
            out = Bucketizer(splits=splits, inputCol=acol, outputCol="_bandf").transform(df)
            return out.withColumn("_band", F.col("_bandf").cast("int")).drop("_bandf")

        tt = train.select(F.col("_tid").cast("long").alias("_id"), *[f"_x{i}" for i in range(d)], "_y", acol)
        tt = with_band(tt).drop(acol)
        t_counts = {r["_band"]: r["n"] for r in tt.groupBy("_band").agg(F.count(F.lit(1)).alias("n")).collect()}
        # blocks of a band are numbered on: band b holds blocks t_at[b] to t_at[b + 1] - 1
        t_at = [0, *np.cumsum([math.ceil(t_counts.get(b, 0) / self.train_block_rows) for b in range(nb)]).tolist()]
        band = F.col("_band").cast("int")

        def block_of(at: list[int]):
            first, end = F.element_at(literal_longs(at), band + 1), F.element_at(literal_longs(at), band + 2)
            return first + F.pmod(F.xxhash64("_id"), F.greatest(end - first, F.lit(1)))

        tt = tt.withColumn("_block", block_of(t_at))
        split_arr = F.array(*[F.lit(v) for v in splits])

        finished: list[DataFrame] = []
        pending, n_pending, radius = q, n_query, 1
        while n_pending > 0 and 2 * radius + 1 < nb:
            qq = with_band(pending)
            q_counts = {r["_band"]: r["n"] for r in qq.groupBy("_band").agg(F.count(F.lit(1)).alias("n")).collect()}
            q_at = [0, *np.cumsum([math.ceil(q_counts.get(b, 0) / self.query_block_rows) for b in range(nb)]).tolist()]
            # query block Q meets the training blocks of the bands around its own,
            # which are numbered in one run: the pair (Q, T) is group shift(Q) + T
            near = [(max(b - radius, 0), min(b + radius, nb - 1) + 1) for b in range(nb)]
            planned = sum((q_at[b + 1] - q_at[b]) * (t_at[hi] - t_at[lo]) for b, (lo, hi) in enumerate(near))
            if not planned:
                radius *= 4
                continue
            if planned <= EXACT_PLACEMENT_GROUPS:  # groups numbered without gaps
                shift, g = [], 0
                for b, (lo, hi) in enumerate(near):
                    for _ in range(q_at[b + 1] - q_at[b]):
                        shift.append(g - t_at[lo])
                        g += t_at[hi] - t_at[lo]
                group = lambda q_block, t_block: F.try_element_at(literal_longs(shift), q_block.cast("int") + 1) + t_block  # noqa: E731, B023
            else:
                group = lambda q_block, t_block: q_block * t_at[-1] + t_block
            low, high = F.greatest(band - radius, F.lit(0)), F.least(band + radius, F.lit(nb - 1))

            def blocks_near(at: list[int], low=low, high=high):
                first, end = F.element_at(literal_longs(at), low + 1), F.element_at(literal_longs(at), high + 2)
                return F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))

            t_side = tt.withColumn("_gs", F.transform(blocks_near(q_at), lambda x: group(x, F.col("_block"))))  # noqa: B023
            qq = qq.withColumn("_block", block_of(q_at))
            qq = qq.withColumn("_gs", F.transform(blocks_near(t_at), lambda x: group(F.col("_block"), x)))  # noqa: B023
            qq = qq.withColumn("_qa", F.col(acol)).drop(acol)
            cands = self._merge(
                self._top_k_groups(t_side, qq, planned, carry=["_qa", "_band", "_slack"]), self.k
            )

            # accept a query when its k-th distance is strictly inside the slab
            lo = F.when(band - radius >= 0, F.element_at(split_arr, band - radius + 1)).otherwise(F.lit(-math.inf))
            hi = F.element_at(split_arr, F.least(band + radius + 2, F.lit(nb + 1)))
            gap = F.least(F.col("_qa") - lo, hi - F.col("_qa")) - F.col("_slack") - F.lit(train_slack)
            per_q = Window.partitionBy("query_id")
            k_eff = min(self.k, self.n_train)
            judged = cands.withColumn("_n", F.count(F.lit(1)).over(per_q)).withColumn("_kth", F.max("distance").over(per_q))
            ok = (F.col("_n") >= k_eff) & (F.col("_kth") * (1 + 1e-12) < gap * (1 - 1e-12))
            # at most k rows per query, read several times (pending count, next
            # round, final union): a reliable checkpoint in the shared folder
            # means a lost executor never re-runs the group stage
            judged = cut_lineage(judged.withColumn("_ok", ok))
            finished.append(judged.filter("_ok").select("query_id", "rank", "train_id", "distance", "target"))
            open_ids = judged.filter(~F.col("_ok")).select(F.col("query_id").alias("_id")).distinct()
            # queries that found no candidate at all (no training rows in the window)
            seen = judged.select(F.col("query_id").alias("_id")).distinct()
            missing = pending.select("_id").join(seen, "_id", "left_anti")
            pending = pending.join(open_ids.unionByName(missing), "_id", "left_semi")
            n_pending = pending.count()
            radius *= 4
        if n_pending > 0:
            rest = pending.drop(acol, "_slack")
            finished.append(self._blocked(rest, n_pending).select("query_id", "rank", "train_id", "distance", "target"))
        out = finished[0]
        for part in finished[1:]:
            out = out.unionByName(part)
        return out

    # --- public ---------------------------------------------------------------

    def neighbours(self, queries: DataFrame, features: Sequence[str] | str, id_col: str = "id",
                   validate: bool = True) -> DataFrame:
        """(query_id, rank, train_id, distance, target): the k nearest training
        rows of every query row, rank 1 = nearest."""
        m: Matrix = as_matrix(queries, features, id_col)
        if validate:
            res = scan(m)
            if res.n_features != self.n_features:
                raise E.FeatureCountMismatch(expected=self.n_features, actual=res.n_features)
            n_query = res.n_rows
            repeated = queries.groupBy(id_col).count().filter("count > 1").first()
            if repeated is not None:  # one prediction per id: rows must not fold into one
                raise E.DuplicateId(id=repeated[0])
        else:
            m = check_feature_count(self.n_features, m, False)
            n_query = queries.count()
        d = self.n_features
        q = queries.select(
            F.col(id_col).alias("_id"), *[x.alias(f"_x{i}") for i, x in enumerate(m.xs(d))]
        )
        keys = None if _is_integral(queries, id_col) else ordered_keys(queries, id_col)
        out = self._search_distinct(_with_keys(q, "_id", keys))
        names = {"query_id": (keys, queries.schema[id_col].dataType), "train_id": (self.id_keys, self.id_type)}
        for name, (k, id_type) in names.items():
            if k is None:
                out = out.withColumn(name, F.col(name).cast(id_type))
            else:
                out = out.join(k.withColumnRenamed("_key", name), name).drop(name).withColumnRenamed("_orig", name)
        return out.select("query_id", "rank", "train_id", "distance", "target")

    def predict(self, queries: DataFrame, features: Sequence[str] | str, id_col: str = "id",
                output: str = "prediction", validate: bool = True) -> DataFrame:
        """(query_id, prediction) for every query row."""
        nb = self.neighbours(queries, features, id_col, validate)
        return predictions_from_neighbours(nb, self.weighting, output)


def _with_keys(df: DataFrame, id_col: str, keys: DataFrame | None) -> DataFrame:
    """``df`` with a long in its id column."""
    if keys is None:
        return df.withColumn(id_col, F.col(id_col).cast("long"))
    return df.withColumnRenamed(id_col, "_orig").join(keys, "_orig").drop("_orig").withColumnRenamed("_key", id_col)


def predictions_from_neighbours(nb: DataFrame, weighting: str, output: str = "prediction") -> DataFrame:
    """Fold each query's k neighbours in rank order (k is bounded, so the
    per-query list is small)."""
    arr = F.array_sort(F.collect_list(F.struct("rank", "distance", "target")))
    g = nb.groupBy("query_id").agg(arr.alias("_nb"))
    nbs = F.col("_nb")

    def fold(fn):
        return F.aggregate(nbs, F.lit(0.0), lambda acc, e: acc + fn(e))

    if weighting == "uniform":
        votes = fold(lambda e: F.lit(1.0) * e["target"])
        weight = fold(lambda e: F.lit(1.0))
        pred = F.when(weight != 0.0, votes / weight).otherwise(F.lit(0.0))
    else:
        inv = lambda e: F.lit(1.0) / e["distance"]  # noqa: E731 - only used where distance > 0
        votes = fold(lambda e: inv(e) * e["target"])
        weight = fold(inv)
        weighted = F.when(weight != 0.0, votes / weight).otherwise(F.lit(0.0))
        zeros = F.filter(nbs, lambda e: e["distance"] == 0.0)
        exact = F.aggregate(zeros, F.lit(0.0), lambda acc, e: acc + e["target"]) / F.size(zeros)
        pred = F.when(F.size(zeros) > 0, exact).otherwise(weighted)
    return g.select("query_id", pred.alias(output))


class KNeighborsRegressor(FittedState):
    def __init__(self, k: int, weighting: str = "uniform", metric: str = "euclidean",
                 train_block_rows: int = 200_000, query_block_rows: int = 50_000,
                 strategy: str = "auto", band_rows: int | None = None, cell_rows: int | None = None):
        if weighting not in WEIGHTINGS:
            raise ValueError(f"weighting must be one of {WEIGHTINGS}")
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        self.k = int(k)
        self.weighting = weighting
        self.metric = check_metric(metric)
        self.train_block_rows = int(train_block_rows)
        self.query_block_rows = int(query_block_rows)
        self.strategy = strategy
        self.band_rows = band_rows
        self.cell_rows = cell_rows

    def fit(self, df: DataFrame, features: Sequence[str] | str, target: str, id_col: str = "id") -> KNNModel:
        """Checks the training matrix and targets; the model is lazy (no
        distances are computed until prediction)."""
        m = as_matrix(df, features, id_col)
        narrow = not m.is_array and m.n_features <= BAND_MAX_FEATURES
        res = scan(m, target=target, moments=narrow)
        spread = res.sd
        if spread is None and res.n_features <= BAND_MAX_FEATURES:
            row = df.agg(*[F.stddev_samp(x) for x in res.matrix.xs(res.n_features)]).first()
            spread = np.array([v if v is not None else 0.0 for v in row], dtype=float)
        n, d = res.n_rows, res.n_features
        if self.k < 1 or self.k > n:
            raise E.InvalidK(k=self.k, sample_count=n)
        xs = res.matrix.xs(d)
        train = df.select(
            F.col(id_col).alias("_tid"), *[x.alias(f"_x{i}") for i, x in enumerate(xs)], F.col(target).cast("double").alias("_y")
        )
        keys = None if _is_integral(df, id_col) else ordered_keys(df, id_col)
        return self._keep(KNNModel(
            train=_with_keys(train, "_tid", keys), id_keys=keys, n_train=n, n_features=d, k=self.k, weighting=self.weighting, metric=self.metric,
            id_type=df.schema[id_col].dataType, train_block_rows=self.train_block_rows,
            query_block_rows=self.query_block_rows, spread=spread, strategy=self.strategy,
            band_rows=self.band_rows, cell_rows=self.cell_rows,
        ))
