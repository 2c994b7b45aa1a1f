"""Embedding near-duplicates by a subspace pigeonhole join.

Two unit vectors of cosine c lie sqrt(2 - 2c) apart.  The vectors are turned
into an orthonormal frame (the principal directions of all unit vectors, so
that the leading coordinates spread widest) and the leading coordinates are
split into ``BLOCKS`` blocks of ``DIMS``.  Squared distances add up over
blocks, so a linked pair stays within its proportional share of the squared
distance, (2 - 2c) / BLOCKS, in at least one block.

Per block a range join on a grid: cells twice as wide as the block's radius, a
vector at home in one cell and a guest in the neighbouring cells that its
radius reaches, of which only those after its own count (one of any two
neighbours comes to the other).  Cells of more than ``CELL_ROWS`` vectors are
compared chunk by chunk.  A task holds two chunks at most, verifies candidates
by the cosine of the original vectors in double precision, and returns link
counts and a spanning forest, never pairs.  A pair that meets in several blocks
counts in the first: where it meets follows from whole cell numbers that travel
with the vectors, so every task decides alike.

Equal vectors of a label are one node with a count; links between nodes make
components.  No frame, grid or chunk size can change the result.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows of null label, link with nothing; vectors of different
lengths never link; rows that repeat are vectors each and link to one another;
a row of null id counts as a neighbour but names no component (its own is null
if no member has an id); huge and tiny components are scaled first; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.combine import NO_LONGS, n_tasks, partial_sums, tree_sum
from .common import checkpointed, read, run_starts
from .components import connected

COSINE = 0.93
BLOCKS, DIMS = 4, 2
CELL_ROWS = 8192
#: Cells of the table of cosines that one matrix product fills.
TABLE_CELLS = 1 << 20
#: Widths up to which the frame is fitted (a d x d sum); wider vectors get a fixed random one.
FITTED_WIDTH = 1024
#: Rows of the table of large cells up to which it is broadcast.
BROADCAST_ROWS = 100_000
#: Relative and absolute allowance for rounding, in distances of unit vectors.
SLACK = 1e-9


def valid_vector(v: Column) -> Column:
    """Not null or empty, every component finite, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def vectors_of(col: pa.Array) -> list[np.ndarray]:
    """The rows of an array column without nulls, in double precision."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(pc.list_value_length(col).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1].astype(np.int64))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, exactly, so that no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def by_width(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of each width in a batch."""
    rows = vectors_of(col)
    width = np.array([len(r) for r in rows])
    for d in np.unique(width):
        at = np.flatnonzero(width == d)
        yield at, unit(np.stack([rows[i] for i in at]))


# frame and grid --------------------------------------------------------------

def frame(d: int, size: int, gram: np.ndarray | None = None) -> np.ndarray:
    """``size`` (at most d) orthonormal directions, as columns: the principal
    ones of ``gram``, or fixed random ones."""
    size = min(size, d)
    if gram is not None:
        return np.linalg.eigh(gram)[1][:, ::-1][:, :size]
    return np.linalg.qr(np.random.default_rng(d).standard_normal((d, size)))[0]


def fitted_gram(nodes: DataFrame, d: int) -> np.ndarray:
    """Sum of u u^T over the unit vectors of width d, added up level by level."""
    have = nodes.where(F.size("v") == d).select("v")

    def add(b: pa.RecordBatch, total: tuple | None) -> tuple:
        u = unit(np.stack(vectors_of(b.column(0))))
        return (u.T @ u if total is None else total[0] + u.T @ u, NO_LONGS)

    return tree_sum(partial_sums(have, add), n_tasks(have))[0].reshape(d, d)


class Grid:
    """Cells of the leading coordinates, block by block."""

    def __init__(self, cosine: float, blocks: int, dims: int):
        self.far = 2.0 - 2.0 * cosine
        self.blocks, self.dims = blocks, dims

    def shape(self, coordinates: int) -> list[slice]:
        return [slice(a, min(a + self.dims, coordinates)) for a in range(0, coordinates, self.dims)][: self.blocks]

    def place(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers, and reach: +1 / +2 where the radius goes into the cell above / below."""
        r = np.sqrt(self.far / len(self.shape(y.shape[1]))) * (1 + SLACK) + SLACK
        q = np.floor(y / (2 * r))
        reach = (y + r >= (q + 1) * 2 * r) + 2 * (y - r <= q * 2 * r)
        return q.astype(np.int32), reach.astype(np.int32)

    def visits(self, q: np.ndarray, reach: np.ndarray, block: slice) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(rows, cells, at home) of a block: every row's own cell and the later neighbours it reaches."""
        own, wide = q[:, block], reach[:, block]
        m = own.shape[1]
        for step in np.ndindex(*[3] * m):
            move = np.array(step) - 1
            ahead = move[np.flatnonzero(move)[:1]]
            if len(ahead) and ahead[0] < 0:
                continue
            able = np.all((move == 0) | ((move == 1) & (wide & 1 > 0)) | ((move == -1) & (wide & 2 > 0)), axis=1)
            at = np.flatnonzero(able)
            yield at, own[at] + move.astype(np.int32), not move.any()

    def meet(self, q: np.ndarray, reach: np.ndarray, i: np.ndarray, j: np.ndarray, block: slice) -> np.ndarray:
        """Whether rows i and j share a cell of the block that is home to one of them."""
        a, b = q[i][:, block], q[j][:, block]
        delta = b - a
        first = np.argmax(delta != 0, axis=1)
        swap = np.take_along_axis(delta, first[:, None], 1)[:, 0] < 0  # j's home comes first: j is the guest
        delta = np.where(swap[:, None], -delta, delta)
        wide = np.where(swap[:, None], reach[j][:, block], reach[i][:, block])
        return np.all((delta == 0) | ((delta == 1) & (wide & 1 > 0)) | ((delta == -1) & (wide & 2 > 0)), axis=1)


def _visits(nodes: DataFrame, grid: Grid, frames: dict[int, np.ndarray]) -> DataFrame:
    """One row per node and cell it is in: block, cell (as text), home, and the node's grid places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            for at, u in by_width(b.column("v")):
                d = u.shape[1]
                y = u @ (frames[d] if d in frames else frame(d, grid.blocks * grid.dims))
                q, reach = grid.place(y)
                some = b.take(pa.array(at))
                packed = pa.array([x.tobytes() for x in np.hstack([q, reach])], pa.binary())
                for n, block in enumerate(grid.shape(y.shape[1])):
                    for rows, cells, home in grid.visits(q, reach, block):
                        if not len(rows):
                            continue
                        seen, take = some.take(pa.array(rows)), pa.array(rows)
                        yield pa.RecordBatch.from_arrays(
                            [
                                *[seen.column(c) for c in ("node", "label", "v", "n")], packed.take(take), pa.array(np.full(len(rows), d, np.int32)),
                                pa.array(np.full(len(rows), n, np.int32)), pa.array([x.tobytes() for x in cells], pa.binary()), pa.array(np.full(len(rows), home)),
                            ],
                            ["node", "label", "v", "n", "place", "d", "block", "cell", "home"],
                        )

    kinds = {f.name: f.dataType for f in nodes.schema.fields}
    schema = T.StructType(
        [T.StructField(c, kinds[c]) for c in ("node", "label", "v", "n")]
        + [T.StructField("place", T.BinaryType()), T.StructField("d", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("cell", T.BinaryType()), T.StructField("home", T.BooleanType())]
    )
    return nodes.select("node", "label", "v", "n").mapInArrow(run, schema)


# candidates and links --------------------------------------------------------

def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (smallest index) after joining i[x] with j[x]."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def compare(x: np.ndarray, part: np.ndarray, cross: bool, home: np.ndarray, q: np.ndarray, reach: np.ndarray, n: np.ndarray, grid: Grid, block: int, cosine: float):
    """Linked rows of a group: (links of each row, root of each row).

    All rows are compared with each other, in a ``cross`` group only those of
    one ``part`` with those of the other; guests are not compared with guests.
    Links that an earlier block counts are left out."""
    x, u, size = scaled(x), unit(x), len(x)
    links, root = np.zeros(size, np.int64), np.arange(size)
    blocks = grid.shape(q.shape[1])
    step = max(1, TABLE_CELLS // size)
    for at in range(0, size, step):
        table = u[at : at + step] @ u[at:].T
        i, j = np.nonzero(table >= cosine - SLACK)
        score, i, j = table[i, j], i + at, j + at
        ok = (i < j) & (home[i] | home[j]) & ((part[i] != part[j]) | (not cross))
        i, j, score = i[ok], j[ok], score[ok]
        close = np.flatnonzero(score < cosine + SLACK)
        score[close] = exact_cosine(x[i[close]], x[j[close]])
        i, j = i[score >= cosine], j[score >= cosine]
        for earlier in blocks[:block]:
            new = ~grid.meet(q, reach, i, j, earlier)
            i, j = i[new], j[new]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        root = _merge(root, i, j)
    return links, root


def _group_links(grid: Grid, cosine: float):
    names = ["node", "root", "links"]

    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        x = np.stack(vectors_of(rows.column("v")))
        place = np.frombuffer(b"".join(rows.column("place").to_pylist()), np.int32).reshape(len(x), -1)
        q, reach = np.hsplit(place, 2)
        num = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in ("node", "part", "home", "n")}
        cross, block = rows.column("cross")[0].as_py(), rows.column("block")[0].as_py()
        links, root = compare(x, num["part"], cross, num["home"], q, reach, num["n"], grid, block, cosine)
        some, node = np.flatnonzero(links), num["node"]
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[root[some]]), pa.array(links[some])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(g).to_numpy(zero_copy_only=False) for g in ("g1", "g2")]
            starts = run_starts(keys)
            for s, e in zip(starts, [*starts[1:], b.num_rows], strict=True):
                key = keys[0][s], keys[1][s]
                if key != last and held:
                    yield found(held)
                    held = []
                last = key
                held.append(b.slice(s, e - s))
        if held:
            yield found(held)

    return run


def node_links(nodes: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, dims: int = DIMS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """From nodes (node long, label, v array, n long; a label's vectors differ)
    rows (node, root, links): shares of a node's links (copies counted), and
    edges node - root that connect what links connect."""
    widths = nodes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    frames = {}
    if widths is not None and widths["d"] <= FITTED_WIDTH:
        d = widths["d"]
        frames[d] = frame(d, blocks * dims, fitted_gram(nodes, d))
    grid = Grid(cosine, blocks, dims)
    seen = _visits(nodes, grid, frames)
    cell = ["label", "d", "block", "cell"]
    # cells that need several chunks: few, so their table is broadcast up to a counted size
    large = seen.groupBy(*cell).agg(F.count("*").alias("rows")).where(F.col("rows") > cell_rows).select(*cell, F.ceil(F.col("rows") / cell_rows).cast("int").alias("chunks"))
    large = checkpointed(large)
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    dealt = seen.join(large, cell, "left").fillna(1, ["chunks"])
    part = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("part", part).withColumn("other", other)
    low, high = F.least("part", "other"), F.greatest("part", "other")
    keys = [F.xxhash64(*[F.lit(seed), *cell, low, high]) for seed in (1, 2)]
    groups = dealt.select(keys[0].alias("g1"), keys[1].alias("g2"), "node", "v", "n", "place", "block", "home", "part", (low != high).alias("cross"))
    spread = groups.repartition("g1", "g2").sortWithinPartitions("g1", "g2")
    return spread.mapInArrow(_group_links(grid, cosine), "node long, root long, links long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, **kw) -> DataFrame:
    """Every row's ``vec_id``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept``."""
    kind = df.schema[vector_col].dataType
    small = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(vector_col) if small else F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    rows = rows.withColumn("ok", valid_vector(F.col("v")) & F.col("label").isNotNull())
    hashes = [F.when(F.col("ok"), F.xxhash64(F.lit(seed), "label", "v")).alias(f"h{seed}") for seed in (1, 2)]
    rows = rows.select("vec_id", "label", "v", *hashes)
    nodes = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("first_id"), F.count("*").alias("n")
    )
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    found = checkpointed(node_links(nodes, cosine, **kw))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked = comp.join(nodes.select("node", "first_id"), "node")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = comp.join(least, "root").select("node", "component_id", F.lit(True).alias("together"))
    info = nodes.select("h1", "h2", "node", "first_id", "n").join(links, "node", "left").join(named, "node", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.when(F.col("together"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"), F.lit(True).alias("known"),
    )
    out = rows.select("vec_id", "h1", "h2").join(info, ["h1", "h2"], "left")
    root = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), F.col("vec_id").eqNullSafe(root).alias("kept"))


def dedup_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's links and component within its label."""
    return near_duplicates(read(spark, sf_dir, "embeddings"))
