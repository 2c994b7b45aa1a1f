"""Checks, moments and co-moments of row vectors in one pass.

Column expressions need the width beforehand, and stop compiling for wide
vectors.  Here each task reads Arrow batches of (id, vector), learns the width
from its rows, and keeps one state: row count, widths, the first row that holds
a non-finite cell, and per column mean, squared deviations, minimum, maximum
and (for up to ``COMOMENT_FEATURES``) co-moments about the mean.  States are
merged pairwise, level by level (``combine.tree_fold``).

A task that meets two widths keeps the counts and drops the moments: such a
matrix is refused anyhow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import Matrix
from .combine import partial_states, tree_fold

#: Widths up to which the co-moments (half of d x d numbers a task) ride along.
COMOMENT_FEATURES = 512
#: Cells that are widened and centred at once.
CHUNK_CELLS = 2_000_000
ID_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.DecimalType)


def supports(m: Matrix) -> bool:
    """Whether ids compare alike in tasks and in Spark."""
    return isinstance(m.df.schema[m.id_col].dataType, ID_TYPES)


def _least(ids: pa.Array) -> tuple:
    """(present, id) of the smallest id; a null id comes before all others."""
    if ids.null_count:
        return (False, None)
    return (True, pc.min(ids).as_py())


def _at(ids: pa.Array, least: tuple) -> np.ndarray:
    hit = pc.equal(ids, pa.scalar(least[1], ids.type)) if least[0] else pc.is_null(ids)
    return hit.to_numpy(zero_copy_only=False).astype(bool)


def _earlier(a: tuple | None, b: tuple | None) -> tuple | None:
    """The smaller of two (present, id, number); ids are compared only where both are present."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return b if a[0] else a
    return min(a, b) if a[0] else min(a, b, key=lambda t: t[2])


def moments_of(v: np.ndarray, comoments: bool) -> dict:
    mean = v.mean(axis=0)
    away = v - mean
    return {
        "n": len(v), "mean": mean, "lo": v.min(axis=0), "hi": v.max(axis=0),
        "square": np.einsum("ij,ij->j", away, away), "product": away.T @ away if comoments else None,
    }


def merge_moments(a: dict | None, b: dict | None) -> dict | None:
    """Moments of two disjoint sets of rows put together."""
    if a is None or b is None:
        return b if a is None else a
    n = a["n"] + b["n"]
    gap, weight = b["mean"] - a["mean"], a["n"] * b["n"] / n
    product = None
    if a["product"] is not None and b["product"] is not None:
        product = a["product"] + b["product"] + np.outer(gap, gap) * weight
    return {
        "n": n, "mean": a["mean"] + gap * (b["n"] / n), "lo": np.minimum(a["lo"], b["lo"]), "hi": np.maximum(a["hi"], b["hi"]),
        "square": a["square"] + b["square"] + gap * gap * weight, "product": product,
    }


def merge_states(a: dict, b: dict) -> dict:
    low, high = min(a["min_size"], b["min_size"]), max(a["max_size"], b["max_size"])
    with np.errstate(all="ignore"):
        return {
            "n": a["n"] + b["n"], "min_size": low, "max_size": high, "first": _earlier(a["first"], b["first"]), "bad": _earlier(a["bad"], b["bad"]),
            "moments": merge_moments(a["moments"], b["moments"]) if low == high else None,
        }


def batch_state(ids: pa.Array, column: pa.Array, comoments: bool) -> dict:
    """The state of some rows (at least one)."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)  # a null cell is not finite
    least = _least(ids)
    state = {
        "n": len(ids), "min_size": int(sizes.min()), "max_size": int(sizes.max()),
        "first": (*least, int(sizes[_at(ids, least)].min())), "bad": None, "moments": None,
    }
    wrong = np.flatnonzero(~np.isfinite(cells))
    if len(wrong):
        ends = np.cumsum(sizes)
        rows = np.searchsorted(ends, wrong, side="right")
        cols = wrong - (ends - sizes)[rows] + 1
        bad_ids = ids.take(pa.array(rows))
        least = _least(bad_ids)
        state["bad"] = (*least, int(cols[_at(bad_ids, least)].min()))
    d = state["max_size"]
    if d and d == state["min_size"]:
        v, step = cells.reshape(len(ids), d), max(1, CHUNK_CELLS // d)
        with np.errstate(all="ignore"):
            for at in range(0, len(v), step):
                state["moments"] = merge_moments(state["moments"], moments_of(v[at : at + step], comoments and d <= COMOMENT_FEATURES))
    return state


def scan_states(rows: DataFrame, comoments: bool) -> dict | None:
    """The state of all rows of (id, array<double>); None without rows."""

    def add(b: pa.RecordBatch, state: dict | None) -> dict:
        new = batch_state(b.column(0), b.column(1), comoments)
        return new if state is None else merge_states(state, new)

    return tree_fold(partial_states(rows, add), merge_states)


def array_scan(m: Matrix, comoments: bool) -> dict:
    """One pass over a matrix (array rows, or many named columns taken as one
    array): the figures that ``checks.scan`` asks for."""
    vector = F.col(m.array_col).cast("array<double>") if m.is_array else F.array(*m.xs())
    state = scan_states(m.df.select(F.col(m.id_col).alias("_id"), vector.alias("_v")), comoments)
    if state is None:
        return {"_n": 0}
    bad, got = state["bad"], state["moments"]
    out = {
        "_n": state["n"], "_min_size": state["min_size"], "_max_size": state["max_size"],
        "_first": {"id": state["first"][1], "size": state["first"][2]}, "_bad": bad and {"id": bad[1], "col": bad[2]},
    }
    if got is not None:
        free = state["n"] - 1
        out["_moments"] = {
            "mean": got["mean"], "lo": got["lo"], "hi": got["hi"], "comoment": got["product"],
            "sd": np.sqrt(got["square"] / free) if free else np.full(len(got["mean"]), np.nan),
        }
    return out
