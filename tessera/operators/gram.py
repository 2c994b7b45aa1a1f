"""Cross-product matrices ``sum_i v_i v_i^T`` for wide feature vectors.

Up to ``WIDE`` features the Gram matrix is one aggregate of column
expressions (d(d+1)/2 sums, whole-stage codegen).  Beyond that the number of
expressions explodes, so each task adds up its ``V^T V`` with numpy (BLAS) over
its Arrow batches and emits the upper triangle once, as (index, value) rows; a
grouped sum (partial per task, d(d+1)/2 groups) adds the partials.
Only the d x d result reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDE = 32
# The d x d result lives on the driver: refuse widths beyond this.
MAX_FEATURES = 4_000


def blocked_gram(df: DataFrame, exprs: Sequence[Column], shift: Sequence[float] | None = None,
                 scale: Sequence[float] | None = None) -> np.ndarray:
    """``sum_i v_i v_i^T`` with ``v = (x - shift) / scale`` (both optional)."""
    p = len(exprs)
    if p > MAX_FEATURES:
        raise ValueError(f"{p} features would need a {p} x {p} matrix on the driver; the limit is {MAX_FEATURES}")
    sh = np.zeros(p) if shift is None else np.asarray(shift, dtype=float)
    sc = np.ones(p) if scale is None else np.asarray(scale, dtype=float)
    iu, ju = np.triu_indices(p)
    flat_index = (iu * p + ju).astype(np.int64)
    cols = [f"_v{i}" for i in range(p)]

    def partial(batches):
        g = None
        for b in batches:
            if b.num_rows == 0:
                continue
            v = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols]).astype(np.float64)
            v = (v - sh) / sc
            g = v.T @ v if g is None else g + v.T @ v
        if g is not None:
            yield pa.RecordBatch.from_arrays([pa.array(flat_index), pa.array(g[iu, ju])], names=["k", "v"])

    sums = (
        df.select(*[e.cast("double").alias(c) for e, c in zip(exprs, cols)])
        .mapInArrow(partial, "k long, v double")
        .groupBy("k")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    g = np.zeros((p, p))
    for r in sums:
        i, j = divmod(int(r["k"]), p)
        g[i, j] = g[j, i] = r["v"]
    return g
