"""Data checks (matrix, targets, logistic target domain, variance).

Each check is one global aggregate over the whole DataFrame; only a handful of
numbers reach the driver.  A failing check pays for one more job: turning the
offending id into its 1-based rank (``count(id <= bad_id)``).

Precedence follows the estimators: matrix (empty dataset, then the first bad
row: empty, ragged, first non-finite cell) -> targets (empty, count, first
non-finite) -> logistic domain -> sample count -> constant column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import errors as E
from ..frames import Matrix
from ..functions.vector import nonfinite
from .array_scan import array_scan, supports


#: Named columns beyond which moments are taken from one array in Arrow batches.
WIDE_COLUMNS = 32


@dataclass
class ScanResult:
    n_rows: int
    n_features: int
    matrix: Matrix
    mean: np.ndarray | None = None
    sd: np.ndarray | None = None
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None
    comoment: np.ndarray | None = None  # sums of products about the means
    extra: dict = field(default_factory=dict)


def rank_of(df: DataFrame, id_col: str, bad_id) -> int:
    """1-based position of ``bad_id`` in ascending id order."""
    return df.filter(F.col(id_col) <= F.lit(bad_id)).count()


def _first_bad_named(m: Matrix) -> Column:
    xs = m.xs()
    bads = [nonfinite(x) for x in xs]
    any_bad = bads[0]
    for b in bads[1:]:
        any_bad = any_bad | b
    col_no = F.coalesce(*[F.when(b, F.lit(i + 1)) for i, b in enumerate(bads)])
    return F.min(F.when(any_bad, F.struct(F.col(m.id_col).alias("id"), col_no.alias("col"))))


def _array_size(m: Matrix) -> Column:
    return F.coalesce(F.size(F.col(m.array_col)), F.lit(0))


def _array_first_nonfinite(m: Matrix) -> Column:
    flags = F.transform(F.col(m.array_col), lambda x: nonfinite(x.cast("double")))
    return F.array_position(flags, True)


def _target_aggs(m: Matrix, target: str, logistic: bool) -> list[Column]:
    y = F.col(target).cast("double")
    idc = F.col(m.id_col)
    aggs = [
        F.count(y).alias("_n_y"),
        F.min(F.when(y.isNotNull() & nonfinite(y), idc)).alias("_bad_y"),
    ]
    if logistic:
        aggs.append(F.min(F.when(y.isNotNull() & ~nonfinite(y) & ((y < 0.0) | (y > 1.0)), idc)).alias("_out_y"))
    return aggs


def _moment_aggs(xs: list[Column]) -> list[Column]:
    aggs = []
    for i, x in enumerate(xs):
        aggs += [
            F.avg(x).alias(f"_mean{i}"),
            F.stddev_samp(x).alias(f"_sd{i}"),
            F.min(x).alias(f"_lo{i}"),
            F.max(x).alias(f"_hi{i}"),
        ]
    return aggs


def _raise_targets(m: Matrix, row, n: int, logistic: bool) -> None:
    n_y = row["_n_y"]
    if n_y == 0:
        raise E.EmptyTargets()
    if n_y != n:
        raise E.TargetLengthMismatch(samples=n, targets=n_y)
    if row["_bad_y"] is not None:
        raise E.NonFiniteTarget(index=rank_of(m.df, m.id_col, row["_bad_y"]))
    if logistic and row["_out_y"] is not None:
        raise E.TargetOutOfRange(index=rank_of(m.df, m.id_col, row["_out_y"]))


def scan(
    m: Matrix,
    target: str | None = None,
    logistic: bool = False,
    moments: bool = False,
    extra_aggs: list[Column] | None = None,
    comoments: bool = False,
) -> ScanResult:
    """Validate a matrix (and optionally targets) and gather per-column moments.

    One job: column expressions for named columns and for checks alone;
    moments of array rows and of many named columns in Arrow batches
    (``array_scan``; with ``comoments`` up to its width limit).  Array rows
    with targets or ids of other types take a second job for moments.
    """
    df, idc = m.df, F.col(m.id_col)
    extra_aggs = list(extra_aggs or [])
    wide = m.is_array or m.n_features > WIDE_COLUMNS
    in_arrow = moments and wide and target is None and not extra_aggs and supports(m)
    if not m.is_array and in_arrow:
        row = array_scan(m, comoments)
        n, d = row["_n"], m.n_features
        if n == 0:
            raise E.EmptyDataset()
        if row["_bad"] is not None:
            raise E.NonFiniteInput(row=rank_of(df, m.id_col, row["_bad"]["id"]), column=row["_bad"]["col"])
    elif not m.is_array:
        aggs = [F.count(F.lit(1)).alias("_n"), _first_bad_named(m).alias("_bad")]
        if target is not None:
            aggs += _target_aggs(m, target, logistic)
        if moments:
            aggs += _moment_aggs(m.xs())
        row = df.agg(*aggs, *extra_aggs).first()
        n = row["_n"]
        if n == 0:
            raise E.EmptyDataset()
        if row["_bad"] is not None:
            raise E.NonFiniteInput(row=rank_of(df, m.id_col, row["_bad"]["id"]), column=row["_bad"]["col"])
        d = m.n_features
    else:
        size = _array_size(m)
        aggs = [
            F.count(F.lit(1)).alias("_n"),
            F.min(size).alias("_min_size"),
            F.max(size).alias("_max_size"),
            F.min(F.struct(idc.alias("id"), size.alias("size"))).alias("_first"),
            F.min(F.when(_array_first_nonfinite(m) > 0, F.struct(idc.alias("id"), _array_first_nonfinite(m).alias("col")))).alias("_bad"),
        ]
        if target is not None:
            aggs += _target_aggs(m, target, logistic)
        row = array_scan(m, comoments) if in_arrow else df.agg(*aggs).first()
        n = row["_n"]
        if n == 0:
            raise E.EmptyDataset()
        expected = row["_first"]["size"]
        if expected == 0:
            raise E.EmptyRow(row=1)
        if row["_min_size"] != row["_max_size"]:
            # Second pass only on failure: first row that is empty or ragged
            # or holds a non-finite cell, in id order.
            bad = df.agg(
                F.min(
                    F.when(
                        (size != F.lit(expected)) | (_array_first_nonfinite(m) > 0),
                        F.struct(idc.alias("id"), size.alias("size"), _array_first_nonfinite(m).alias("col")),
                    )
                )
            ).first()[0]
            pos = rank_of(df, m.id_col, bad["id"])
            if bad["size"] == 0:
                raise E.EmptyRow(row=pos)
            if bad["size"] != expected:
                raise E.RaggedMatrix(row=pos, expected=expected, actual=bad["size"])
            raise E.NonFiniteInput(row=pos, column=bad["col"])
        if row["_bad"] is not None:
            raise E.NonFiniteInput(row=rank_of(df, m.id_col, row["_bad"]["id"]), column=row["_bad"]["col"])
        d = expected
        m = m.with_width(d)
        if (moments and not in_arrow) or extra_aggs:
            more = _moment_aggs(m.xs()) if moments else []
            mrow = df.agg(F.count(F.lit(1)).alias("_n2"), *more, *extra_aggs).first().asDict()
            row = {**row.asDict(), **mrow}
    if target is not None:
        _raise_targets(m, row, n, logistic)
    res = ScanResult(n_rows=n, n_features=d, matrix=m)
    if in_arrow:
        got = row["_moments"]
        res.mean, res.sd, res.lo, res.hi, res.comoment = (got[k] for k in ("mean", "sd", "lo", "hi", "comoment"))
    elif moments:
        res.mean = np.array([row[f"_mean{i}"] for i in range(d)], dtype=float)
        res.sd = np.array([row[f"_sd{i}"] if row[f"_sd{i}"] is not None else np.nan for i in range(d)], dtype=float)
        res.lo = np.array([row[f"_lo{i}"] for i in range(d)], dtype=float)
        res.hi = np.array([row[f"_hi{i}"] for i in range(d)], dtype=float)
    if extra_aggs:
        res.extra = {k: v for k, v in (row.asDict() if hasattr(row, "asDict") else row).items() if not k.startswith("_")}
    return res


def check_variance(res: ScanResult) -> None:
    """At least two samples and no constant column (lowest column wins)."""
    if res.n_rows < 2:
        raise E.InsufficientSamples(samples=res.n_rows)
    for i in range(res.n_features):
        if res.lo[i] == res.hi[i]:
            raise E.ZeroVarianceFeature(column=i + 1)


def check_matrix(m: Matrix) -> ScanResult:
    return scan(m)


def check_feature_count(expected: int, m: Matrix, validate: bool) -> Matrix:
    """Prediction inputs: matrix check (optional) then feature count.  Without
    the check, array rows of another width fail when they are scored."""
    if validate:
        res = scan(m)
        actual = res.n_features
        m = res.matrix
    elif m.is_array:
        m = m.with_guard(expected)  # checked row by row when scored
        actual = expected
    else:
        actual = m.n_features
    if actual != expected:
        raise E.FeatureCountMismatch(expected=expected, actual=actual)
    return m


def check_tolerance(tolerance: float, algorithm: str) -> None:
    if not (np.isfinite(tolerance) and tolerance >= 0.0):
        raise E.InvalidTolerance(algorithm=algorithm)


# --- report forms (DataFrames) ---------------------------------------------


def matrix_report(m: Matrix) -> DataFrame:
    """One-row summary of a matrix check, without raising.

    Columns: n_rows, n_empty_rows, n_nonfinite_cells, n_bad_rows, first_bad_id
    (plus min_width / max_width for array matrices).  Id columns in the
    report forms hold -1 when there is no such row.
    """
    idc = F.col(m.id_col)
    if not m.is_array:
        bads = [nonfinite(x).cast("int") for x in m.xs()]
        cells = bads[0]
        for b in bads[1:]:
            cells = cells + b
        return m.df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(0).cast("long").alias("n_empty_rows"),
            F.coalesce(F.sum(cells), F.lit(0)).cast("long").alias("n_nonfinite_cells"),
            F.count(F.when(cells > 0, 1)).alias("n_bad_rows"),
            F.coalesce(F.min(F.when(cells > 0, idc)), F.lit(-1)).cast("long").alias("first_bad_id"),
        )
    size = _array_size(m)
    nbad = F.size(F.filter(F.col(m.array_col), lambda x: nonfinite(x.cast("double"))))
    nbad = F.when(size > 0, nbad).otherwise(F.lit(0))
    return m.df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(size == 0, 1)).cast("long").alias("n_empty_rows"),
        F.coalesce(F.sum(nbad), F.lit(0)).cast("long").alias("n_nonfinite_cells"),
        F.count(F.when((size == 0) | (nbad > 0), 1)).alias("n_bad_rows"),
        F.coalesce(F.min(F.when((size == 0) | (nbad > 0), idc)), F.lit(-1)).cast("long").alias("first_bad_id"),
        F.min(size).alias("min_width"),
        F.max(size).alias("max_width"),
    )


def target_report(df: DataFrame, id_col: str, target: str) -> DataFrame:
    """Targets beside samples: missing (null) and non-finite targets."""
    y = F.col(target).cast("double")
    idc = F.col(id_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count(y).alias("n_targets"),
        F.count(F.when(y.isNotNull() & nonfinite(y), 1)).alias("n_nonfinite_targets"),
        F.coalesce(F.min(F.when(y.isNull(), idc)), F.lit(-1)).cast("long").alias("first_missing_id"),
        F.coalesce(F.min(F.when(y.isNotNull() & nonfinite(y), idc)), F.lit(-1)).cast("long").alias("first_nonfinite_id"),
    )


def logistic_target_report(df: DataFrame, id_col: str, target: str) -> DataFrame:
    """Targets outside [0, 1] (fractions inside are accepted)."""
    y = F.col(target).cast("double")
    out = y.isNotNull() & ~nonfinite(y) & ((y < 0.0) | (y > 1.0))
    return df.agg(
        F.count(y).alias("n_targets"),
        F.count(F.when(out, 1)).alias("n_out_of_range"),
        F.coalesce(F.min(F.when(out, F.col(id_col))), F.lit(-1)).cast("long").alias("first_out_of_range_id"),
        F.min(y).alias("min_target"),
        F.max(y).alias("max_target"),
    )


def variance_report(m: Matrix, d: int | None = None) -> DataFrame:
    """One row per feature: position, min, max and whether it is constant."""
    xs = m.xs(d)
    names = list(m.columns) if not m.is_array else [f"{m.array_col}[{i}]" for i in range(len(xs))]
    row = m.df.agg(
        *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)],
        *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)],
        F.count(F.lit(1)).alias("n"),
    )
    parts = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("column_position"),
                F.lit(name).alias("column_name"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
            )
            for i, name in enumerate(names)
        ]
    )
    return row.select(F.col("n").alias("n_samples"), F.inline(parts)).select(
        "column_position",
        "column_name",
        "n_samples",
        "min_value",
        "max_value",
        (F.col("min_value") == F.col("max_value")).alias("is_constant"),
    )
