"""Column moments, standardisation and the covariance of standardised data.

fit: one pass (checks + mean, sample sd, min, max per column).
apply: a narrow projection with the moments as literals (no shuffle, works
on streaming DataFrames too); array rows beyond ``WIDE`` features as matrices.
covariance: d(d+1)/2 covariances in the same pass as the checks and moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import Matrix, as_matrix
from .checks import ScanResult, check_feature_count, check_variance, scan
from .gram import WIDE, blocked_gram
from .wide import scaled_column


@dataclass(frozen=True)
class StandardiserModel:
    mean: np.ndarray
    sd: np.ndarray
    n_rows: int
    names: tuple[str, ...]

    @property
    def n_features(self) -> int:
        return len(self.mean)

    def exprs(self, xs: Sequence[Column]) -> list[Column]:
        return [(x - F.lit(float(m))) / F.lit(float(s)) for x, m, s in zip(xs, self.mean, self.sd, strict=True)]

    def transform(
        self,
        df: DataFrame,
        features: Sequence[str] | str,
        id_col: str = "id",
        output: Sequence[str] | str | None = None,
        keep: Sequence[str] = (),
        validate: bool = True,
    ) -> DataFrame:
        """Standardised features.  ``output`` names the result columns (default:
        the input names; for an array input, an array column of the same name)."""
        m = check_feature_count(self.n_features, as_matrix(df, features, id_col), validate)
        keep_cols = [F.col(c) for c in keep]
        name = output if isinstance(output, str) else m.array_col
        if m.is_array and self.n_features > WIDE:
            scaled = scaled_column(m.vector(self.n_features), self.mean, self.sd)
            return df.select(F.col(id_col), *keep_cols, scaled.alias(name))
        zs = self.exprs(m.xs(self.n_features))
        if m.is_array:
            return df.select(F.col(id_col), *keep_cols, F.array(*zs).alias(name))
        names = list(output) if output is not None else list(m.columns)
        return df.select(F.col(id_col), *keep_cols, *[z.alias(n) for z, n in zip(zs, names, strict=True)])

    def moments_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i + 1, self.names[i], float(self.mean[i]), float(self.sd[i]), int(self.n_rows))
            for i in range(self.n_features)
        ]
        return spark.createDataFrame(
            rows, "column_position int, column_name string, mean double, stddev double, n_rows long"
        )


class Standardiser:
    """``(x - mean) / sample_sd`` per column; a constant column is an error
    (ZeroVarianceFeature), never silently mapped to 0."""

    def fit(self, df: DataFrame, features: Sequence[str] | str, id_col: str = "id") -> StandardiserModel:
        res = scan(as_matrix(df, features, id_col), moments=True)
        return model_from_scan(res)


def model_from_scan(res: ScanResult) -> StandardiserModel:
    check_variance(res)
    m = res.matrix
    names = tuple(m.columns) if not m.is_array else tuple(f"{m.array_col}[{i}]" for i in range(res.n_features))
    return StandardiserModel(mean=res.mean, sd=res.sd, n_rows=res.n_rows, names=names)


def standardise(df: DataFrame, features: Sequence[str] | str, id_col: str = "id", **kw) -> DataFrame:
    """Fit and apply in one call."""
    model = Standardiser().fit(df, features, id_col)
    return model.transform(df, features, id_col, validate=False, **kw)  # the fit has checked it


def column_moments(df: DataFrame, features: Sequence[str] | str, id_col: str = "id") -> DataFrame:
    """Per-column mean and sample standard deviation (checked input)."""
    model = Standardiser().fit(df, features, id_col)
    return model.moments_frame(df.sparkSession)


def _covariance_aggs(xs: Sequence[Column]) -> list[Column]:
    d = len(xs)
    return [F.covar_pop(xs[i], xs[j]).alias(f"cov{i}_{j}") for i in range(d) for j in range(i, d)]


def scan_with_covariance(m: Matrix) -> ScanResult:
    """Checks, moments and covariances in one pass: column expressions for up
    to ``WIDE`` named columns, else Arrow batches (up to their width limit)."""
    named = not m.is_array and m.n_features <= WIDE
    return scan(m, moments=True, extra_aggs=_covariance_aggs(m.xs()) if named else None, comoments=not named)


def standardised_covariance(res: ScanResult, model: StandardiserModel) -> np.ndarray:
    """Covariance of the standardised matrix, divided by n: the columns'
    covariances over their standard deviations.  Matrices too wide for the
    scan's co-moments take one more aggregate."""
    m, d = res.matrix, model.n_features
    if res.comoment is not None:
        return res.comoment / res.n_rows / np.outer(model.sd, model.sd)
    if d > WIDE:
        return blocked_gram(m.df, m.xs(d), model.mean, model.sd) / res.n_rows
    row = res.extra or m.df.agg(*_covariance_aggs(m.xs(d))).first()
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = row[f"cov{i}_{j}"] / (model.sd[i] * model.sd[j])
    return cov


def covariance_of_standardised(df: DataFrame, features: Sequence[str] | str, id_col: str = "id"):
    """Covariance of the standardised data, divided by n (so the diagonal is
    (n-1)/n, not 1).  Returns (matrix, model)."""
    res = scan_with_covariance(as_matrix(df, features, id_col))
    model = model_from_scan(res)
    return standardised_covariance(res, model), model


def covariance_matrix(df: DataFrame, features: Sequence[str] | str, id_col: str = "id") -> DataFrame:
    """Long form: (row_position, column_position, covariance)."""
    cov, model = covariance_of_standardised(df, features, id_col)
    d = cov.shape[0]
    rows = [(i + 1, j + 1, float(cov[i, j])) for i in range(d) for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "row_position int, column_position int, covariance double")
