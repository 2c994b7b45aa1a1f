"""Feature matrices as DataFrames.

A matrix is a DataFrame with a unique id column plus either

* a list of numeric columns (one feature per column), or
* one ``array<double>``/``array<float>`` column (one row vector per cell).

Row order matters in three places (error positions, k-means initial picks and
nearest-neighbour ties); "row i" always means rank i in ascending id order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Matrix:
    df: DataFrame
    id_col: str
    columns: tuple[str, ...] | None = None
    array_col: str | None = None
    n_features: int | None = None
    guarded: bool = False

    @property
    def is_array(self) -> bool:
        return self.array_col is not None

    def xs(self, n_features: int | None = None) -> list[Column]:
        """Feature expressions cast to double, in feature order."""
        if not self.is_array:
            return [F.col(c).cast("double") for c in self.columns]
        d = n_features if n_features is not None else self.n_features
        if d is None:
            raise ValueError("array feature width unknown: run the matrix check first")
        arr = self._guarded_array(d)
        return [arr[i].cast("double") for i in range(d)]

    def vector(self, n_features: int | None = None) -> Column:
        """All features as one array<double> expression."""
        if not self.is_array:
            return F.array(*self.xs())
        d = n_features if n_features is not None else self.n_features
        return self._guarded_array(d).cast("array<double>")

    def _guarded_array(self, d: int) -> Column:
        arr = F.col(self.array_col)
        if self.guarded:
            width = F.coalesce(F.size(arr), F.lit(0))
            message = F.concat(F.lit("FeatureCountMismatch: feature count "), width.cast("string"), F.lit(f" does not match expected {d}"))
            arr = F.when(width == d, arr).otherwise(F.raise_error(message))
        return arr

    def with_width(self, d: int) -> "Matrix":
        return Matrix(self.df, self.id_col, self.columns, self.array_col, d)

    def with_guard(self, d: int) -> "Matrix":
        """Width ``d``; an array row of any other width fails the query when
        it is scored (a narrow expression, so it also works on streams)."""
        return Matrix(self.df, self.id_col, self.columns, self.array_col, d, self.is_array)

    def source_columns(self) -> list[str]:
        return list(self.columns) if not self.is_array else [self.array_col]


def as_matrix(df: DataFrame, features: Sequence[str] | str, id_col: str = "id") -> Matrix:
    """Normalise ``features`` (column list or one array column name)."""
    if isinstance(features, str):
        return Matrix(df, id_col, None, features, None)
    cols = tuple(features)
    if not cols:
        raise ValueError("at least one feature column is required")
    return Matrix(df, id_col, cols, None, len(cols))
