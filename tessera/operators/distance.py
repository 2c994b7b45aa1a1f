"""Distances between vectors held in the same row.

``pairwise_distance`` checks every row first (one aggregate): both vectors
non-empty and finite (left first), then equal length; the first bad row in id
order decides the error.  The distance itself is a narrow projection.

``distance_to_group_mean`` pairs each row with the mean vector of its group
(e.g. an embedding and its class centroid): a grouped aggregate (partial per
task, so a hot group costs nothing extra) joined back on the group key.  The
per-group side is tiny; AQE broadcasts it when its measured size allows and
otherwise keeps a shuffle join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import errors as E
from ..frames import as_matrix
from ..functions.vector import array_distance, check_metric, distance, nonfinite
from .checks import scan


def _size(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def _first_bad_index(c: Column) -> Column:
    return F.array_position(F.transform(c, lambda x: nonfinite(x.cast("double"))), True)


def check_vector_pairs(df: DataFrame, left: str, right: str, id_col: str = "id") -> None:
    lc, rc = F.col(left), F.col(right)
    lb, rb = _first_bad_index(lc), _first_bad_index(rc)
    bad = (_size(lc) == 0) | (lb > 0) | (_size(rc) == 0) | (rb > 0) | (_size(lc) != _size(rc))
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(
            F.when(
                bad,
                F.struct(
                    F.col(id_col).alias("id"),
                    _size(lc).alias("ls"),
                    lb.alias("lb"),
                    _size(rc).alias("rs"),
                    rb.alias("rb"),
                ),
            )
        ).alias("bad"),
    ).first()
    b = row["bad"]
    if b is None:
        return
    for size, idx in ((b["ls"], b["lb"]), (b["rs"], b["rb"])):
        if size == 0:
            raise E.EmptyVector()
        if idx and idx > 0:
            raise E.NonFiniteVectorInput(index=idx)
    raise E.VectorLengthMismatch(left=b["ls"], right=b["rs"])


def pairwise_distance(
    df: DataFrame,
    left: str,
    right: str,
    metric: str = "euclidean",
    id_col: str = "id",
    output: str = "distance",
    validate: bool = True,
) -> DataFrame:
    """Append the distance between two array columns of each row."""
    check_metric(metric)
    if validate:
        check_vector_pairs(df, left, right, id_col)
    return df.withColumn(output, array_distance(F.col(left).cast("array<double>"), F.col(right).cast("array<double>"), metric))


def column_distance(
    df: DataFrame,
    left: Sequence[str],
    right: Sequence[str],
    metric: str = "euclidean",
    output: str = "distance",
) -> DataFrame:
    """Distance between two equally long lists of numeric columns."""
    if len(left) != len(right):
        raise E.VectorLengthMismatch(left=len(left), right=len(right))
    if not left:
        raise E.EmptyVector()
    xs = [F.col(c).cast("double") for c in left]
    ys = [F.col(c).cast("double") for c in right]
    return df.withColumn(output, distance(xs, ys, metric))


def group_means(df: DataFrame, features: Sequence[str] | str, id_col: str, group_col: str) -> tuple[DataFrame, int]:
    """Mean vector per group (checked matrix), as (group, array<double>)."""
    res = scan(as_matrix(df, features, id_col))
    xs = res.matrix.xs(res.n_features)
    means = df.groupBy(group_col).agg(*[F.avg(x).alias(f"_m{i}") for i, x in enumerate(xs)])
    return means.select(group_col, F.array(*[F.col(f"_m{i}") for i in range(len(xs))]).alias("_centre")), res.n_features


def distance_to_group_mean(
    df: DataFrame,
    features: Sequence[str] | str,
    id_col: str,
    group_col: str,
    metric: str = "euclidean",
    output: str = "distance",
    means: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """(id, group, distance from the row's vector to its group's mean vector).
    ``means`` takes a ``group_means`` result to share between metrics."""
    check_metric(metric)
    means, d = means if means is not None else group_means(df, features, id_col, group_col)
    m = as_matrix(df, features, id_col).with_width(d)
    rows = df.select(F.col(id_col), F.col(group_col), F.array(*m.xs(d)).alias("_v"))
    centres = means.withColumnRenamed(group_col, "_group")  # rows without a group are one too
    j = rows.join(centres, rows[group_col].eqNullSafe(centres["_group"]))
    return j.select(id_col, group_col, array_distance(F.col("_v"), F.col("_centre"), metric).alias(output))
