"""Gradient-descent linear and logistic regression.

Both prepend an intercept (weight 0), start from zero weights and take exactly
``iterations`` full-batch steps ``w <- w - lr * X^T (f(Xw) - y) / n``, with
no early stop and no regularisation.  The loss is recorded *before* each step
at iterations 0, 100, 200, ...

Linear: the gradient is ``(G w - b) / n`` with ``G = X^T X`` and ``b = X^T y``,
so the whole fit needs one aggregate job (d+1)(d+2)/2 + d+1 sums, merged
with the input checks; the recurrence then runs on the driver on a
(d+1)x(d+1) matrix.  The loss trace is one more job that evaluates the
per-row squared error for every recorded weight vector at once.

Logistic: no closed form, so one aggregate job per iteration over the
persisted input, with the current weights as literals (lineage never grows);
beyond ``WIDE`` features the step is a matrix product per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import errors as E
from ..frames import Matrix, as_matrix
from ..functions import sqltext as S
from ..functions.vector import affine, log_loss, sigmoid
from ..session import ITERATION_CONF, persist, scoped_conf
from . import barrier
from .checks import check_feature_count, scan
from .estimator import FittedState
from .gram import WIDE, blocked_gram
from .wide import affine_column, logistic_part, logistic_sums, vectors

TRACE_EVERY = 100


@dataclass
class LinearModel:
    weights: np.ndarray
    losses: dict[int, float] = field(default_factory=dict)
    diverged: bool = False

    @property
    def n_features(self) -> int:
        return len(self.weights) - 1

    def link(self, z: Column) -> Column:
        return z

    def predict(self, df: DataFrame, features: Sequence[str] | str, id_col: str = "id",
                output: str = "prediction", validate: bool = True) -> DataFrame:
        m = check_feature_count(self.n_features, as_matrix(df, features, id_col), validate)
        wide = self.n_features > WIDE
        z = affine_column(m.vector(self.n_features), self.weights) if wide else affine(m.xs(self.n_features), self.weights)
        return df.withColumn(output, self.link(z))

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(i, float(w)) for i, w in enumerate(self.weights)], "weight_position int, weight double"
        )

    def loss_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(int(i), float(v)) for i, v in sorted(self.losses.items())], "iteration int, loss double"
        )


@dataclass
class LogisticModel(LinearModel):
    def link(self, z: Column) -> Column:
        return sigmoid(z)


def check_iterations(iterations: int) -> None:
    if iterations < 0:
        raise E.InvalidIterations(iterations=iterations)


def _sufficient_aggs(xs: list[Column], y: Column) -> list[Column]:
    """Upper triangle of X^T X (x_0 = 1), X^T y and y^T y."""
    cols = [F.lit(1.0)] + list(xs)
    p = len(cols)
    aggs = []
    for i in range(p):
        for j in range(i, p):
            term = cols[j] if i == 0 else cols[i] * cols[j]
            aggs.append(F.sum(term).alias(f"g{i}_{j}"))
        aggs.append(F.sum(cols[i] * y if i else y).alias(f"b{i}"))
    return aggs


class LinearRegression(FittedState):
    def __init__(self, learning_rate: float, iterations: int):
        self.learning_rate = float(learning_rate)
        self.iterations = int(iterations)

    def fit(self, df: DataFrame, features: Sequence[str] | str, target: str, id_col: str = "id") -> LinearModel:
        check_iterations(self.iterations)
        m = as_matrix(df, features, id_col)
        y = F.col(target).cast("double")
        if m.is_array or m.n_features > WIDE:
            res = scan(m, target=target)  # learns the width of array rows
            m = res.matrix
            row = None
        else:
            res = scan(m, target=target, extra_aggs=_sufficient_aggs(m.xs(), y))  # checks + sums, one job
            row = res.extra
        n, p = res.n_rows, res.n_features + 1
        if p - 1 > WIDE:
            full = blocked_gram(df, [F.lit(1.0)] + m.xs(p - 1) + [y])
            g, b = full[:p, :p].copy(), full[:p, p].copy()
        else:
            if row is None:
                row = df.agg(*_sufficient_aggs(m.xs(), y)).first()
            g = np.zeros((p, p))
            b = np.zeros(p)
            for i in range(p):
                for j in range(i, p):
                    g[i, j] = g[j, i] = row[f"g{i}_{j}"] if (i, j) != (0, 0) else 0.0
                b[i] = row[f"b{i}"]
        g[0, 0] = float(n)
        w = np.zeros(p)
        history = {}
        lr = self.learning_rate
        with np.errstate(all="ignore"):
            for it in range(self.iterations):
                if it % TRACE_EVERY == 0:
                    history[it] = w.copy()
                w = w - lr * (g @ w - b) / n
        model = LinearModel(weights=w, diverged=not bool(np.all(np.isfinite(w))))
        model.losses = _loss_trace(df, m, y, history, logistic=False)
        return self._keep(model)


def _loss_trace(df: DataFrame, m: Matrix, y: Column, history: dict[int, np.ndarray], logistic: bool) -> dict[int, float]:
    """Mean per-row loss for each recorded weight vector, one aggregate job."""
    if not history:
        return {}
    xs = m.xs()
    aggs = []
    for it, w in history.items():
        z = affine(xs, w)
        term = log_loss(sigmoid(z), y) if logistic else (z - y) * (z - y)
        aggs.append(F.avg(term).alias(f"l{it}"))
    row = df.agg(*aggs).first()
    return {it: row[f"l{it}"] for it in history}


def _logistic_step(base: DataFrame, w: np.ndarray, traced: bool) -> tuple[np.ndarray, float]:
    """Gradient sum and (where traced) summed log-loss: the probability once
    per row, then d + 1 sums over it."""
    names = [f"_x{i}" for i in range(len(w) - 1)]
    scored = base.selectExpr(f"{S.sigmoid(S.affine(names, w))} AS _p", "_y", *names)
    aggs = ["sum(_p - _y) AS g0"] + [f"sum((_p - _y) * {x}) AS g{i + 1}" for i, x in enumerate(names)]
    if traced:
        aggs.append(f"sum({S.log_loss('_p', '_y')}) AS loss")
    row = scored.selectExpr(*aggs).first()
    return np.array([row[f"g{i}"] for i in range(len(w))], dtype=float), row["loss"] if traced else 0.0


class LogisticRegression(FittedState):
    """Targets must lie in [0, 1]; fractions are accepted.  Scores are not
    thresholded."""

    def __init__(self, learning_rate: float, iterations: int, one_job: bool = False):
        self.learning_rate = float(learning_rate)
        self.iterations = int(iterations)
        self.one_job = one_job  # see ``barrier``: where its exchange is cheaper than a job

    def fit(self, df: DataFrame, features: Sequence[str] | str, target: str, id_col: str = "id") -> LogisticModel:
        check_iterations(self.iterations)
        m = as_matrix(df, features, id_col)
        res = scan(m, target=target, logistic=True)
        m, n, d = res.matrix, res.n_rows, res.n_features
        y = F.col(target).cast("double").alias("_y")
        spark = df.sparkSession
        if self.one_job and barrier.fits(spark, n, 8 * (d + 1), 8 * (d + 2)):
            return self._keep(self._one_job(df.select(y, m.vector(d).alias("_v")), n, d))
        xs = [m.vector(d).alias("_v")] if d > WIDE else [x.alias(f"_x{i}") for i, x in enumerate(m.xs(d))]
        base = persist(df.select(*xs, y))
        w = np.zeros(d + 1)
        losses: dict[int, float] = {}
        lr = self.learning_rate
        try:
            with scoped_conf(df.sparkSession, ITERATION_CONF):
                for it in range(self.iterations):
                    traced = it % TRACE_EVERY == 0
                    grad, loss = logistic_sums(base, w) if d > WIDE else _logistic_step(base, w, traced)
                    if traced:
                        losses[it] = loss / n
                    with np.errstate(all="ignore"):
                        w = w - lr * grad / n
        finally:
            base.unpersist()
        return self._keep(LogisticModel(weights=w, losses=losses, diverged=not bool(np.all(np.isfinite(w)))))


    def _one_job(self, rows: DataFrame, n: int, d: int) -> LogisticModel:
        """All steps in one barrier stage."""
        lr, every = self.learning_rate, TRACE_EVERY

        def part(batches):
            held = [(b.column(0).to_numpy(zero_copy_only=False), vectors(b.column(1), d)) for b in batches if b.num_rows]
            y = np.concatenate([a for a, _ in held]) if held else np.zeros(0)
            x = np.concatenate([v for _, v in held]) if held else np.zeros((0, d))
            return lambda w, step: (logistic_part(y, x, w), np.zeros(0, np.int64))

        def update(w, total, _, step):
            with np.errstate(all="ignore"):
                return w - lr * total[: d + 1] / n, float(total[d + 1]) / n if step % every == 0 else None, False

        w, _, losses, _ = barrier.run(rows, barrier.tasks_for(rows.sparkSession, n, 8 * (d + 1)), np.zeros(d + 1), self.iterations, part, update)
        return LogisticModel(weights=w, losses=losses, diverged=not bool(np.all(np.isfinite(w))))
