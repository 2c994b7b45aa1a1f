"""Principal component analysis of standardised data.

fit: one pass (checks, moments and covariances; beyond the pass's width limit
a second one), then ``numpy.linalg.eigh`` on the d x d covariance on the
driver.  Beyond ``gram.MAX_FEATURES`` features no d x d matrix is made: the
first components come from a randomised subspace (``subspace``), whose steps
are distributed products of the rows with a d x (n_components + a few) block.
transform: one narrow projection of the standardised rows onto the first
components, no shuffle.

Components come in descending eigenvalue order.  With ``scaling="last_one"``
(the default) each eigenvector is scaled so its last entry is 1, which also
fixes the sign; ``scaling="unit"`` keeps unit length with the last entry
made non-negative.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import errors as E
from ..frames import as_matrix
from ..functions.vector import dot
from ..session import persist
from .checks import check_feature_count, check_tolerance
from .estimator import FittedState
from .gram import MAX_FEATURES, WIDE
from .scaling import StandardiserModel, model_from_scan, scan_with_covariance, standardised_covariance
from .subspace import leading
from .wide import product_sums, scaled_column

SOLVERS = ("auto", "direct", "subspace")
SCALINGS = ("last_one", "unit")
# An eigenvector whose last entry is smaller than this cannot be scaled to 1.
LAST_ENTRY_FLOOR = 1e-6


@dataclass(frozen=True)
class PCAModel:
    scaler: StandardiserModel
    components: np.ndarray  # k x d
    eigenvalues: np.ndarray  # k

    @property
    def n_components(self) -> int:
        return self.components.shape[0]

    def transform(self, df: DataFrame, features: Sequence[str] | str, id_col: str = "id",
                  prefix: str = "pc", keep: Sequence[str] = (), validate: bool = True) -> DataFrame:
        d = self.scaler.n_features
        m = check_feature_count(d, as_matrix(df, features, id_col), validate)
        if d > WIDE:
            z = scaled_column(m.vector(d), self.scaler.mean, self.scaler.sd, self.components)
            wide = df.select(F.col(id_col), *[F.col(c) for c in keep], z.alias("_z"))
            pcs = [F.col("_z")[k].alias(f"{prefix}{k + 1}") for k in range(self.n_components)]
            return wide.select(F.col(id_col), *[F.col(c) for c in keep], *pcs)
        zs = self.scaler.exprs(m.xs(d))
        pcs = [dot(zs, self.components[k]).alias(f"{prefix}{k + 1}") for k in range(self.n_components)]
        return df.select(F.col(id_col), *[F.col(c) for c in keep], *pcs)

    def components_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for k in range(self.n_components):
            for j in range(self.components.shape[1]):
                rows.append((k + 1, j + 1, float(self.eigenvalues[k]), float(self.components[k, j])))
        return spark.createDataFrame(
            rows, "component int, feature_position int, eigenvalue double, loading double"
        )


class PCA(FittedState):
    def __init__(self, n_components: int, tolerance: float = 1e-8, scaling: str = "last_one", solver: str = "auto"):
        if scaling not in SCALINGS:
            raise ValueError(f"scaling must be one of {SCALINGS}")
        if solver not in SOLVERS:
            raise ValueError(f"solver must be one of {SOLVERS}")
        self.solver = solver
        self.n_components = int(n_components)
        self.tolerance = float(tolerance)
        self.scaling = scaling

    def fit(self, df: DataFrame, features: Sequence[str] | str, id_col: str = "id") -> PCAModel:
        res = scan_with_covariance(as_matrix(df, features, id_col))
        scaler = model_from_scan(res)  # InsufficientSamples / ZeroVarianceFeature
        d = res.n_features
        if self.n_components < 1 or self.n_components > d:
            raise E.InvalidPcaComponentCount(components=self.n_components, feature_count=d)
        check_tolerance(self.tolerance, "PCA/QR")
        k = self.n_components
        if self.solver == "subspace" or (self.solver == "auto" and d > MAX_FEATURES):
            values, vectors = self._subspace(res, scaler)
        else:
            values, vectors = np.linalg.eigh(standardised_covariance(res, scaler))
            order = np.argsort(-values, kind="stable")
            values, vectors = values[order], vectors[:, order].T
        comps = np.array(vectors[:k], dtype=float)
        for i in range(k):
            last = comps[i, -1]
            if self.scaling == "last_one":
                repeated = any(
                    j != i and abs(values[j] - values[i]) <= 1e-12 * max(1.0, abs(values[i])) for j in range(len(values))
                )
                if abs(last) < LAST_ENTRY_FLOOR or repeated:
                    raise E.UnscalableComponent(component=i + 1, last=float(last), repeated=repeated)
                comps[i] = comps[i] / last
            elif last < 0:
                comps[i] = -comps[i]
        return self._keep(PCAModel(scaler=scaler, components=comps, eigenvalues=values[:k]))

    def _subspace(self, res, scaler: StandardiserModel) -> tuple[np.ndarray, np.ndarray]:
        """The first eigenvalues (one more than asked, to tell repeated ones)
        and eigenvectors of the covariance, by products with the kept rows."""
        d, n = res.n_features, res.n_rows
        base = persist(res.matrix.df.select(res.matrix.vector(d).alias("_v")))
        try:
            return leading(lambda block: product_sums(base, scaler.mean, scaler.sd, block) / n, d, self.n_components)
        finally:
            base.unpersist()

    def transform(self, *args, **kwargs):
        if self.model is None:
            raise E.PredictionBeforeFit()
        return self.model.transform(*args, **kwargs)

    def fit_transform(self, df: DataFrame, features: Sequence[str] | str, id_col: str = "id", **kw) -> DataFrame:
        return self.fit(df, features, id_col).transform(df, features, id_col, validate=False, **kw)
