"""First eigenpairs of a symmetric matrix known only by its products.

A random block of ``k + EXTRA`` columns grows to a subspace: each step asks
for the matrix's product with one block (one job where the matrix is a
covariance of distributed rows), solves the small problem within the subspace,
and goes on with the residuals of the first vectors.  A subspace that has grown to ``MAX_BLOCKS``
blocks is cut back to its best two.  Memory: twice d x (MAX_BLOCKS x block).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .. import errors as E

EXTRA = 8
MAX_BLOCKS = 8
MAX_STEPS = 200
#: Length of a residual, beside the first eigenvalue, at which a vector is taken as found.
RESIDUAL = 1e-11
SEED = 20_011


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns that span what ``block`` adds to ``basis``."""
    for _ in range(2):  # twice, against rounding
        block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-12 * max(s[0], 1e-300)] if len(s) else u
    return block


def leading(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, residual: float = RESIDUAL, max_steps: int = MAX_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending, up to ``k + 1`` of them) and as many rows of
    unit eigenvectors; the first ``k`` are within ``residual``."""
    width = min(d, k + EXTRA)
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, width)))[0]
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(max_steps):
        block = block[:, : d - basis.shape[1]]
        basis, image = np.hstack([basis, block]), np.hstack([image, product(block)])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2.0)
        order = np.argsort(-values, kind="stable")
        values, turn = values[order], turn[:, order]
        found, moved = basis @ turn[:, :width], image @ turn[:, :width]
        rest = moved - found * values[:width]
        lengths = np.linalg.norm(rest, axis=0)
        if basis.shape[1] == d or lengths[:k].max() <= residual * max(abs(values[0]), 1e-300):
            return values[: k + 1], found.T[: k + 1]
        if basis.shape[1] + width > MAX_BLOCKS * width:
            basis, image = basis @ turn[:, : 2 * width], image @ turn[:, : 2 * width]
        # scaled, so that nearly found vectors do not vanish beside the others
        block = _orthonormal(rest[:, lengths > 0] / lengths[lengths > 0], basis)
        if not block.shape[1]:
            return values[: k + 1], found.T[: k + 1]
    raise E.ConvergenceFailure(algorithm="PCA", max_iterations=max_steps)
