"""Column functions: distances, sigmoid, log-loss, arg-min, finiteness."""

from .vector import (
    argmin,
    array_distance,
    affine,
    distance,
    dot,
    euclidean,
    log_loss,
    manhattan,
    nonfinite,
    rounded,
    sigmoid,
    squared_distance,
)

__all__ = [
    "argmin",
    "array_distance",
    "affine",
    "distance",
    "dot",
    "euclidean",
    "log_loss",
    "manhattan",
    "nonfinite",
    "rounded",
    "sigmoid",
    "squared_distance",
]
