"""Typed errors raised by the checks and estimators.

Row, column and index positions are 1-based.  For DataFrames "row i" means the
i-th row in ascending order of the id column.
"""

from __future__ import annotations

# Message templates that must read exactly as the library this
# project is compatible with prints them.
MESSAGES = {
    "EmptyDataset": "dataset cannot be empty",
    "EmptyRow": "row {row} cannot be empty",
    "EmptyTargets": "targets cannot be empty",
    "EmptyVector": "vector cannot be empty",
    "VectorLengthMismatch": "left vector has length {left} but right vector has length {right}",
    "NonFiniteVectorInput": "vector value at index {index} must be finite",
    "RaggedMatrix": "row {row} has {actual} columns but expected {expected}",
    "TargetLengthMismatch": "target length {targets} does not match sample count {samples}",
    "NonFiniteInput": "input at row {row}, column {column} must be finite",
    "NonFiniteTarget": "target at index {index} must be finite",
    "TargetOutOfRange": "target at index {index} must be within [0, 1]",
    "InvalidK": "k={k} is invalid for sample count {sample_count}",
    "InvalidClusterCount": "cluster count {clusters} is invalid for sample count {sample_count}",
    "InvalidPcaComponentCount": "component count {components} is invalid for feature count {feature_count}",
    "InsufficientSamples": "at least two samples are required; received {samples}",
    "ZeroVarianceFeature": "feature at column {column} has zero variance",
    "ConvergenceFailure": "{algorithm} failed to converge within {max_iterations} iterations",
    "InvalidTolerance": "{algorithm} tolerance must be finite and non-negative",
    "PredictionBeforeFit": "model must be fitted before predicting",
    "FeatureCountMismatch": "feature count {actual} does not match expected {expected}",
}

# Errors of this library's own.
MESSAGES |= {
    "UnscalableComponent": "component {component} cannot be scaled to a last entry of 1 "
    "(last entry {last:.3g}, repeated eigenvalue: {repeated}); use scaling='unit'",
    "InvalidIterations": "iteration count {iterations} must not be negative",
    "DuplicateId": "id {id} occurs more than once",
}


class TesseraError(Exception):
    """Base class; subclasses carry their fields as attributes."""

    fields: tuple[str, ...] = ()

    def __init__(self, *args, **kwargs):
        values = dict(zip(self.fields, args))
        values.update(kwargs)
        missing = [f for f in self.fields if f not in values]
        if missing:
            raise TypeError(f"{type(self).__name__} needs {missing}")
        for name, value in values.items():
            setattr(self, name, value)
        super().__init__(MESSAGES[type(self).__name__].format(**values))

    def __eq__(self, other):
        return type(self) is type(other) and all(
            getattr(self, f) == getattr(other, f) for f in self.fields
        )

    def __hash__(self):
        return hash((type(self).__name__,) + tuple(getattr(self, f) for f in self.fields))

    def __repr__(self):
        inner = ", ".join(f"{f}={getattr(self, f)!r}" for f in self.fields)
        return f"{type(self).__name__}({inner})"


def _error(name: str, *fields: str) -> type[TesseraError]:
    return type(name, (TesseraError,), {"fields": fields})


EmptyDataset = _error("EmptyDataset")
EmptyRow = _error("EmptyRow", "row")
EmptyTargets = _error("EmptyTargets")
EmptyVector = _error("EmptyVector")
VectorLengthMismatch = _error("VectorLengthMismatch", "left", "right")
NonFiniteVectorInput = _error("NonFiniteVectorInput", "index")
RaggedMatrix = _error("RaggedMatrix", "row", "expected", "actual")
TargetLengthMismatch = _error("TargetLengthMismatch", "samples", "targets")
NonFiniteInput = _error("NonFiniteInput", "row", "column")
NonFiniteTarget = _error("NonFiniteTarget", "index")
TargetOutOfRange = _error("TargetOutOfRange", "index")
InvalidK = _error("InvalidK", "k", "sample_count")
InvalidClusterCount = _error("InvalidClusterCount", "clusters", "sample_count")
InvalidPcaComponentCount = _error("InvalidPcaComponentCount", "components", "feature_count")
InsufficientSamples = _error("InsufficientSamples", "samples")
ZeroVarianceFeature = _error("ZeroVarianceFeature", "column")
ConvergenceFailure = _error("ConvergenceFailure", "algorithm", "max_iterations")
InvalidTolerance = _error("InvalidTolerance", "algorithm")
PredictionBeforeFit = _error("PredictionBeforeFit")
FeatureCountMismatch = _error("FeatureCountMismatch", "expected", "actual")
UnscalableComponent = _error("UnscalableComponent", "component", "last", "repeated")
InvalidIterations = _error("InvalidIterations", "iterations")
DuplicateId = _error("DuplicateId", "id")

__all__ = ["MESSAGES", "TesseraError"] + [name for name in MESSAGES]
