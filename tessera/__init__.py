"""tessera: learning and vector analytics on Spark DataFrames.

Operators take a DataFrame with a unique id column and features given either
as a list of numeric columns or as one array column.  Heavy work runs as
Spark jobs over the whole table; only model-sized results reach the driver.
"""

import sys

from pyspark import cloudpickle

from . import errors
from .frames import Matrix, as_matrix
from .operators import (
    PCA,
    KMeans,
    KNeighborsRegressor,
    LinearRegression,
    LogisticRegression,
    Standardiser,
    column_moments,
    covariance_matrix,
    pairwise_distance,
    standardise,
)

__all__ = [
    "errors", "Matrix", "as_matrix", "PCA", "KMeans", "KNeighborsRegressor", "LinearRegression",
    "LogisticRegression", "Standardiser", "column_moments", "covariance_matrix", "pairwise_distance",
    "standardise",
]

# Executors need no copy of the package: functions that run there are shipped whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
