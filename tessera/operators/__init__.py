"""Learning and vector operators over DataFrames."""

from .checks import (
    check_feature_count,
    check_matrix,
    check_tolerance,
    check_variance,
    logistic_target_report,
    matrix_report,
    scan,
    target_report,
    variance_report,
)
from .distance import column_distance, distance_to_group_mean, group_means, pairwise_distance
from .kmeans import KMeans, KMeansModel, initial_ranks, ids_at_ranks
from .knn import KNeighborsRegressor, KNNModel
from .pca import PCA, PCAModel
from .regression import LinearModel, LinearRegression, LogisticModel, LogisticRegression
from .riding import RidingCheck, StreamCheck
from .scaling import (
    Standardiser,
    StandardiserModel,
    column_moments,
    covariance_matrix,
    covariance_of_standardised,
    standardise,
)

__all__ = [
    "KMeans", "KMeansModel", "KNeighborsRegressor", "KNNModel", "LinearModel", "LinearRegression",
    "LogisticModel", "LogisticRegression", "PCA", "PCAModel", "RidingCheck", "Standardiser", "StandardiserModel", "StreamCheck",
    "check_feature_count", "check_matrix", "check_tolerance", "check_variance", "column_distance",
    "column_moments", "covariance_matrix", "covariance_of_standardised", "distance_to_group_mean",
    "group_means", "ids_at_ranks", "initial_ranks", "logistic_target_report", "matrix_report",
    "pairwise_distance", "scan", "standardise", "target_report", "variance_report",
]
