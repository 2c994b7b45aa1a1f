"""Scoring fitted models on streaming DataFrames."""

from .scoring import checkpoint_location, parquet_stream, score_stream, write_batches, write_scores

__all__ = ["checkpoint_location", "parquet_stream", "score_stream", "write_batches", "write_scores"]
