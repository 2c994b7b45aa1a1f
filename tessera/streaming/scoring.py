"""Scoring fitted models on Structured Streaming inputs.

Fitted standardisers, k-means, PCA, linear and logistic models score with
plain column expressions, so ``model.predict(stream_df, ..., validate=False)``
is itself a streaming DataFrame (stateless, append mode, no watermark needed).
Checks that need a whole-table aggregate cannot run on an unbounded input, so
streaming inputs are always scored unvalidated.

Models whose scoring needs a shuffle (nearest neighbours) score each
micro-batch with ``foreachBatch``; every batch is written to its own
``batch_id=<n>`` folder with overwrite, so a batch replayed after a failure
replaces its earlier output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """A file stream over a Parquet folder (schema given, never inferred)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(stream: DataFrame, model, features, id_col: str = "id", **kw) -> DataFrame:
    """Stateless scoring as a streaming projection: ``predict`` for k-means,
    linear and logistic models, ``transform`` for standardiser and PCA
    models (all built from column expressions with literal parameters)."""
    if hasattr(model, "predict"):
        return model.predict(stream, features, id_col, validate=False, **kw)
    return model.transform(stream, features, id_col, validate=False, **kw)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A per-query folder under the session's checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def write_batches(
    stream: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    sink_path: str,
    name: str,
    checkpoint: str | None = None,
    trigger_once: bool = False,
) -> StreamingQuery:
    """Run ``scorer`` on every micro-batch and write the result idempotently."""
    spark = stream.sparkSession
    ckpt = checkpoint or checkpoint_location(spark, name)

    def run(batch: DataFrame, batch_id: int) -> None:
        scorer(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(run)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def write_scores(scored: DataFrame, sink_path: str, name: str, checkpoint: str | None = None,
                 trigger_once: bool = False) -> StreamingQuery:
    """Append a stateless scored stream to Parquet (exactly-once file sink)."""
    spark = scored.sparkSession
    ckpt = checkpoint or checkpoint_location(spark, name)
    w = scored.writeStream.queryName(name).format("parquet").outputMode("append").option(
        "checkpointLocation", ckpt
    ).option("path", sink_path)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
