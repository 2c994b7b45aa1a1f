"""The corpus pipeline: documents in, token shards out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the
runner writes as Parquet to the shared folder and reads again as the next
stage's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, mixing, quality, simhash_dedup, token_output
from tessera.llm.common import read
from tessera.session import ensure_checkpoint_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.training_order(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: The stages' fitted model, fingerprints and vocabulary have no SQL form;
#: tests hold the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
