import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import DOCS, ODD_ROWS, SF  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with extra columns named as the operators' own."""
    from pyspark.sql import functions as F

    names = ["row", "k_id", "k_text", "fp", "size", "taken", "shard", "slot", "key", "h", "w", "x", "target", "keep", "bucket", "pos"]
    return odd.select("*", *[F.lit("mine").alias(n) for n in names])


@pytest.fixture(scope="session")
def table():
    con = duckdb.connect()

    def rows(name, columns, sf=SF):
        return con.execute(f"SELECT {columns} FROM read_parquet('{sf}/{name}.parquet')").fetchall()

    return rows
