"""Driver contract: entry smoke run and oracle agreement on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["check_matrix", "check_variance", "standardise", "distance_euclidean", "kmeans_predict",
        "pca_transform", "knn_distance", "linear_weights", "sigmoid"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(None if v != v else v for v in (r[c] for c in cols)) for r in pdf.to_dict("records"))


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, duck, name):
    got = _rows(entry.queries()[name](spark, SF).toPandas())
    want = _rows(duck.execute(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
