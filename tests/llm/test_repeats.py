"""Hot records, null ids and offsets: what must hold when rows repeat."""

import brute as B
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, neighbours, quality, sharding, toxicity
from tessera.llm.oracle import MIXING

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HOT = [(7, "the same record again", "en", "a", 21)] * 1500 + [(None, "no id", "en", "a", 5)] * 700 + [(None, f"no id {i}", "en", "b", 9) for i in range(300)]
HOT += [(i, f"document number {i} " * (i % 7 + 1), "en", "abc"[i % 3], 20) for i in range(100, 2100)]


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    spark.createDataFrame(HOT, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_shards_stay_level_when_a_third_is_one_record(spark, hot_dir):
    got = sharding.shard_documents(spark, hot_dir).collect()
    load = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert len(got) == len(HOT) and max(load) - min(load) <= max(r.size for r in got)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert max(np.bincount([r.virtual_slot for r in got])) < 20  # no slot holds the copies


def test_mix_of_repeated_and_null_ids(spark, hot_dir):
    got = mixing.mix_documents(spark, hot_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{hot_dir}/documents.parquet/*.parquet')")
    cols = ["doc_id", "source", "size", "source_size", "target", "taken"]
    plain = lambda df: sorted(map(str, df[cols].astype(object).values.tolist()))
    assert plain(got.toPandas().astype({"doc_id": "Int64"})) == plain(con.execute(MIXING).df().astype({"doc_id": "Int64"}))
    keys = mixing.random_keys(mixing.sized(spark.read.parquet(f"{hot_dir}/documents.parquet")), 7)
    assert keys.select("key").distinct().count() == len(HOT)
    ranges = keys.groupBy(F.substring("key", 1, mixing.RANGE_DIGITS)).count().agg(F.max("count")).first()[0]
    assert ranges < 12


def test_a_run_of_few_documents_is_not_held(monkeypatch):
    """One document with very many equal lines: rows leave as they come."""
    monkeypatch.setattr(line_dedup, "HELD_ROWS", 50)
    run = line_dedup._stream_runs(10, False)
    names = ["part", "h1", "h2", "k_id", "k_text", "pos"]

    def batches():
        for i in range(40):
            cols = [np.zeros(100, np.int32), np.full(100, 5), np.full(100, 6), np.full(100, 1), np.full(100, 2), np.arange(100, dtype=np.int32) + 100 * i]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    out = list(run(batches()))
    assert max(b.num_rows for b in out) <= 150 and sum(b.num_rows for b in out if b.column("kind")[0].as_py() == line_dedup.ASIDE) == 4000
    assert [b.column("n_docs")[0].as_py() for b in out if b.column("kind")[0].as_py() == line_dedup.EDGE] == [1]


@pytest.mark.parametrize("held", [1, 3, 4096])
def test_lines_with_long_runs(spark, monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD_ROWS", held)
    rows = [(i, "shared\n" * (i % 5 + 1) + "rare\n" * 40 * (i < 4) + f"own {i}") for i in range(14)] + [(99, "alone\n" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.kept_text(docs, line_dedup.drop_bitmaps(docs)).select("k_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    assert sorted(tuple(r) for r in out) == sorted(B.lines(rows))


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8, 1e12])
@pytest.mark.parametrize("n", [300, 2000])
def test_neighbours_with_a_common_offset(spark, offset, n):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((n, 64)) + offset
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = B.nearest(rows)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert recall >= (0.9 if n > 500 else 1.0)
    for q, found in got.items():
        assert all(s == pytest.approx(float(np.sqrt(((x[i] - x[q]) ** 2).sum())), rel=1e-12) for i, s in found)


def test_fits_agree_when_labelled_ids_repeat(spark, table):
    docs = table("documents", "doc_id, text, lang, source, n_chars") + [(3, f"other text {i}", "en", "a", 9) for i in range(30)]
    labels = spark.createDataFrame(table("labels", "doc_id, quality, toxic"), "doc_id long, quality int, toxic int")
    tables = [spark.createDataFrame(d, DOCS).repartition(p) for d, p in ((docs, 2), (docs[::-1], 7))]
    a, b = (sorted(map(str, quality.score(t, labels).select("k_id", "k_text", F.round("evidence", 6), "keep").collect())) for t in tables)
    assert a == b
    a, b = (toxicity.fit(t, labels) for t in tables)
    assert a.words == b.words and np.allclose(a.weights, b.weights)
