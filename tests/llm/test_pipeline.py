"""The pipeline stage by stage against plain Python, and the queries' SQL."""

import brute as B
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from llm_data import SF

import __spark_entry__ as entry
from tessera.llm import quality, token_output
from tessera.llm.common import read


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), read(spark, SF, "documents"), [("documents", read(spark, SF, "documents"))]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    want = stages["documents"].columns
    assert all(stages[n].columns == want for n, _ in corpus_pipeline.STAGES[:-1])


def test_quality_stage_rejects_only_bad(spark, stages, table):
    before, after = rows(stages["documents"]), rows(stages["quality"])
    label = dict(table("labels", "doc_id, quality"))
    keep = {r.k_id for r in quality.score(stages["documents"], read(spark, SF, "labels")).collect() if r.keep}
    assert set(after) == keep and all(after[i] == before[i] for i in after)
    assert all(i in after for i in label if label[i] == 1)
    assert not any(i in after for i in label if label[i] == 0)


def test_near_duplicate_stage(stages):
    before, after = rows(stages["quality"]), rows(stages["near_duplicates"])
    want = {c for _, _, c in B.near_duplicates([(i, r.text) for i, r in before.items()])}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_decontamination_stage(stages, table):
    before, after = rows(stages["near_duplicates"]), rows(stages["decontamination"])
    items = [t for _, t in table("benchmark", "item_id, text")]
    bad = {i for i, r in before.items() if any(B.best_window(r.text, t) >= 0.8 for t in items)}
    assert bad and set(after) == set(before) - bad


def test_mixing_stage(stages):
    before, got = rows(stages["decontamination"]), {}
    for r in stages["mixing"].collect():
        got.setdefault(r.doc_id, []).append(r.text)
    want = B.taken([(i, r.source, len(B.words(r.text))) for i, r in before.items()])
    assert {i: sum(len(B.words(t)) for t in v) for i, v in got.items()} == {i: n for i, n in want.items() if n}
    for i, texts in got.items():
        whole = [t for t in texts if t == before[i].text]
        part = [t for t in texts if t != before[i].text]
        assert len(part) <= 1 and len(whole) >= len(texts) - 1
        assert all(B.words(before[i].text)[: len(B.words(t))] == B.words(t) for t in part)


def test_token_stage_holds_the_mix(stages):
    out = stages["tokens"].orderBy("seq").collect()
    stream = np.frombuffer(b"".join(bytes(r.tokens)[: 2 * r.n_tokens] for r in out), "<u2")
    with open(token_output.VOCABULARY, "rb") as f:
        coder = token_output.Pieces(f.read(), "<u2").encoder
    texts = [coder.decode(p[:-1].tolist()) for p in np.split(stream, np.flatnonzero(stream == 50256) + 1)[:-1]]
    assert sorted(texts) == sorted(r.text for r in stages["mixing"].collect())


def test_run_equals_the_stages(spark, stages):
    got = entry.queries()["pipeline"](spark, SF).select("slot", "seq", "crc32").collect()
    assert sorted(got) == sorted(stages["tokens"].select("slot", "seq", "crc32").collect())


@pytest.mark.parametrize("name", ["op7_mixing", "op8_chat", "op9_lines", "op11_trie", "op12_embedding_dedup"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    plain = lambda df: sorted(map(tuple, df[cols].astype(object).values.tolist()))
    assert plain(got) == plain(want)


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
