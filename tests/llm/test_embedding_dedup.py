"""Embedding near-duplicates against all pairs."""

import brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import embedding_dedup

VEC = "vec_id long, embedding array<double>, label int"
ODD = [
    (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0),
    (7, [0.0, 0.0], 0), (8, [1.0, None], 0), (9, [float("nan"), 1.0], 0), (10, [float("inf"), 1.0], 0), (None, [1.0, 0.02], 0),
    (None, [0.0, 1.0], 0), (None, [0.0, -1.0], 1), (11, [1e300, 1e298], 0), (12, [1e-310, 0.0], 0), (13, [1.0, 0.0, 0.0], 0),
    (14, [-1.0, 0.0], 0), (15, [3.0], 0), (16, [5.0], 0), (17, [-5.0], 0), (None, None, None), (20, [1.0, 0.4], 0), (21, [1.0, 0.75], 0),
]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None, r[2] or 0))


def groups_of(spark, rows, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, VEC)
    return ordered(embedding_dedup.near_duplicates(df, **kw).collect())


@pytest.mark.parametrize("cell_rows", [2, 8192])
def test_odd_rows(spark, cell_rows):
    assert groups_of(spark, ODD, cell_rows=cell_rows) == ordered(B.embedding_groups(ODD))


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, VEC)
    assert groups_of(spark, df.where("false")) == []
    assert groups_of(spark, df.where("label IS NULL")) == ordered(B.embedding_groups([r for r in ODD if r[2] is None]))
    names = ["v", "h1", "h2", "node", "n", "ok", "links", "first_id", "component_id", "together", "known"]
    assert groups_of(spark, df.select("*", *[F.lit("mine").alias(n) for n in names])) == groups_of(spark, ODD)


def planted(seed, n, d, spread):
    """Centres with near copies around them, pairs close to the limit, repeats."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        if rows and rng.random() < 0.5:
            _, v, label = rows[rng.integers(len(rows))]
            v = np.array(v) / np.linalg.norm(v)
            w = rng.standard_normal(d)
            w -= w @ v * v
            c = rng.choice([0.929, 0.9301, 0.95, 0.999, 1.0])
            v = c * v + np.sqrt(1 - c * c) * w / np.linalg.norm(w)
        else:
            v, label = rng.standard_normal(d) * spread, int(rng.integers(2))
        rows.append((i, [float(x) for x in np.float32(v * rng.choice([1.0, 1.0, 7.0]))], label))
    return rows + rows[: n // 20]


@pytest.mark.parametrize(("d", "kw"), [(64, {}), (64, {"cell_rows": 16}), (5, {"blocks": 3, "dims": 2}), (24, {"blocks": 8, "dims": 3}), (3, {"cell_rows": 5})])
def test_all_pairs(spark, d, kw):
    spread = np.concatenate([np.full(d // 2, 3.0), np.full(d - d // 2, 0.5)])
    rows = planted(d, 300, d, spread)
    want = B.embedding_groups(rows)
    assert sum(w[1] for w in want) > 100
    assert groups_of(spark, rows, **kw) == ordered(want)


def test_given_table(spark, table):
    rows = [(i, [float(x) for x in v], label) for i, v, label in table("embeddings", "vec_id, embedding, label")]
    got = ordered(embedding_dedup.dedup_embeddings(spark, "/root/testdata/sf0.001").collect())
    assert got == ordered(B.embedding_groups(rows))


def test_every_near_pair_meets_in_a_block():
    """Pairs within the budget share a cell in some block, each way round."""
    rng = np.random.default_rng(3)
    grid = embedding_dedup.Grid(0.93, 4, 2)
    u = rng.standard_normal((4000, 16))
    v = u + rng.standard_normal(u.shape) * 0.6 * rng.random((4000, 1))
    u, v = (x / np.linalg.norm(x, axis=1)[:, None] for x in (u, v))
    near = (u * v).sum(1) >= 0.93
    turn = embedding_dedup.frame(16, 8)
    places = [np.concatenate(x) for x in zip(grid.place(u @ turn), grid.place(v @ turn), strict=True)]
    i, j = np.arange(4000), np.arange(4000, 8000)
    for a, b in ((i, j), (j, i)):
        met = np.any([grid.meet(*places, a, b, block) for block in grid.shape(8)], axis=0)
        assert near.sum() > 500 and met[near].all()
    narrow = embedding_dedup.Grid(0.999, 4, 2)
    places = [np.concatenate(x) for x in zip(narrow.place(u @ turn), narrow.place(v @ turn), strict=True)]
    met = np.any([narrow.meet(*places, i, j, block) for block in narrow.shape(8)], axis=0)
    near = (u * v).sum(1) >= 0.999
    assert near.any() and met[near].all() and not met.all()
