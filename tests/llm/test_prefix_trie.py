"""The conversation trie against a plain trie."""

import random

import brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, prefix_trie

CONV = "conv_id long, turn long, role string, text string"
NODE = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ODD = [
    (0, 0, "user", "hello there friend"), (0, 1, "assistant", "hi"), (0, None, "system", "be kind"),
    (1, 0, "user", "hello there friend"), (1, 0, "user", "hello there friend"), (1, 0, None, None),
    (2, None, None, ""), (2, None, "", None), (2, 5, "user", "  \t\n "), (3, 1, "user", "long " * 30_000),
    (None, 0, "user", "nobody"), (None, None, None, None), (7, 0, "user", "x"), (25, 0, "user", "no leader at all"),
    (40, 0, "user", "q"), (41, 0, "user", "q"), (42, 0, "user", "q"), (44, 0, "user", "q"), (47, 1, "é", "ß 中文"),
]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r))


def trie_of(spark, rows, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, CONV)
    t, c = prefix_trie.rebuilt(prefix_trie.turns(df))
    return ordered(tuple(r) for r in prefix_trie.trie(t, c, **kw).select(*NODE).collect())


def test_given_table(spark, table):
    rows = table("conversations", "conv_id, turn, role, text")
    assert trie_of(spark, rows) == ordered(B.trie(B.rebuilt_conversations(rows)))


@pytest.mark.parametrize("kw", [{}, {"segment": 1}, {"segment": 3, "block_rows": 1}])
def test_odd_rows(spark, kw):
    got = trie_of(spark, ODD, **kw)
    assert got == ordered(B.trie(B.rebuilt_conversations(ODD)))
    assert [r for r in got if r[0] == 0][0][3] == len({r[0] for r in ODD if r[0] is not None})


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, CONV)
    assert trie_of(spark, df.where("false")) == []
    names = ["c", "pos", "d", "seg", "key", "words", "p1", "q1", "h", "n", "given", "length", "proof", "__part"]
    assert trie_of(spark, df.select("*", *[F.lit("mine").alias(n) for n in names])) == trie_of(spark, ODD)


def test_shared_openings_long_conversations_and_copies(spark):
    """Many conversations that share openings, copies of one, and long ones
    over several segments."""
    rng, rows = random.Random(4), []
    for c in range(120):
        n = rng.choice([1, 2, 4, 9, 30]) if c % 3 else 12
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"w{rng.randrange(2) if c % 3 else 0} " * (t % 4)) for t in range(n)]
    for kw in ({"segment": 4, "block_rows": 50}, {"segment": 7, "block_rows": 1 << 17}):
        assert trie_of(spark, rows, **kw) == ordered(B.trie(B.rebuilt_conversations(rows)))


def test_a_group_over_many_partitions_keeps_its_places(spark):
    """One group holds most rows, half of them equal."""
    rows = [(5, i if i % 2 else 0) for i in range(4000)] + [(c, 1) for c in range(5)] + [(9, 2), (9, 1)]
    df = spark.createDataFrame(rows, "g long, x long").repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = common.placed(df, ["g"], ["x"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for g in {r[0] for r in rows}:
        mine = sorted((r.pos, r.x) for r in got if r.g == g)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert [x for _, x in mine] == sorted(x for h, x in rows if h == g)


def test_node_table_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.column_stack([rng.integers(1, 9, n), rng.integers(-(2**63), 2**63 - 1, n), rng.integers(0, 3, n)])
        keys = np.unique(keys, axis=0)
        table = prefix_trie.NodeTable(keys)
        assert sorted(table.slots(keys)) == list(range(len(keys)))
        assert (table.slots(keys + np.array([0, 1, 0])) == -1).all() or n > 1000
        foreign = keys + np.array([100, 0, 0])
        assert (table.slots(foreign) == -1).all()


def test_keys_that_no_level_tells_apart_still_get_slots(monkeypatch):
    monkeypatch.setattr(prefix_trie.NodeTable, "_cell", staticmethod(lambda keys, level, cells: np.zeros(len(keys), np.int64)))
    keys = np.array([[1, 2, 3], [1, 2, 4], [2, 0, 0]])
    table = prefix_trie.NodeTable(keys)
    assert sorted(table.slots(keys)) == [0, 1, 2] and table.slots(keys + 9).tolist() == [-1, -1, -1]
