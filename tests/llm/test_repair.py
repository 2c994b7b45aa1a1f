"""Conversation repair against a search over whole edit lists."""

import itertools
import random

import brute as B
import pytest
from pyspark.sql import functions as F

from tessera.llm import repair

CONV = "conv_id long, turn long, role string, text string"
ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi there"), (1, 3, "user", "Bye."), (1, 9, "assistant", "Bye."),
    (2, 0, "user", "Hello?"), (2, 0, "user", "Hello?"), (2, 1, None, None), (2, None, "user", "x."), (2, None, None, "y!"),
    (None, 0, "user", "Nobody."), (None, None, "assistant", "Null."), (None, None, None, None), (3, 0, "", ""), (3, 1, "tool", " \t\r\n"),
    (4, 5, "assistant", "long. " * 30_000), (5, -3, "user", "a."), (5, 4, "Assistant", "é ß 中文 ?\n"), (6, None, "user", "only."), (7, 0, "user", "Truncated"),
]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))


def repaired(spark, rows, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, CONV)
    return ordered(repair.repair(df, **kw).collect())


def test_given_table(spark, table):
    rows = table("conversations", "conv_id, turn, role, text")
    got = repaired(spark, rows)
    assert got == ordered(B.repairs(rows)) and {r[0] for r in got} == {r[0] for r in rows}
    assert any(r[6] for r in got)


@pytest.mark.parametrize("segment", [1, 2, 1024])
def test_odd_rows(spark, segment):
    """Ids move through all kinds of damage."""
    rows = [(None if c is None else c + 100 * k, t, r, x) for k in range(30) for c, t, r, x in ODD if c is not None or k == 0]
    assert repaired(spark, rows, segment=segment) == ordered(B.repairs(rows))


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, CONV)
    assert repaired(spark, df.where("false")) == []
    names = ["void", "c", "key", "mark", "marks", "seg", "kind", "copy", "pos", "first", "audit", "goal", "states"]
    assert repaired(spark, df.select("*", *[F.lit("mine").alias(n) for n in names])) == repaired(spark, ODD)


def test_every_short_signature():
    """All signatures of up to three rows, against all edits tried."""
    faults = {"X": "blank", **{x: "truncated" for x in "SUAO"}, **{x: "" for x in "suao"}}
    for n in range(4):
        for s in itertools.product(faults, repeat=n):
            cost, audit, _ = B.cheapest_edits([x.lower() for x in s], [faults[x] for x in s])
            solved = repair.Suffixes(*repair.END).solve("".join(reversed(s)))
            assert (solved[0][0], solved[1][0]) == (cost, audit), s


def test_suffixes_are_built_once():
    signatures = sorted("".join(x)[::-1] for x in itertools.product("uaX", repeat=6))
    suffixes = repair.Suffixes(*repair.END)
    for s in signatures:
        suffixes.solve(s)
    assert suffixes.made == len({s[: i + 1] for s in signatures for i in range(6)})


@pytest.mark.parametrize("segment", [3, 64])
def test_long_conversations_over_segments(spark, segment):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b?", "cut", " ", f"n{t}!"])) for c in range(12) for t in range(rng.choice([5, 40, 90]))]
    assert repaired(spark, rows, segment=segment) == repaired(spark, rows)
    short = [r for r in rows if r[1] < 14]
    assert repaired(spark, short, segment=segment) == ordered(B.repairs(short))


def test_without_damage(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello!"), (2, 0, "assistant", "Hello!")]
    got = repaired(spark, rows, damage=False)
    assert [(r[0], r[6], r[7]) for r in got] == [(1, 0, "KK"), (2, 2, "D")]
