"""Places, offsets, checksums and shard files of token output against a plain version."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import token_output

END = 50256
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def coder():
    with open(token_output.VOCABULARY, "rb") as f:
        return token_output.Pieces(f.read(), "<u2").encoder


def plain(spark, rows, coder, length, shard_slots):
    """All sequences, by a sort of the records and one long stream."""
    df = spark.createDataFrame(rows, DOCS).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(2), "text", "doc_id").alias("b"))
    order = sorted([r for r in df.collect() if r.text], key=lambda r: (r.a & (2**64 - 1), r.b))
    stream, owner = [], []
    for r in order:
        ids = [*coder.encode_ordinary(r.text), END]
        stream += ids
        owner += [(r.doc_id, i == 0) for i in range(len(ids))]
    n_seq = -(-len(stream) // length)
    slots = token_output.permute(np.arange(n_seq, dtype=np.uint64), n_seq, token_output.KEY) if n_seq else []
    out = []
    for seq, slot in enumerate(slots):
        part, own = stream[seq * length :][:length], owner[seq * length :][:length]
        starts = [i for i, (_, begins) in enumerate(own) if begins or i == 0]
        body = np.array(part + [END] * (length - len(part)), "<u2").tobytes()
        place = slot % shard_slots
        out.append((slot, slot // shard_slots, place, place * length * 2, seq, len(part), [own[i][0] for i in starts], starts, body, zlib.crc32(body)))
    return sorted(out)


def found(spark, rows, length, shard_slots):
    df = spark.createDataFrame(rows, DOCS)
    got = token_output.training_order(df, length=length, shard_slots=shard_slots).collect()
    return sorted((*r[:8], bytes(r.tokens), r.crc32) for r in got)


ROWS = [(i, f"text {i} " + "word " * (i % 23)) for i in range(90)] + [(None, "no id"), (None, "no id"), (None, None), (3, ""), (4, None), (500, "x " * 900), (501, " \n ")]


@pytest.mark.parametrize(("ranges", "shard_slots"), [(1, 7), (8, 3), (64, 1000)])
def test_places_offsets_and_checksums(spark, coder, monkeypatch, ranges, shard_slots):
    monkeypatch.setattr(token_output, "hash_ranges", lambda df: ranges)
    assert found(spark, ROWS, 32, shard_slots) == plain(spark, ROWS, coder, 32, shard_slots)


@pytest.mark.parametrize("copies", [4, 64])
def test_a_third_of_rows_one_record(spark, coder, monkeypatch, copies):
    """The record comes to the hash range as few rows, is cut by many tasks, and is written in full."""
    monkeypatch.setattr(token_output, "COPIES", copies)
    rows = ROWS[:60] + [(7777, "again and again " * 5)] * 300
    assert found(spark, rows, 32, 8) == plain(spark, rows, coder, 32, 8)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    counted = token_output.token_rows(df)
    assert counted.where("k_id = 7777").count() <= 6 and counted.agg(F.sum("copies")).first()[0] == len(rows)


def test_shards_from_the_sorted_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "MAX_SLOT_RANGES", 3)  # several shards a partition
    out = token_output.training_order(spark.createDataFrame(ROWS, DOCS), length=16, shard_slots=10)
    uri = f"file://{tmp_path}/shards"
    written = token_output.write_shards(out, uri)
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == out._jdf.queryExecution().executedPlan().toString().count("Exchange")
    files = sorted(written.collect())
    rows = sorted(out.collect(), key=lambda r: r.slot)
    assert [f.shard for f in files] == list(range(-(-len(rows) // 10))) and sum(f.n_slots for f in files) == len(rows)
    for f in files:
        body = (tmp_path / "shards" / f"shard-{f.shard:08d}.bin").read_bytes()
        assert body == b"".join(bytes(r.tokens) for r in rows[f.first_slot : f.first_slot + f.n_slots])
        assert (len(body), zlib.crc32(body)) == (f.n_bytes, f.crc32)
    with pytest.raises(Exception, match="out of place"):
        token_output.write_shards(out.orderBy(F.desc("slot")), uri).collect()


def test_ranges_follow_the_input(spark, tmp_path):
    spark.range(5000).selectExpr("id AS doc_id", "repeat(sha2(string(id), 512), 100) AS text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    n = token_output.hash_ranges(df)
    assert n & (n - 1) == 0 and n <= 8
    assert token_output.hash_ranges(df.union(df)) >= n
    assert token_output.hash_ranges(spark.createDataFrame(ROWS, DOCS)) == 8  # no estimate: the shuffle width


def test_clashing_columns(spark, clashing, odd):
    extra = clashing.select("*", *[F.lit("mine").alias(n) for n in ("h1", "h2", "n", "copies", "tokens", "part", "before", "up", "piece")])
    strip = lambda rows: sorted(bytes(r.tokens) for r in rows)
    assert strip(token_output.training_order(extra, length=16).collect()) == strip(token_output.training_order(odd, length=16).collect())
