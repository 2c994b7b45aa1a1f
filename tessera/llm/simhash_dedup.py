"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+`` words, shingles of
``SHINGLE`` words joined by a space (repeats count; a shorter text is one
shingle), XXH64 with seed 42 of each; a bit is 1 if over half the hashes have
it.  A text without words has fingerprint zero.

Links: fingerprints at most ``radius`` bits apart.  Every bit position i gets
a non-zero vector m(i) of radius + 1 bits, and table v (every non-zero vector)
keeps the bits with <m(i), v> odd.  Up to ``radius`` differing positions leave
some v orthogonal to all of theirs, so the pair agrees on all bits of that
table: each linked pair is certain to share a bucket.

A bucket holds distinct fingerprints only.  Within one, linked fingerprints
are found by a search that compares each reached fingerprint with those not
reached yet, and yields a star (one edge per member) instead of pairs.  A
bucket of more than ``bucket_rows`` is not compared but cut again by a second
family of tables over its own bits, which keeps the guarantee, and so on;
each level fixes half of the free bits, so this ends.

Edge cases: null and blank texts link to each other and to any fingerprint
within the radius of zero; rows of null id are members but name no component
(null if no member has an id); repeated rows are members each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, read, same_row, with_rows
from .components import connected

SHINGLE, RADIUS, SEED = 4, 4, 42
BUCKET_ROWS = 2048
#: Parts that the rows of one fingerprint are dealt over when they get their component.
SALTS = 8
#: After this many cuts at most a handful of bits are free.
MAX_LEVEL = 6


def _shingle_hashes(text: bytes, k: int) -> list[int]:
    words = text.lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        return [h(joined, SEED)]
    return [h(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])]  # noqa: B905 - the ends run out first


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    hashes = _shingle_hashes(text, k)
    if not hashes:
        return 0
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    out = 0
    for i in range(8):
        ones = np.bincount(octets[:, i], minlength=256) @ _BITS
        for b in np.flatnonzero(2 * ones > len(hashes)):
            out |= 1 << (8 * i + int(b))
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """k_id, k_text, fp (the fingerprint's 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or b"", k) for t in b.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], ["k_id", "k_text", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("k_id"), F.xxhash64("text").alias("k_text"), F.col("text").cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(run, "k_id long, k_text long, fp long")


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """The masks (bits kept) of the 2^(radius+1) - 1 tables."""
    rng = random.Random(1000 * radius + level)
    tables = range(1, 2 ** (radius + 1))
    vectors = [v for _ in range(64) for v in tables][:64]
    rng.shuffle(vectors)
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in tables]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest of its group, member) of the groups linked within fps."""
    left, roots, members = fps, [], []
    while len(left) > 1:
        reached, todo = [left[:1]], [left[0]]
        left = left[1:]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= radius
            if near.any():
                got = left[near]
                left = left[~near]
                reached.append(got)
                todo.extend(got)
        group = np.concatenate(reached)
        if len(group) > 1:
            root = group.view(np.int64).min()
            rest = group.view(np.int64)
            rest = rest[rest != root]
            roots.append(np.full(len(rest), root))
            members.append(rest)
    none = np.empty(0, np.int64)
    return (np.concatenate(roots), np.concatenate(members)) if roots else (none, none)


def _bucket_links(radius: int, bucket_rows: int):
    """Over rows (path, key, fp) sorted by path and key: rows (wide, path, a, b), an
    edge a-b, or with wide set a row a = fp of a bucket to be cut again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, key, fp = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        wide_key = None  # the open bucket, once it is known to be too large

        def out(wide, p, a, b):
            cols = [pa.array(np.full(len(a), wide)), pa.array(p), pa.array(a), pa.array(b)]
            return pa.RecordBatch.from_arrays(cols, ["wide", "path", "a", "b"])

        def closed(path, key, fp):
            cut = np.flatnonzero((np.diff(path) != 0) | (np.diff(key) != 0)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
            size = ends - starts
            two = starts[size == 2]
            x, y = fp[two], fp[two + 1]
            ok = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            yield out(False, path[two][ok], np.minimum(x, y)[ok], np.maximum(x, y)[ok])
            for s, e in zip(starts[size > 2], ends[size > 2], strict=True):
                if e - s > bucket_rows or (path[s], key[s]) == wide_key:
                    yield out(True, path[s:e], fp[s:e], fp[s:e])
                else:
                    a, b = _stars(fp[s:e].view(np.uint64), radius)
                    if len(a):
                        yield out(False, np.full(len(a), path[s]), a, b)

        for batch in batches:
            p, k, f = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if wide_key is not None and len(p):
                same = int(np.argmin(np.append((p == wide_key[0]) & (k == wide_key[1]), False)))
                if same:
                    yield out(True, p[:same], f[:same], f[:same])
                    p, k, f = p[same:], k[same:], f[same:]
                if len(p):
                    wide_key = None
            path, key, fp = np.concatenate([path, p]), np.concatenate([key, k]), np.concatenate([fp, f])
            if not len(path):
                continue
            last = int(np.flatnonzero((path != path[-1]) | (key != key[-1]))[-1]) + 1 if ((path != path[-1]) | (key != key[-1])).any() else 0
            if last:
                yield from closed(path[:last], key[:last], fp[:last])
            path, key, fp = path[last:], key[last:], fp[last:]
            if len(path) > bucket_rows:
                wide_key = (path[0], key[0])
                yield out(True, path, fp, fp)
                path, key, fp = path[:0], key[:0], fp[:0]
        if len(path):
            yield from closed(path, key, fp)

    return run


def links(nodes: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """From distinct fingerprints (``fp``) edges (``u``, ``v``) that connect
    exactly the fingerprints linked through steps of at most ``radius`` bits."""
    work = nodes.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("mask"), "fp")
    found = None
    for level in range(MAX_LEVEL + 1):
        masks = covering_masks(radius, level)
        deal = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(masks)])
        dealt = work.select("path", "mask", "fp", F.explode(deal).alias("x"))
        dealt = dealt.select((F.col("path") * len(masks) + F.col("x.t")).alias("path"), F.col("mask").bitwiseOR(F.col("x.m")).alias("mask"), "fp")
        keyed = dealt.select("path", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        limit = bucket_rows if level < MAX_LEVEL else 2**62
        spread = keyed.repartition("path", "key").sortWithinPartitions("path", "key")
        got = checkpointed(spread.mapInArrow(_bucket_links(radius, limit), "wide boolean, path long, a long, b long"))
        edges = got.where("NOT wide").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        found = edges if found is None else found.unionByName(edges)
        wide = got.where("wide")
        if wide.isEmpty():
            break
        # the bits that the tables on a bucket's path have fixed
        fixed = F.lit(0).cast("long")
        for up in range(level + 1):
            step = F.expr(f"CAST(path DIV {len(masks) ** (level - up)} % {len(masks)} AS INT)")
            of_level = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius, up)])
            fixed = fixed.bitwiseOR(F.get(of_level, step))
        work = wide.select("path", fixed.alias("mask"), F.col("a").alias("fp"))
    return found


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every row's ``k_id``, ``k_text``, ``fp``, ``component_id`` (smallest id
    reachable over links) and ``root`` (the component's smallest fingerprint,
    which tells components apart where ids are null or repeat)."""
    prints = checkpointed(fingerprints(docs, k))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("k_id").alias("first_id")))
    comp = connected(links(nodes.select("fp"), radius, bucket_rows))
    linked = comp.join(nodes, comp["node"] == nodes["fp"]).select("node", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = linked.join(least, "root").select("node", "root", "component_id")
    alone = F.col("node").isNull()
    every = nodes.join(named, nodes["fp"] == named["node"], "left").select(
        "fp", F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.col("fp")).otherwise(F.col("root")).alias("root")
    )
    every = every.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = prints.withColumn("salt", F.pmod(F.xxhash64("k_id", "k_text"), F.lit(SALTS)).cast("int"))
    return mine.join(every, ["fp", "salt"]).select("k_id", "k_text", "fp", "component_id", "root")


def representatives(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group (the one of smallest id), with all columns.
    A row of null id stays only if no member of its group has an id."""
    comp = near_duplicates(docs, k, radius)
    keep = comp.where("k_id <=> component_id").groupBy("root").agg(F.min(F.struct("k_id", "k_text")).alias("x")).select("x.k_id", "x.k_text")
    full = with_rows(docs)
    out = full.join(keep, same_row(full, keep), "left_semi").dropDuplicates(["k_id", "k_text"])
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def group_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    d = near_duplicates(read(spark, sf_dir, "documents"))
    return d.select(F.col("k_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
