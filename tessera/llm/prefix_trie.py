"""Prefix trie of conversations over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns.  Every prefix of a conversation
gets a 128-bit digest (sums of turn hashes tagged with their place, so a long
conversation is summed in segments and never gathered).  Blocks of whole
segments are the shards: a block lists its distinct digests, a minimal perfect
hash gives each a slot (every look-up compares the digest that the slot holds,
so a foreign digest is never taken for a node), counts are scattered into flat
arrays by slot, and added up through the array of parent slots, deepest nodes
first.  What a segment passes up to the segment before it is added at that
one's deepest node, so a block never needs rows outside it.  A node's parts
from all blocks are summed by digest.

Two such passes suffice at any depth: the first counts members and finds each
node's smallest member; the second sums leaves and savings over subtrees, each
node's own share being placed on the path of its smallest member.

Equal digests of different prefixes would be an error, not a wrong count: each
node's parts carry a second hash of last turn and parent, which must agree.

Edge cases: rows of null conv_id are not read; null role or text is empty; a
null turn comes first, turns of equal number go by the MD5 of role and text,
and repeated rows are turns each; a very long conversation is cut into
segments of ``SEGMENT`` turns, a very long text is only hashed and counted; a
conversation without turns is a member of the root; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checkpointed, n_words, placed, prefix_sums, read, run_starts

#: Turns of one conversation that stay together.
SEGMENT = 1024
#: Rows of a block, within a segment.
BLOCK_ROWS = 1 << 17
#: Fixed values of the rebuilding rule: conversations per family, largest number of borrowed turns.
FAMILY, BORROWED = 20, 3
#: Ids whose low bits differ only are joined to one text before the hash of a node's ends streams them.
END_BITS = 12
HALF = 2**32
NO_ID = np.iinfo(np.int64).max


# node tables ---------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class NodeTable:
    """Minimal perfect hash of distinct keys (rows of an n x 3 array of longs).

    Level by level, keys alone in their cell of a bit table twice as long as
    the keys left keep it; a key's slot is the rank of its bit."""

    LEVELS = 40

    def __init__(self, keys: np.ndarray):
        self.n, self.levels, self.rest = len(keys), [], {}
        slots, left, used = np.empty(self.n, np.int64), np.arange(self.n), 0
        while len(left) and len(self.levels) < self.LEVELS:
            cells = 2 * len(left)
            h = self._cell(keys[left], len(self.levels), cells)
            alone = np.bincount(h, minlength=cells)[h] == 1
            bits = np.zeros(cells, bool)
            bits[h[alone]] = True
            rank = np.cumsum(bits) - 1 + used
            slots[left[alone]] = rank[h[alone]]
            self.levels.append((cells, bits, rank))
            used += int(alone.sum())
            left = left[~alone]
        for i in left:
            self.rest[tuple(keys[i].tolist())] = slots[i] = used
            used += 1
        self.keys = np.empty_like(keys)
        self.keys[slots] = keys

    @staticmethod
    def _cell(keys: np.ndarray, level: int, cells: int) -> np.ndarray:
        k = keys.view(np.uint64)
        with np.errstate(over="ignore"):
            h = _mix(k[:, 1] + np.uint64(2 * level + 1) * np.uint64(0x9E3779B97F4A7C15))
            h = _mix(h ^ k[:, 2]) + k[:, 0]
            return (_mix(h) % np.uint64(cells)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not in the table."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (cells, bits, rank) in enumerate(self.levels):
            if not len(left):
                break
            h = self._cell(keys[left], level, cells)
            hit = bits[h]
            slot = rank[h[hit]]
            same = (self.keys[slot] == keys[left[hit]]).all(axis=1)
            out[left[hit][same]] = slot[same]
            left = left[~hit]
        if self.rest:
            for i in left:
                out[i] = self.rest.get(tuple(keys[i].tolist()), -1)
        return out


def accumulate(keys: np.ndarray, parents: np.ndarray, sums: list[np.ndarray], mins: list[np.ndarray], segment: int):
    """Totals over subtrees within a block: (distinct keys, row of each, sums,
    minima).  ``keys`` and ``parents`` are rows of (depth, digest, digest)."""
    order = np.lexsort(keys.T[::-1])
    first = order[run_starts(list(keys[order].T))]
    table = NodeTable(keys[first])
    slot = table.slots(keys)
    if (slot < 0).any():
        raise ValueError("a digest is missing from its own node table")
    row = np.empty(table.n, np.int64)
    row[slot[first]] = first
    parent = table.slots(parents[row])
    depth = table.keys[:, 0]
    parent[(depth - 1) % segment == 0] = -1
    add, low = [np.zeros(table.n, np.int64) for _ in sums], [np.full(table.n, NO_ID) for _ in mins]
    for a, v in zip(add, sums, strict=True):
        np.add.at(a, slot, v)
    for m, v in zip(low, mins, strict=True):
        np.minimum.at(m, slot, v)
    deepest = np.argsort(-depth, kind="stable")
    deepest = deepest[parent[deepest] >= 0]
    for level in np.split(deepest, np.flatnonzero(np.diff(depth[deepest])) + 1):
        for a in add:
            np.add.at(a, parent[level], a[level])
        for m in low:
            np.minimum.at(m, parent[level], m[level])
    return table.keys, row, add, low


def subtree_totals(paths: DataFrame, sums: list[str], mins: list[str], kept: list[str], segment: int, block_rows: int) -> DataFrame:
    """One row per node and block: ``d``, ``p1``, ``p2``, the ``kept`` columns,
    and ``sums`` and ``mins`` over the node's subtree within the block.
    ``paths`` has whole units (``c``, ``seg``) side by side, by depth."""
    names = ["d", "p1", "p2", *kept, *sums, *mins]

    def block(rows: pa.Table) -> pa.RecordBatch:
        col = {c: rows.column(c).to_numpy() for c in rows.column_names}
        keys = np.column_stack([col["d"], col["p1"], col["p2"]])
        parents = np.column_stack([col["d"] - 1, col["q1"], col["q2"]])
        nodes, row, add, low = accumulate(keys, parents, [col[c] for c in sums], [col[c] for c in mins], segment)
        out = [*nodes.T, *[col[c][row] for c in kept], *add, *low]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in out], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                take = b.num_rows
                if n + take > block_rows:
                    starts = run_starts([b.column("c").to_numpy(), b.column("seg").to_numpy()])
                    if held and all(held[-1].column(k)[-1] == b.column(k)[0] for k in ("c", "seg")):
                        starts = starts[1:]
                    cut = starts[n + starts >= block_rows]
                    take = int(cut[0]) if len(cut) else take
                    held.append(b.slice(0, take))
                    if len(cut):
                        yield block(pa.Table.from_batches(held))
                        held, n, b = [], 0, b.slice(take)
                        continue
                else:
                    held.append(b)
                n, b = n + take, b.slice(take)
        if n:
            yield block(pa.Table.from_batches(held))

    need = [*dict.fromkeys(["c", "seg", "d", "p1", "p2", "q1", "q2", *kept, *sums, *mins])]
    return paths.select(*need).mapInArrow(run, ", ".join(f"{c} long" for c in names))


# paths ---------------------------------------------------------------------

def turns(conv: DataFrame) -> DataFrame:
    """c, pos (from 0), key (hash of role and text), words, of every row with a conv_id."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key")
    rows = conv.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), key, n_words(text).alias("words"))
    return placed(rows, ["c"], ["turn", "key"]).drop("turn")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations of ``turns``: their turns (c, d, key, words,
    length) and the ids of all of them with their length.

    The first h = crc32(id) % 4 turns come from the first conversation of the
    family, as far as it has them."""
    convs = rows.groupBy("c").agg(F.count("*").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % (BORROWED + 1)).withColumn("lead", F.col("c") - F.col("c") % FAMILY)
    leads = convs.where("c = lead").select(F.col("c").alias("lead"), F.col("n").alias("n_lead"))
    given = F.least("h", F.coalesce("n_lead", F.lit(0)))
    convs = convs.join(leads, "lead", "left").withColumn("given", given).withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    heads = rows.where(f"c % {FAMILY} = 0 AND pos < {BORROWED}").select(F.col("c").alias("lead"), "pos", "key", "words")
    taken = convs.join(heads, "lead").where("pos < h").select("c", (F.col("pos") + 1).alias("d"), "key", "words", "length")
    own = rows.join(convs, "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("given") + 1).alias("d"), "key", "words", "length")
    return taken.unionByName(own), convs.select("c", "length")


def paths(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Every prefix of every conversation: c, seg, d, its digest p1, p2, the
    digest q1, q2 of the prefix before it, words of its last turn, length, and
    ``proof`` (another hash of last turn and parent).  Units (c, seg) lie side
    by side, by depth.  Checkpointed."""
    rows = turns.withColumn("seg", F.expr(f"(d - 1) DIV {segment}"))
    tags = [F.xxhash64("d", "key"), F.xxhash64("key", F.lit(7), "d")]
    names = []
    for i, t in enumerate(tags):
        rows = rows.withColumn(f"a{i}", F.pmod(t, F.lit(HALF))).withColumn(f"b{i}", F.shiftrightunsigned(t, 32))
        names += [f"a{i}", f"b{i}"]
    rolled = prefix_sums(rows, {f"s_{c}": c for c in names}, ["c"], "seg", ["d"])
    before, after = [F.col(f"s_{c}") for c in names], [F.col(f"s_{c}") + F.col(c) for c in names]
    out = rolled.select(
        "c", "seg", "d", F.xxhash64(after[0], after[1]).alias("p1"), F.xxhash64(after[2], after[3]).alias("p2"),
        F.xxhash64(before[0], before[1]).alias("q1"), F.xxhash64(before[2], before[3]).alias("q2"), "words", "length", "key",
    )
    out = out.withColumn("proof", F.xxhash64("key", "q1", "q2")).drop("key")
    return checkpointed(out.repartition("c", "seg").sortWithinPartitions("c", "seg", "d"))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """d, p1, p2 and the SHA-256 of the comma-joined ids ``c`` that end there,
    ascending.  Ids are first joined in ranges of 2^END_BITS, then streamed."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",")
    parts = ends.groupBy("d", "p1", "p2", F.shiftright("c", END_BITS).alias("part")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            done = []
            for d, p1, p2, ids in zip(*(b.column(c).to_pylist() for c in ("d", "p1", "p2", "ids")), strict=True):
                if key == (d, p1, p2):
                    sha.update(b",")
                else:
                    if key:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (d, p1, p2), hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["d", "p1", "p2", "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], ["d", "p1", "p2", "ends_sha256"])

    spread = parts.repartition("d", "p1", "p2").sortWithinPartitions("d", "p1", "p2", "part")
    return spread.select("d", "p1", "p2", "ids").mapInArrow(run, "d long, p1 long, p2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node of the conversations ``turns`` (c, d from 1, key,
    words, length) and ``convs`` (c, length): depth, p1, p2, conv_id,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    key = ["d", "p1", "p2"]
    path = paths(turns, segment)
    last = (F.col("d") == F.col("length")) | (F.col("d") % segment == 0)
    one = path.withColumn("n_convs", last.cast("long")).withColumn("conv", F.col("c"))
    parts = subtree_totals(one, ["n_convs"], ["conv"], ["q1", "q2", "words", "proof"], segment, block_rows)
    agree = F.when(F.min("proof") == F.max("proof"), F.max("words")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    nodes = parts.groupBy(*key).agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), agree.alias("words"))
    nodes = checkpointed(nodes)
    children = nodes.groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = checkpointed(nodes.join(children, key, "left").fillna(0, ["n_children"]))

    # each node's own share, on its smallest member's path; and at a segment's
    # deepest node all shares of that conversation's later segments
    own = nodes.select(F.col("conv").alias("c"), "d", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    units = path.where(F.col("length") > segment).select("c", "seg").distinct()
    shares = own.withColumn("seg", F.expr(f"(d - 1) DIV {segment}")).groupBy("c", "seg").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    later = W.partitionBy("c").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, -1)
    passed = units.join(shares, ["c", "seg"], "left").select("c", ((F.col("seg") + 1) * segment).alias("d"), F.sum("n_leaves").over(later).alias("n_leaves"), F.sum("saved").over(later).alias("saved"))
    values = own.unionByName(passed.where("n_leaves IS NOT NULL OR saved IS NOT NULL")).groupBy("c", "d").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    values = checkpointed(values)
    mine = path.join(values.select("c").distinct(), "c", "left_semi").join(values, ["c", "d"], "left").fillna(0, ["n_leaves", "saved"])
    mine = mine.repartition("c", "seg").sortWithinPartitions("c", "seg", "d")
    totals = subtree_totals(mine, ["n_leaves", "saved"], [], [], segment, block_rows).groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    nothing = F.xxhash64(F.lit(0).cast("long"), F.lit(0).cast("long"))
    at_root = [F.lit(0).cast("long").alias("d"), nothing.alias("p1"), nothing.alias("p2")]
    ends = path.where("d = length").select(*key, "c").unionByName(convs.where("length = 0").select(*at_root, "c"))
    whole = nodes.join(totals, key)
    no_id = F.lit(None).cast("long")
    cols = [*key, "q1", "q2", "conv", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    top = convs.select(F.col("c").alias("conv"), F.lit(1).cast("long").alias("n_convs"), *[F.lit(0).cast("long").alias(x) for x in ("n_children", "n_leaves", "saved_tokens")])
    first = whole.where("d = 1").select(no_id.alias("conv"), F.lit(0).cast("long").alias("n_convs"), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    root = top.unionByName(first).agg(F.min("conv").alias("conv"), *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).where("n_convs > 0")
    root = root.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1))).select(*at_root, no_id.alias("q1"), no_id.alias("q2"), *cols[5:])
    every_node = whole.select(*cols).unionByName(root)
    parents = nodes.select("d", "p1", "p2", "conv").unionByName(root.select(*key, "conv"))
    parents = parents.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    out = every_node.join(parents, ["d", "q1", "q2"], "left").join(ends_hashes(ends), key, "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("d").alias("depth"), "p1", "p2", F.col("conv").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    rows, convs = rebuilt(turns(read(spark, sf_dir, "conversations")))
    return trie(rows, checkpointed(convs)).drop("p1", "p2")
