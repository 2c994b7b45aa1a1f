"""Sharding by fixed virtual slots.

Every record hashes into one of ``n_slots`` slots (thousands, fixed for the
life of a data set); the bytes of each slot are aggregated; and a versioned
map names the shard of each slot.  Growing or rebalancing edits the map: a
record's slot never changes, and only the slots whose entry was edited move.

The map has exactly ``n_slots`` entries however large the data is, so it is
made on the driver and applied as a constant array: no join and no shuffle.

A record is its key and text.  Equal records would share a slot; where they
repeat in the table (``with_repeats``), each row gets a number that spreads
them, so no slot grows with the copies of one record.

Edge cases: null or empty texts have size 1; rows whose key is null hash by
their text; a very long text counts by its bytes alone; rows of equal key and
text take their places in a shard in any order; an empty table gives a map
that deals the slots out in turn; columns of any other name pass through
``assign`` untouched.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import ensure_checkpoint_dir
from .common import checkpointed, counted, literal_array, read

N_SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[s]``, ``bytes_of[s]``, ``rows_of[s]`` for each slot ``s``."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]
    bytes_of: tuple[int, ...]
    rows_of: tuple[int, ...]

    def loads(self) -> list[int]:
        out = [0] * self.n_shards
        for shard, size in zip(self.shard_of, self.bytes_of, strict=True):
            out[shard] += size
        return out

    def row_offsets(self) -> list[int]:
        """Rows of the slots before each slot in its own shard."""
        seen, out = [0] * self.n_shards, []
        for shard, rows in zip(self.shard_of, self.rows_of, strict=True):
            out.append(seen[shard])
            seen[shard] += rows
        return out


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def virtual_slot(key: Column, text: Column, n_slots: int = N_SLOTS, repeat: Column | None = None) -> Column:
    """The slot of a record, which is key and text; ``repeat`` (a number, 0
    for all but the repeats of one record) spreads equal records over slots."""
    h = F.xxhash64(key, F.lit("text"), text)
    return F.pmod(h if repeat is None else F.when(repeat == 0, h).otherwise(F.xxhash64(h, repeat)), F.lit(n_slots)).cast("int")


def slot_totals(df: DataFrame, key: str, text: str, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot: one aggregate, at most ``n_slots`` rows
    to the driver."""
    return totals(df.select(virtual_slot(F.col(key), F.col(text), n_slots).alias("s"), record_size(F.col(text)).alias("b")), n_slots)


def totals(slots: DataFrame, n_slots: int) -> tuple[list[int], list[int]]:
    """The same of rows (``s`` slot, ``b`` bytes)."""
    size, rows = [0] * n_slots, [0] * n_slots
    for r in slots.groupBy("s").agg(F.sum("b").alias("b"), F.count("*").alias("n")).collect():
        size[r["s"]], rows[r["s"]] = r["b"], r["n"]
    return size, rows


def balanced_map(size: list[int], rows: list[int], n_shards: int) -> SlotMap:
    """Version 1: largest slot first, each to the lightest shard."""
    heap = [(0, shard) for shard in range(n_shards)]
    shard_of = [0] * len(size)
    for s in sorted(range(len(size)), key=lambda s: (-size[s], s)):
        load, shard = heapq.heappop(heap)
        shard_of[s] = shard
        heapq.heappush(heap, (load + max(size[s], 1), shard))
    return SlotMap(1, n_shards, tuple(shard_of), tuple(size), tuple(rows))


def _move(m: SlotMap, givers: set[int], takers: set[int]) -> SlotMap:
    """Move slots from givers above the mean to takers below it, largest
    first, as long as a move does not overshoot the mean."""
    shard_of, loads = list(m.shard_of), m.loads()
    mean = sum(loads) / m.n_shards
    for s in sorted(range(len(shard_of)), key=lambda s: (-m.bytes_of[s], s)):
        to = min(takers, key=lambda t: (loads[t], t))
        a, b = shard_of[s], m.bytes_of[s]
        if b and a != to and a in givers and loads[a] - b >= mean - b / 2 and loads[to] + b <= mean + b / 2:
            shard_of[s] = to
            loads[a] -= b
            loads[to] += b
    return replace(m, version=m.version + 1, shard_of=tuple(shard_of))


def rebalance(m: SlotMap, size: list[int], rows: list[int]) -> SlotMap:
    """The next version for changed slot sizes; slots move only out of shards
    above the mean."""
    m = replace(m, bytes_of=tuple(size), rows_of=tuple(rows))
    loads = m.loads()
    above = {s for s in range(m.n_shards) if loads[s] * m.n_shards > sum(loads)}
    return _move(m, above, set(range(m.n_shards)) - above) if above else replace(m, version=m.version + 1)


def grow(m: SlotMap) -> SlotMap:
    """The next version with one more shard, which takes slots only into itself."""
    new = m.n_shards
    return _move(replace(m, n_shards=new + 1), set(range(new)), {new})


def save_map(spark: SparkSession, m: SlotMap, path: str) -> None:
    """Store one version under ``path`` (a shared folder); versions are never overwritten."""
    rows = [(s, m.n_shards, *x) for s, x in enumerate(zip(m.shard_of, m.bytes_of, m.rows_of, strict=True))]
    schema = "slot int, n_shards int, shard int, bytes long, n_rows long"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={m.version}")


def load_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    rows = sorted(spark.read.parquet(f"{path}/version={version}").collect(), key=lambda r: r["slot"])
    return SlotMap(version, rows[0]["n_shards"], *(tuple(r[c] for r in rows) for c in ("shard", "bytes", "n_rows")))


def assign(df: DataFrame, m: SlotMap, key: str, text: str, slot_col: str = "virtual_slot", shard_col: str = "shard") -> DataFrame:
    """Add each record's virtual slot and shard: a projection."""
    slot = virtual_slot(F.col(key), F.col(text), len(m.shard_of))
    return df.withColumn(slot_col, slot).withColumn(shard_col, F.element_at(literal_array(m.shard_of, "int"), F.col(slot_col) + 1))


def positions(df: DataFrame, m: SlotMap, order: list[str], slot_col: str = "virtual_slot", out: str = "slot") -> DataFrame:
    """Add each record's place in its shard, gapless from 0: the rows of the
    shard's earlier virtual slots (from the map) plus the place within its own
    slot, so the widest window is one virtual slot."""
    inside = F.row_number().over(W.partitionBy(slot_col).orderBy(*order))
    return df.withColumn(out, F.element_at(literal_array(m.row_offsets()), F.col(slot_col) + 1) + inside.cast("long") - 1)


def with_repeats(narrow: DataFrame, record: list[str], row: str = "row") -> DataFrame:
    """``narrow`` with ``repeat``: 0, but a number of its own (from ``row``,
    unique and not negative) for every row of a record that occurs more than once."""
    twice = narrow.groupBy(*record).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(c).alias(f"r_{c}") for c in record])
    twice = counted(twice)
    same = F.lit(True)
    for c in record:
        same = same & narrow[c].eqNullSafe(twice[f"r_{c}"])
    both = narrow.join(twice.withColumn("twice", F.lit(True)), same, "left")
    return both.select(*[narrow[c] for c in narrow.columns], F.when(F.col("twice"), F.col(row) + 1).otherwise(F.lit(0)).cast("long").alias("repeat"))


def shard_documents(spark: SparkSession, sf_dir: str, n_shards: int = 8, n_slots: int = N_SLOTS) -> DataFrame:
    """Every document with its size, checksum, shard and place in the shard.
    The map goes through its stored version, a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    text = F.col("text").cast("string")
    narrow = checkpointed(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("k_text"), record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
    ))
    rows = with_repeats(narrow, ["doc_id", "k_text"])
    rows = checkpointed(rows.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("k_text"), n_slots, F.col("repeat"))))
    made = balanced_map(*totals(rows.select(F.col("virtual_slot").alias("s"), F.col("size").alias("b")), n_slots), n_shards)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shard-maps-{uuid.uuid4().hex}"
    save_map(spark, made, folder)
    m = load_map(spark, folder, made.version)
    shard = F.element_at(literal_array(m.shard_of, "int"), F.col("virtual_slot") + 1)
    placed = positions(rows.withColumn("shard", shard), m, ["doc_id", "size", "text_crc32", "row"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(m.version).alias("map_version"),
    )
