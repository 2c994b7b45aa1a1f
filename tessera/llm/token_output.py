"""Token-ID output in training order.

Texts are encoded with a given byte-pair vocabulary and closed by an end
token; the token streams are laid end to end in an order that depends on the
rows alone (a hash of id and text), and cut into sequences of ``length``
tokens.  A keyed Feistel permutation with cycle-walking gives every sequence
its global slot in training order; slots are range-partitioned, whole shards a
partition, and each shard holds a fixed number of slots of fixed stride, so
slot s is found by arithmetic and a reader can resume anywhere.

Token bytes travel compressed and are shuffled twice: by hash range, whose
tasks stream their rows in order, add up running places and write the
checkpoint (the first shuffle's files are freed then), and by slot.  The hash
ranges follow the size of the input; the driver holds one total per range.
Equal records are one row with a count: counted within each Arrow batch before
the first shuffle, so a record that a third of all rows repeat brings one row
a batch, and dealt out again over many tasks when sequences are cut.  A
sequence is assembled by the task that holds its slot, a row at a time.

Edge cases: null and empty texts have no tokens and no end token; a text
longer than a sequence runs on through as many as it needs; repeated rows are
written as often as they occur; the last sequence is filled with end tokens;
an empty table gives no sequences; other columns are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, read, run_starts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts were cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, SHARD_SLOTS, KEY = 1024, 4096, 20240229
#: Input bytes (by Spark's estimate) of one hash range, and the most ranges.
RANGE_BYTES, MAX_RANGES = 32 << 20, 1 << 16
#: Estimates from here on are Spark's word for "unknown".
UNKNOWN_BYTES = 1 << 60
#: Most partitions of the slots (each holds whole shards).
MAX_SLOT_RANGES = 20_000
#: Copies of one record that a task cuts in a row.
COPIES = 64
#: Level of the compression of travelling token bytes.
ZSTD = 1


class Pieces:
    """Token bytes of whole texts.  (Remembering the tokens of words took half
    as long again where most words of a text are rare.)"""

    def __init__(self, vocabulary: bytes, dtype: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.dtype = dtype

    def ids(self, text: str) -> bytes:
        return np.array(self.encoder.encode_ordinary(text), dtype=self.dtype).tobytes()

    text = ids


def token_rows(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = 50256) -> DataFrame:
    """k_id, h1, h2 (hashes of the record), n, copies, tokens (little-endian
    ids, the end token included; compressed): one row per record and batch."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    dtype = "<u2" if end < 2**16 else "<u4"
    width = np.dtype(dtype).itemsize
    tail = np.array([end], dtype=dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pieces, packer = None, zstandard.ZstdCompressor(level=ZSTD, write_checksum=False)
        for b in batches:
            pieces = pieces or Pieces(data.value, dtype)
            keys = [b.column(c).to_numpy() for c in ("h1", "h2")]
            order = np.lexsort(keys)
            starts = run_starts([k[order] for k in keys]) if len(order) else order
            rows = b.take(pa.array(order[starts]))
            copies = np.diff(np.append(starts, len(order)))
            made = [pieces.text(t.as_py()) + tail for t in rows.column("text")]
            cols = [*[rows.column(c) for c in ("k_id", "h1", "h2")], pa.array([len(x) // width for x in made], pa.int64()), pa.array(copies, pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([packer.compress(x) for x in made], pa.binary())], ["k_id", "h1", "h2", "n", "copies", "tokens"])

    hashes = [F.xxhash64("doc_id", "text").alias("h1"), F.xxhash64(F.lit(2), "text", "doc_id").alias("h2")]
    rows = docs.select(F.col("doc_id").cast("long").alias("k_id"), *hashes, F.col("text").cast("string").alias("text"))
    return rows.where("length(text) > 0").mapInArrow(run, "k_id long, h1 long, h2 long, n long, copies long, tokens binary")


def hash_ranges(df: DataFrame) -> int:
    """A power of two that follows the size of the tables ``df`` reads, by
    Spark's estimate; the shuffle width where none is known (any number gives
    the same result)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < UNKNOWN_BYTES)
    want = -(-known // RANGE_BYTES) if known else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << (max(1, min(want, MAX_RANGES)) - 1).bit_length()


def laid_out(rows: DataFrame, ranges: int) -> DataFrame:
    """Equal records as one row, each with the tokens ``before`` it in its hash
    range ``part``.  Checkpointed."""
    bits = ranges.bit_length() - 1
    part = F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)
    rising = F.col("h1").bitwiseXOR(F.lit(-(2**63)))  # signed order of this is unsigned order of h1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0

        def out(rows: pa.RecordBatch, copies: np.ndarray) -> pa.RecordBatch:
            nonlocal before
            tokens = rows.column("n").to_numpy() * copies
            at = before + np.cumsum(tokens) - tokens
            before += int(tokens.sum())
            cols = [rows.column("part"), rows.column("k_id"), rows.column("n"), pa.array(copies), pa.array(at), rows.column("tokens")]
            return pa.RecordBatch.from_arrays(cols, ["part", "k_id", "n", "copies", "before", "tokens"])

        held, held_copies = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(c).to_numpy() for c in ("h1", "h2")]
            starts = run_starts(keys)
            copies = np.add.reduceat(b.column("copies").to_numpy(), starts)
            if held is not None and all(held.column(c)[0].as_py() == k[0] for c, k in zip(("h1", "h2"), keys, strict=True)):
                copies[0] += held_copies
            elif held is not None:
                yield out(held, np.array([held_copies]))
            if len(starts) > 1:
                yield out(b.take(pa.array(starts[:-1])), copies[:-1])
            held, held_copies = b.take(pa.array(starts[-1:])), int(copies[-1])
        if held is not None:
            yield out(held, np.array([held_copies]))

    spread = rows.withColumn("part", part).withColumn("up", rising).repartitionById(ranges, "part").sortWithinPartitions("up", "h2")
    return checkpointed(spread.drop("up").mapInArrow(run, "part int, k_id long, n long, copies long, before long, tokens binary"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(x: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of 0..n-1: a balanced Feistel network over the next
    even number of bits, walked on until the value is below n."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def once(v):
        left, right = v >> half, v & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        return (left << half) | right

    out = once(x.astype(np.uint64))
    while (out >= n).any():
        over = out >= n
        out[over] = once(out[over])
    return out.astype(np.int64)


def _pieces(offsets: np.ndarray, total: int, length: int, width: int, key: int):
    """Records cut at the sequences' edges: (slot, seq, at, k_id, piece)."""
    n_seq = -(-total // length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer, opener = zstandard.ZstdCompressor(level=ZSTD, write_checksum=False), zstandard.ZstdDecompressor()
        seq, at, ids, piece = [], [], [], []

        def flush() -> pa.RecordBatch:
            slots = permute(np.array(seq, dtype=np.uint64), n_seq, key)
            cols = [pa.array(slots), pa.array(seq, pa.int64()), pa.array(at, pa.int32()), pa.array(ids, pa.int64()), pa.array(piece, pa.binary())]
            for x in (seq, at, ids, piece):
                x.clear()
            return pa.RecordBatch.from_arrays(cols, ["slot", "seq", "at", "k_id", "piece"])

        for b in batches:
            for part, k_id, copies, before, packed in zip(*(b.column(c).to_pylist() for c in ("part", "k_id", "copies", "before", "tokens")), strict=True):
                tokens = opener.decompress(packed)
                n, start = len(tokens) // width, int(offsets[part]) + before
                for first in range(start, start + n * copies, n):
                    done = 0
                    while done < n:
                        s, offset = divmod(first + done, length)
                        step = min(n - done, length - offset)
                        seq.append(s)
                        at.append(offset)
                        ids.append(k_id)
                        piece.append(packer.compress(tokens[done * width : (done + step) * width]))
                        done += step
                        if len(seq) >= 8192:
                            yield flush()
            if seq:
                yield flush()

    return run


_SEQ = "slot long, shard long, place int, byte_offset long, seq long, n_tokens int, doc_ids array<long>, doc_starts array<int>, tokens binary, crc32 long"


def _assemble(length: int, width: int, end: int, shard_slots: int):
    """Pieces sorted by (slot, at) to one row per slot."""
    fill = np.array([end], dtype=f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        opener = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        now, seq, ids, starts, parts = None, None, [], [], []

        def done():
            body = b"".join(parts)
            n = len(body) // width
            body += fill * (length - n)
            place = now % shard_slots
            rows.append((now, now // shard_slots, place, place * length * width, seq, n, list(ids), list(starts), body, zlib.crc32(body)))

        def flush():
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.int64()]
            names = [x.split()[0] for x in _SEQ.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
            rows.clear()
            return out

        for b in batches:
            for slot, s, at, k_id, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if slot != now:
                    if now is not None:
                        done()
                        if len(rows) >= 512:
                            yield flush()
                    now, seq, ids, starts, parts = slot, s, [], [], []
                ids.append(k_id)
                starts.append(at)
                parts.append(opener.decompress(piece))
        if now is not None:
            done()
        if rows:
            yield flush()

    return run


def training_order(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = 50256, length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY) -> DataFrame:
    """One row per slot, range-partitioned and sorted by slot: the shard, the
    place and byte offset in it, the sequence, its real tokens, the documents
    in it with their first positions, its fixed-stride bytes and checksum."""
    width = 2 if end < 2**16 else 4
    rows = laid_out(token_rows(docs, vocabulary, end), hash_ranges(docs))
    totals = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.sum(F.col("n") * F.col("copies")).alias("n")).collect()}  # a row per range
    if not totals:
        return docs.sparkSession.createDataFrame([], _SEQ)
    offsets = np.zeros(max(totals) + 2, np.int64)
    offsets[1:] = np.cumsum([totals.get(p, 0) for p in range(max(totals) + 1)])
    total = int(offsets[-1])
    # a record of very many copies is cut by many tasks
    once = rows.where(F.col("copies") <= COPIES)
    many = rows.where(F.col("copies") > COPIES).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    many = many.withColumn("before", F.col("before") + F.col("first") * F.col("n")).withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - F.col("first")))
    dealt = once.unionByName(many.drop("first").repartition("part", "before"))
    cut = dealt.mapInArrow(_pieces(offsets, total, length, width, key), "slot long, seq long, at int, k_id long, piece binary")
    shards = -(-(-(-total // length)) // shard_slots)
    each = -(-shards // MAX_SLOT_RANGES)
    group = F.floor(F.col("slot") / (shard_slots * each)).cast("int")
    ranged = cut.repartitionById(-(-shards // each), group).sortWithinPartitions("slot", "at")
    return ranged.mapInArrow(_assemble(length, width, end, shard_slots), _SEQ)


def write_shards(sequences: DataFrame, uri: str) -> DataFrame:
    """Write each shard's bytes as ``shard-NNNNNNNN.bin`` under ``uri`` (a
    shared folder or store that pyarrow reaches) from the sorted ranges of
    ``training_order``, a slot at a time and without another shuffle; returns
    shard, first_slot, n_slots, n_bytes, crc32.  Files are written aside and
    moved into place, so a task may run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(path, recursive=True)
        shard, out, aside, first, count, crc, size = None, None, None, 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            store.move(aside, f"{path}/shard-{shard:08d}.bin")
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, first, count, size, crc)], ["shard", "first_slot", "n_slots", "n_bytes", "crc32"])

        for b in batches:
            for s, slot, tokens in zip(*(b.column(c).to_pylist() for c in ("shard", "slot", "tokens")), strict=True):
                if s != shard:
                    if shard is not None:
                        yield close()
                    shard, first, count, crc, size, aside = s, slot, 0, 0, 0, f"{path}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(aside)
                if slot != first + count:
                    raise ValueError(f"slot {slot} is out of place: sequences must come from training_order")
                out.write(tokens)
                count, crc, size = count + 1, zlib.crc32(tokens, crc), size + len(tokens)
        if shard is not None:
            yield close()

    return sequences.select("shard", "slot", "tokens").mapInArrow(run, "shard long, first_slot long, n_slots long, n_bytes long, crc32 long")


def read_slots(uri: str, first: int, count: int, length: int = LENGTH, width: int = 2, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """``count`` sequences from slot ``first`` on: plain reads at known offsets."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    out, slot = [], first
    while slot < first + count:
        shard, place = divmod(slot, shard_slots)
        n = min(first + count - slot, shard_slots - place)
        with store.open_input_file(f"{path}/shard-{shard:08d}.bin") as f:
            f.seek(place * length * width)
            out.append(f.read(n * length * width))
        slot += n
    return np.frombuffer(b"".join(out), dtype=f"<u{width}").reshape(-1, length)


def token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus as fixed-stride sequences in training order."""
    return training_order(read(spark, sf_dir, "documents"))
