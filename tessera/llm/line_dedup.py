"""Line dedup: which lines of which documents repeat.

A line's key is the line without blanks at its ends, A-Z lower-cased.  Keys of
at least ``min_chars`` code points are hashed (128 bits), and (hash, document,
position) is range-partitioned in that order, so even one line that a third of
all documents share is spread over many ranges and sorted within each.  A pass
over each sorted range streams the runs of equal hashes, holding at most
``HELD_ROWS`` rows (and a batch) of a run:

* rule ``frequent``: a run of ``min_docs`` documents is dropped whole;
* rule ``first``: all but the run's first row are dropped.

Runs at the edges of a range may go on in the next one, and a run of few
documents may have very many rows; their rows are set aside as they come and
decided from the summed counts, less one wherever a range begins
with the document that the one before it ended with.  The result is a compressed
bitmap per document (the non-zero 64-bit words of its dropped positions), not
text; ``kept_text`` applies it.

Edge cases: null and empty texts are one empty line, whose key is too short to
count; a very long text is many rows; repeated rows of one (id, text) are one document; rows of null id are
told apart by their text; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import BLANKS, ascii_lower, checkpointed, read, row_key

MIN_CHARS, MIN_DOCS = 1, 10
#: Rows of an undecided run that a task holds.
HELD_ROWS = 4096


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2 (128 bits of the key), k_id, k_text, pos of every line that counts."""
    rows = docs.select(*row_key(docs), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    rows = rows.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "k_id", "k_text", "pos")


_FIELDS = ["part", "kind", "h1", "h2", "k_id", "k_text", "pos", "n_docs", "from_id", "from_text"]
_SCHEMA = "part int, kind int, h1 long, h2 long, k_id long, k_text long, pos int, n_docs long, from_id long, from_text long"
DROP, ASIDE, EDGE = 0, 1, 2


def _stream_runs(min_docs: int, first: bool):
    """Over one range's rows, sorted by (h1, h2, k_id, k_text, pos): rows to
    drop (DROP); rows of an edge run that is not decided here (ASIDE); and one
    row per edge run with its last document, its number of documents here and
    the first of them (EDGE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None

        def out(kind, t, n_docs=0, begin=None):
            n = len(t["pos"])
            cols = [np.full(n, part, np.int32), np.full(n, kind, np.int32), t["h1"], t["h2"], None, t["k_text"], t["pos"], np.full(n, n_docs, np.int64)]
            arrays = [pa.array(c) if c is not None else pa.array(t["k_id"], mask=t["null"]) for c in cols]
            arrays += [pa.array(begin["k_id"], mask=begin["null"]), pa.array(begin["k_text"])] if begin else [pa.nulls(n, pa.int64())] * 2
            return pa.RecordBatch.from_arrays(arrays, _FIELDS)

        names = ["h1", "h2", "k_id", "null", "k_text", "pos"]
        take = lambda t, i: {c: t[c][i] for c in names}
        join = lambda a, b: {c: np.concatenate([a[c], b[c]]) for c in names}
        first_edge = True  # no run has ended yet
        held = None  # the open run: rows while undecided, n documents, first and last row
        n_docs, begin, last, aside = 0, None, None, False

        def fresh(t):
            """1 where a row starts another document than the row before it."""
            new = np.ones(len(t["pos"]), np.int64)
            new[1:] = (np.diff(t["k_id"]) != 0) | (np.diff(t["k_text"]) != 0) | (t["null"][1:] != t["null"][:-1])
            return new

        def feed(t):
            """Add rows of the open run; yields what is decided."""
            nonlocal held, n_docs, begin, last, aside
            if last is None:
                begin = take(t, slice(0, 1))
            new = fresh(t)
            if last is not None and all(last[c][0] == t[c][0] for c in ("k_id", "null", "k_text")):
                new[0] = 0
            decided = n_docs >= min_docs
            n_docs += int(new.sum())
            last = take(t, slice(-1, None))
            if decided:
                yield out(DROP, t)
                return
            held = t if held is None else join(held, t)
            if n_docs >= min_docs:
                yield out(DROP, held)
                held = None
            elif len(held["pos"]) > HELD_ROWS:
                yield out(ASIDE, held)
                held, aside = None, True

        def close(edge):
            """End the open run; an edge run may go on in another range."""
            nonlocal held, n_docs, begin, last, aside, first_edge
            if last is not None:
                if edge or aside:
                    if held is not None:
                        yield out(ASIDE, held)
                    yield out(EDGE, last, n_docs, begin)
            held, n_docs, begin, last, aside, first_edge = None, 0, None, None, False, False

        def first_rows(t):
            """Rule first: all rows of a run but its first record are dropped;
            ``last`` is that record (of the open run)."""
            nonlocal last
            if last is None:
                yield out(ASIDE, take(t, slice(0, 1)))
            else:
                t = join(last, t)
            n = len(t["pos"])
            begins = np.ones(n, bool)
            begins[1:] = (np.diff(t["h1"]) != 0) | (np.diff(t["h2"]) != 0)
            head = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
            other = np.zeros(n, bool)
            for c in ("k_id", "null", "k_text", "pos"):
                other |= t[c] != t[c][head]
            yield out(DROP, take(t, other))
            last = take(t, head[-1:])

        for b in batches:
            if not b.num_rows:
                continue
            c = dict(zip(["part", *names[:3], "k_text", "pos"], b.columns, strict=False))
            part = c["part"][0].as_py()
            t = {n: c[n].to_numpy(zero_copy_only=False) for n in ("h1", "h2", "k_text", "pos")}
            t["null"] = c["k_id"].is_null().to_numpy(zero_copy_only=False)
            t["k_id"] = c["k_id"].fill_null(0).to_numpy(zero_copy_only=False)
            if first:
                yield from first_rows(t)
                continue
            cut = np.flatnonzero((np.diff(t["h1"]) != 0) | (np.diff(t["h2"]) != 0)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(t["pos"])]])
            goes_on = last is not None and last["h1"][0] == t["h1"][0] and last["h2"][0] == t["h2"][0]
            if last is not None and not goes_on:
                yield from close(first_edge)
            if len(starts) == 1 or goes_on or first_edge:
                yield from feed(take(t, slice(starts[0], ends[0])))
                if len(starts) > 1:
                    yield from close(first_edge)
                starts, ends = starts[1:], ends[1:]
            if len(starts) > 1:  # runs that begin and end in this batch
                new = fresh(t)
                new[starts] = 1
                total = np.concatenate([[0], np.cumsum(new)])
                docs = total[ends[:-1]] - total[starts[:-1]]
                marked = np.zeros(len(t["pos"]) + 1, np.int64)
                marked[starts[:-1][docs >= min_docs]] += 1
                marked[ends[:-1][docs >= min_docs]] -= 1
                yield out(DROP, take(t, np.cumsum(marked[:-1]) > 0))
            if len(starts):
                yield from feed(take(t, slice(starts[-1], ends[-1])))
        if first:
            if last is not None:
                yield out(EDGE, last, 1)
        else:
            yield from close(True)

    return run


def dropped_positions(docs: DataFrame, rule: str = "frequent", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """k_id, k_text, pos of every line to drop."""
    order = ["h1", "h2", "k_id", "k_text", "pos"]
    ranged = line_hashes(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select(F.spark_partition_id().alias("part"), *order)
    got = checkpointed(ranged.mapInArrow(_stream_runs(min_docs, rule == "first"), _SCHEMA))
    edges, aside = got.where(F.col("kind") == EDGE), got.where(F.col("kind") == ASIDE)
    if rule == "first":
        # a range's first row repeats if an earlier range ends in its hash
        ends = edges.groupBy("h1", "h2").agg(F.min("part").alias("p"))
        more = aside.join(ends, ["h1", "h2"]).where("p < part")
    else:
        # a document that goes on from the range before is counted there
        by_range = W.partitionBy("h1", "h2").orderBy("part")
        goes_on = F.lag("k_id").over(by_range).eqNullSafe(F.col("from_id")) & (F.lag("k_text").over(by_range) == F.col("from_text"))
        new = edges.withColumn("n_docs", F.col("n_docs") - F.coalesce(goes_on, F.lit(False)).cast("long"))
        whole = new.groupBy("h1", "h2").agg(F.sum("n_docs").alias("total")).where(F.col("total") >= min_docs)
        more = aside.join(whole, ["h1", "h2"], "left_semi")
    sure = got.where(F.col("kind") == DROP)
    return sure.select("k_id", "k_text", "pos").unionByName(more.select("k_id", "k_text", "pos"))


def drop_bitmaps(docs: DataFrame, rule: str = "frequent", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document that loses lines: ``k_id``, ``k_text``, ``bitmap``:
    map from word number to 64-bit word; bit pos % 64 of word pos / 64 set
    means dropped (clear, or no such word: keep)."""
    at = dropped_positions(docs, rule, min_docs, min_chars)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)
    parts = at.groupBy("k_id", "k_text", F.expr("CAST(pos DIV 64 AS INT)").alias("w")).agg(F.bit_or(bit).alias("bits"))
    return parts.groupBy("k_id", "k_text").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("bitmap"))


def dropped(bitmap: Column, pos: Column) -> Column:
    word = F.coalesce(F.try_element_at(bitmap, F.floor(pos / 64).cast("int")), F.lit(0).cast("long"))
    return F.call_function("getbit", word, pos % 64) == 1


def kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """k_id, k_text, n_lines, n_dropped, text without the dropped lines."""
    rows = docs.select(*row_key(docs), text_lines(F.col("text")).alias("lines"))
    b = bitmaps.withColumnRenamed("k_id", "b_id").withColumnRenamed("k_text", "b_text")
    both = rows.join(b, rows["k_id"].eqNullSafe(b["b_id"]) & (rows["k_text"] == b["b_text"]), "left")
    kept = F.when(F.col("bitmap").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~dropped(F.col("bitmap"), i)))
    out = both.select("k_id", "k_text", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return out.select("k_id", "k_text", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"))


def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's line counts and the checksum of what stays."""
    docs = read(spark, sf_dir, "documents")
    out = kept_text(docs, drop_bitmaps(docs))
    return out.select(F.col("k_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
