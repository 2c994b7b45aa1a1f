"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..session import cut_lineage

#: Space and the five ASCII control blanks: what ends a word.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    return cut_lineage(df)


def counted(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df`` checkpointed, and marked for broadcast if it has at most ``most`` rows."""
    df = checkpointed(df)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def spaced(text: Column) -> Column:
    """Every blank as one space, none at the ends; null as empty."""
    return F.trim(F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS)))


def words(text: Column) -> Column:
    """Array of the ``[^\\x20\\x09-\\x0D]+`` words (empty for null or blank)."""
    t = spaced(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " +"))


def n_words(text: Column) -> Column:
    t = spaced(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, " +"))).cast("long")


def literal_array(values: Sequence[int], kind: str = "bigint") -> Column:
    """A constant array of numbers (one literal, whatever its length)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two columns that tell rows apart: the id and a hash of the text.  Rows
    equal in both are repeats of one record and share every decision."""
    return [F.col(id_col).cast("long").alias("k_id"), F.xxhash64(F.col(text_col)).alias("k_text")]


def with_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (every column of ``df``, whatever its name), ``k_id``, ``k_text``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *row_key(df, id_col, text_col))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["k_id"].eqNullSafe(b["k_id"]) & (a["k_text"] == b["k_text"])


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def prefix_sums(df: DataFrame, values: dict[str, str], groups: list[str], bucket: str, order: list[str]) -> DataFrame:
    """Exclusive running sums within each group, ordered by ``bucket`` and
    then ``order``; ``values`` maps a new column to the (long) column it sums.

    A group is never brought into one task: each (group, bucket) is summed in
    its own window, and the totals of the buckets before it are added from
    the small table of bucket totals.  ``bucket`` must be non-null and rise
    with ``order``.  Group columns may be null.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"__t{i}") for i, v in enumerate(values.values())])
    before = W.partitionBy(*(groups or [F.lit(0)])).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__o{i}") for i in range(len(values))],
    )
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__i{i}") for i, v in enumerate(values.values())])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & (local[k].eqNullSafe(offsets[f"__k{i}"]) if k != bucket else local[k] == offsets[f"__k{i}"])
    return local.join(offsets, on).select(
        *[local[c] for c in df.columns],
        *[(F.col(f"__i{i}") + F.col(f"__o{i}")).alias(n) for i, n in enumerate(values)],
    )


def run_starts(keys: list[np.ndarray]) -> np.ndarray:
    """Indexes at which a run of equal rows begins (0 included)."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def placed(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """``df`` and ``pos``, each row's place (from 0) in its group by ``order``,
    nulls first; rows equal in all of these go in any order.  ``groups`` are
    non-null long columns.  Checkpointed.

    Rows are range-partitioned by group, order and a row number, so neither a
    large group nor a row repeated very often lands in one task.  Only the
    first group of a partition can have begun in an earlier one: the table of
    places to add has at most one row per partition and is broadcast.
    """
    keys = [*groups, *order, "__row"]
    columns = df.columns
    names = [*columns, "__part", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k = [b.column(g).to_numpy(zero_copy_only=False) for g in groups]
            at = np.arange(b.num_rows)
            starts = run_starts(k)
            pos = at - np.repeat(starts, np.diff(np.append(starts, b.num_rows)))
            if last == [x[0] for x in k]:
                pos[: starts[1] if len(starts) > 1 else len(pos)] += n
            last, n = [x[-1] for x in k], int(pos[-1]) + 1
            kept = [b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.full(b.num_rows, part)), pa.array(pos)], names)

    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    spread = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([*nullable(df.schema).fields, T.StructField("__part", T.LongType()), T.StructField("pos", T.LongType())])
    local = checkpointed(spread.mapInArrow(run, schema))
    counts = local.groupBy(*groups, "__part").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*groups).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    more = counts.withColumn("__before", F.sum("__n").over(before)).where("__before IS NOT NULL").drop("__n")
    both = local.join(F.broadcast(more), [*groups, "__part"], "left")
    return both.select(*columns, (F.col("pos") + F.coalesce("__before", F.lit(0))).alias("pos"))
