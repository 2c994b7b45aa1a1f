"""Sums of model-sized arrays over tasks, added up level by level.

A fit step makes one array per task.  Added in one go, tasks x array would
meet in one place; here at most ``fan_in`` of them meet, then at most
``fan_in`` of the results, and so on.  Additions go by task number, so a run
over the same partitions gives the same sum to the last bit.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import parallelism

FAN_IN = 64
SCHEMA = "part int, v binary, x binary"
STATE_SCHEMA = "part int, state binary"
NO_LONGS = np.zeros(0, np.int64)


def _row(part: int, total: np.ndarray, mixed: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([total.astype("<f8").tobytes()], pa.binary()), pa.array([mixed.astype("<i8").tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *cells], ["part", "v", "x"])


def partial_sums(df: DataFrame, add: Callable[[pa.RecordBatch, tuple | None], tuple]) -> DataFrame:
    """One row per task that has rows: its number and its (floats, longs),
    built up by ``total = add(batch, total)``.  Floats are summed over tasks,
    longs (fingerprints) xor-ed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                total = add(b, total)
        if total is not None:
            yield _row(TaskContext.get().partitionId(), np.asarray(total[0], dtype=float).ravel(), np.asarray(total[1], dtype=np.int64).ravel())

    return df.mapInArrow(run, SCHEMA)


def _level(parts: DataFrame, n: int, fan_in: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mixed = None, None
        for b in batches:
            for v, x in zip(b.column("v"), b.column("x"), strict=True):
                floats, longs = np.frombuffer(v.as_py(), "<f8"), np.frombuffer(x.as_py(), "<i8")
                total = floats.copy() if total is None else np.add(total, floats, out=total)
                mixed = longs.copy() if mixed is None else np.bitwise_xor(mixed, longs, out=mixed)
        if total is not None:
            yield _row(TaskContext.get().partitionId(), total, mixed)

    group = F.floor(F.col("part") / fan_in).cast("int")
    return parts.repartitionById(n, group).sortWithinPartitions("part").mapInArrow(run, SCHEMA)


def tree_sum(parts: DataFrame, n_parts: int, fan_in: int = FAN_IN) -> tuple[np.ndarray, np.ndarray] | None:
    """The (floats, longs) of ``partial_sums`` over ``n_parts`` tasks (None
    without rows); at most ``fan_in`` arrays reach any task or the driver."""
    while n_parts > fan_in:
        n_parts = -(-n_parts // fan_in)
        parts = _level(parts, n_parts, fan_in)
    total, mixed = None, None
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        floats, longs = np.frombuffer(bytes(r["v"]), "<f8"), np.frombuffer(bytes(r["x"]), "<i8")
        total = floats.copy() if total is None else total + floats
        mixed = longs.copy() if mixed is None else mixed ^ longs
    return None if total is None else (total, mixed)


def partial_states(df: DataFrame, add: Callable[[pa.RecordBatch, object], object]) -> DataFrame:
    """One row per task that has rows: its number and its state, built up by
    ``state = add(batch, state)`` (plain values and numpy arrays)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            if b.num_rows:
                state = add(b, state)
        if state is not None:
            yield _state(TaskContext.get().partitionId(), state)

    return df.mapInArrow(run, STATE_SCHEMA)


def _state(part: int, state: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())], ["part", "state"])


def tree_fold(parts: DataFrame, merge: Callable) -> object | None:
    """The states of ``partial_states`` merged in task order (None without
    rows).  How many tasks made them need not be known: they are merged in as
    many groups as there are cores, then in ``FAN_IN``, which reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for b in batches:
            for p, raw in zip(b.column("part"), b.column("state"), strict=True):
                state = pickle.loads(raw.as_py())
                total, part = (state, p.as_py()) if total is None else (merge(total, state), part)
        if total is not None:
            yield _state(part, total)

    cores = parallelism(parts.sparkSession)
    for n in (cores, FAN_IN) if cores > FAN_IN else (cores,):
        parts = parts.repartitionById(n, F.col("part") % n).sortWithinPartitions("part").mapInArrow(run, STATE_SCHEMA)
    total = None
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        state = pickle.loads(bytes(r["state"]))
        total = state if total is None else merge(total, state)
    return total


def n_tasks(df: DataFrame) -> int:
    """Tasks that a scan of ``df`` takes; for scans and persisted or
    checkpointed tables, of which asking runs nothing."""
    return df.rdd.getNumPartitions()
