"""Checks that ride on a scoring job.

A check before scoring reads the input once more; on a stream there is nothing
to read beforehand.  Here ``DataFrame.observe`` counts rows and bad rows while
they are scored, and the errors that a check beforehand would raise are raised
when the job has ended (batch) or when a trigger has ended (stream).  Widths
are held against the model's (a check beforehand takes the first row's).

    check = RidingCheck(df, "f", model.n_features)
    model.predict(check.rows, "f", validate=False).write.parquet(out)
    check.raise_if_bad()

The output of a job that turns out bad has been written by then: write aside
and publish after ``raise_if_bad``, as with any check after the fact.  The
position of a bad row (its rank among the ids) is one more count, on failure
only.  Array rows of a wrong width become null vectors in ``rows``, so that
they are counted instead of ending the job at the first of them.  Read ``rows``
in one job only, whole: counters speak of the first job that has ended, and
rows that the plan filters away below the counters are not seen.  Rows that
Spark works through twice (a lost task, the sampling before a sort) count
twice; the errors do not depend on it, since they ask only whether bad rows
are there, whether all are of a wrong width, and which comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import errors as E
from ..frames import Matrix, as_matrix
from ..functions.vector import nonfinite
from .checks import rank_of


def _counters(m: Matrix, expected: int) -> list[Column]:
    """Rows, bad rows, and the first bad row (smallest id) as (id, width, column)."""
    idc = F.col(m.id_col)
    if m.is_array:
        arr = F.col(m.array_col)
        width = F.coalesce(F.size(arr), F.lit(0))
        column = F.coalesce(F.array_position(F.transform(arr, lambda x: nonfinite(x.cast("double"))), True), F.lit(0))
    else:
        width = F.lit(m.n_features)
        flags = [F.when(nonfinite(x), F.lit(i + 1)) for i, x in enumerate(m.xs())]
        column = F.coalesce(*flags, F.lit(0))
    bad = (width != expected) | (column > 0)
    first = F.struct(idc.alias("id"), width.cast("int").alias("width"), column.cast("int").alias("column"))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(bad, 1)).alias("n_bad_rows"),
        F.count(F.when(width != expected, 1)).alias("n_wrong_width"),
        F.min(F.when(bad, first)).alias("first_bad"),
    ]


def _rows(m: Matrix, expected: int) -> DataFrame:
    if not m.is_array:
        return m.df
    blank = F.array_repeat(F.lit(None).cast("double"), expected)
    kept = F.when(F.size(F.col(m.array_col)) == expected, F.col(m.array_col).cast("array<double>")).otherwise(blank)
    return m.df.withColumn(m.array_col, kept)


def error_of(seen: dict, expected: int, position: Callable[[object], int]) -> Exception | None:
    """The error that the counters stand for, if any."""
    if not seen["n_rows"]:
        return E.EmptyDataset()
    first = seen["first_bad"]
    if not seen["n_bad_rows"]:
        return None
    if first["width"] == 0:
        return E.EmptyRow(row=position(first["id"]))
    if first["width"] == expected:
        return E.NonFiniteInput(row=position(first["id"]), column=first["column"])
    if seen["n_wrong_width"] == seen["n_rows"]:
        return E.FeatureCountMismatch(expected=expected, actual=first["width"])
    return E.RaggedMatrix(row=position(first["id"]), expected=expected, actual=first["width"])


class RidingCheck:
    """Counters on ``rows``, to be scored with ``validate=False``."""

    def __init__(self, df: DataFrame, features: Sequence[str] | str, expected: int, id_col: str = "id"):
        m = as_matrix(df, features, id_col)
        if not m.is_array and m.n_features != expected:
            raise E.FeatureCountMismatch(expected=expected, actual=m.n_features)
        self._df, self._id, self.expected = df, id_col, expected
        self._seen = Observation()
        self.rows = _rows(Matrix(df.observe(self._seen, *_counters(m, expected)), m.id_col, m.columns, m.array_col, m.n_features), expected)

    @property
    def counts(self) -> dict:
        """n_rows, n_bad_rows, n_wrong_width, first_bad; waits for the scoring job."""
        return dict(self._seen.get)

    def raise_if_bad(self) -> None:
        error = error_of(self.counts, self.expected, lambda i: rank_of(self._df, self._id, i))
        if error is not None:
            raise error


class StreamCheck(StreamingQueryListener):
    """Counters of a scored stream, trigger by trigger.

    ``observe(stream)`` gives the rows to score; ``counts`` adds up what has
    been seen, and ``on_bad(batch_id, counters)`` is called for each trigger
    that holds bad rows.  Add it to ``spark.streams`` before the query starts.
    Only totals and the first bad row are kept."""

    def __init__(self, name: str, features: Sequence[str] | str, expected: int, id_col: str = "id", on_bad: Callable[[int, dict], None] | None = None):
        self.name, self.features, self.expected, self.id_col = name, features, expected, id_col
        self.on_bad = on_bad
        self.counts = {"n_rows": 0, "n_bad_rows": 0, "n_wrong_width": 0, "first_bad": None}
        self._batches: dict[str, int] = {}

    def observe(self, stream: DataFrame) -> DataFrame:
        m = as_matrix(stream, self.features, self.id_col)
        if not m.is_array and m.n_features != self.expected:
            raise E.FeatureCountMismatch(expected=self.expected, actual=m.n_features)
        seen = stream.observe(self.name, *_counters(m, self.expected))
        return _rows(Matrix(seen, m.id_col, m.columns, m.array_col, m.n_features), self.expected)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        run, batch = str(event.progress.runId), event.progress.batchId
        if row is None or self._batches.get(run, -1) >= batch:
            return  # another query's, or a trigger without new data
        self._batches[run] = batch
        for k in ("n_rows", "n_bad_rows", "n_wrong_width"):
            self.counts[k] += row[k] or 0
        if row["n_bad_rows"]:
            self.counts["first_bad"] = self.counts["first_bad"] or row["first_bad"].asDict()
            if self.on_bad is not None:
                self.on_bad(batch, row.asDict(recursive=True))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def raise_if_bad(self) -> None:
        """Rows of a stream have no rank: the error's row is the count of rows seen so far."""
        if self.counts["n_bad_rows"]:
            raise error_of(self.counts, self.expected, lambda _: self.counts["n_rows"])
