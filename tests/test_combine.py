"""Level-by-level sums over many partitions."""

import numpy as np
import pytest

from tessera.operators import combine


def adder():
    def add(batch, total):  # a nested function is shipped whole
        i = batch.column(0).to_numpy()
        x, h = np.array([batch.num_rows, i.sum(), 0.1 * batch.num_rows]), np.array([np.bitwise_xor.reduce(i * 31)])
        return (x, h) if total is None else (total[0] + x, total[1] ^ h)

    return add


@pytest.mark.parametrize(("parts", "fan_in"), [(1, 64), (7, 2), (64, 64), (1000, 10)])
def test_sum_over_partitions(spark, parts, fan_in):
    df = spark.range(0, 5000, 1, parts)
    assert combine.n_tasks(df) == parts
    partial = combine.partial_sums(df, adder())
    total, mixed = combine.tree_sum(partial, parts, fan_in)
    assert total[:2].tolist() == [5000, 5000 * 4999 / 2]
    assert mixed.tolist() == [np.bitwise_xor.reduce(np.arange(5000) * 31)]
    assert total.tobytes() == combine.tree_sum(partial, parts, fan_in)[0].tobytes()


def test_no_more_than_fan_in_meet(spark):
    """1,000 tasks over levels of 10: 100, 10, then 10 rows for the driver."""
    partial = combine.partial_sums(spark.range(0, 1000, 1, 1000), adder())
    first = combine._level(partial, 100, 10)
    assert first.count() == 100
    second = combine._level(first, 10, 10)
    assert sorted(r["part"] for r in second.collect()) == list(range(10))


def test_no_rows(spark):
    df = spark.range(0)
    assert combine.tree_sum(combine.partial_sums(df, adder()), combine.n_tasks(df)) is None
