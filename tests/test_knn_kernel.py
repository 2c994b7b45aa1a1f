"""The per-block top-k kernel against brute force, on every path."""

import numpy as np
import pytest

import tessera.operators.knn as K


def brute(qx, tx, tid, k, metric):
    out = []
    for q in qx:
        acc = np.zeros(len(tx))
        for j in range(tx.shape[1]):
            diff = q[j] - tx[:, j]
            acc += diff * diff if metric == "euclidean" else np.abs(diff)
        dd = np.sqrt(acc) if metric == "euclidean" else acc
        out.append(sorted(zip(dd, tid))[:k])
    return out


def check(qx, tx, k, metric, rng):
    tid = rng.permutation(100_000)[: len(tx)]
    qi, ti, di, _, ri = K.block_top_k(np.arange(len(qx)), qx, tid, tx, rng.random(len(tx)), k, metric)
    exp = brute(qx, tx, tid, k, metric)
    for q in range(len(qx)):
        assert list(ti[qi == q]) == [e[1] for e in exp[q]]
        assert list(di[qi == q]) == [e[0] for e in exp[q]]
        assert list(ri[qi == q]) == list(range(1, min(k, len(tx)) + 1))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_direct_path(metric):
    rng = np.random.default_rng(3)
    for trial in range(120):
        nt, nq, d, k = rng.integers(1, 60), rng.integers(1, 8), rng.integers(1, 4), rng.integers(1, 9)
        hi = 2 if trial % 2 else 50  # few distinct values: many ties
        tx = rng.integers(0, hi, size=(nt, d)).astype(float)
        qx = rng.integers(0, hi + 1, size=(nq, d)).astype(float)
        check(qx, tx, k, metric, rng)


def test_screened_path():
    rng = np.random.default_rng(4)
    for trial in range(60):
        nt, nq, d, k = rng.integers(2, 70), rng.integers(1, 8), rng.integers(8, 40), rng.integers(1, 9)
        if trial % 3 == 0:
            tx = rng.normal(size=(nt, d))
        elif trial % 3 == 1:
            tx = rng.integers(0, 2, size=(nt, d)).astype(float) * 1e3
        else:
            tx = rng.normal(size=d) + rng.normal(size=(nt, d)) * 1e-9
        tx = np.vstack([tx, tx[: nt // 3]])
        qx = np.vstack([tx[:2], rng.normal(size=(nq, d)) * tx.std() + tx.mean()])
        check(qx, tx, k, "euclidean", rng)
