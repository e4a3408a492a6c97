"""Embedding whitening against whole numbers and a dense eigensolver."""
import collections
import math

import numpy as np
import pytest
from helpers import CLASH

SCHEMA = "vec_id long, embedding array<double>, " + ", ".join(f"{c} string" for c in CLASH)


def _spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return q, (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(40, 0, -1.0), 2.0 ** -np.arange(48), np.ones(12), [5, 5, 5, 3, 3, 2, 1, 1, 1, 1, 1e-9, 0, 0], [7.0], [2.0, 0.0], np.zeros(6),
    np.concatenate([[1e6, 1e4], 1 + 1e-7 * np.arange(20), [1e-3] * 5]), 1 + 1e-12 * np.arange(30)])
def test_feast_finds_all_eigenpairs(values):
    from sitegraph.llm.whitening import leading_eigenpairs
    values = np.sort(np.asarray(values, float))[::-1]
    _, a = _spectrum(np.random.default_rng(3), values)
    for k in (1, 3, 16, 60):
        e, p = leading_eigenpairs(a, k)
        want = values[values > 1e-12 * values[0]][:k] if values[0] > 0 else values[:0]
        assert len(e) == len(want) and p.shape == (len(values), len(want))
        if len(want):
            assert np.abs(e - want).max() < 1e-13 * values[0] and (np.diff(e) <= 0).all()
            assert np.abs(a @ p - p * e).max() < 2e-13 * values[0]
            assert np.abs(p.T @ p - np.eye(len(e))).max() < 1e-10


def test_inertia_counts():
    from sitegraph.llm.whitening import count_above, tridiagonal
    _, a = _spectrum(np.random.default_rng(1), np.arange(1.0, 31))
    tri = tridiagonal(a)
    assert [count_above(tri, s + 0.5) for s in range(31)] == [30 - s for s in range(31)]
    assert count_above(tridiagonal(np.eye(5)), 1 - 1e-9) == 5 and count_above(tridiagonal(np.eye(5)), 1 + 1e-9) == 0


def _plain(rows):
    """(rows that stay, n, deviations, covariance, centred fit rows)"""
    kept = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in kept]
    mean = np.array([s / n for s in sums])
    centred = np.array([[a - s // n for a, s in zip(x, sums)] for x in fit], float) - np.array([(s % n) / n for s in sums])
    return kept, n, dev, centred.T @ centred / n, mean


def _compare(got, rows):
    kept, n, dev, v, mean = _plain(rows)
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:16], p[:, ::-1][:, :16]
    k = int((e > 1e-12 * e[0]).sum())
    by = collections.defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c in by:
        own = sorted(by[c], key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation))
        want = sorted(((i is None, i or 0, d, (np.array(x) - mean) @ p[:, c - 1] / np.sqrt(e[c - 1])) for (i, x), d in zip(kept, dev)))
        assert [(r.vec_id or 0, r.n, r.deviation) for r in own] == [(w[1], n, w[2]) for w in want]
        a, b = np.array([r.whitened for r in own]), np.array([w[3] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        assert all(abs(r.explained * np.trace(v) / e[c - 1] - 1) < 1e-9 for r in own)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_the_table(spark, sf):
    import __spark_entry__ as E
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    _compare(E.queries()["op13_whitening"](spark, sf).collect(), rows)


def test_whitening_edges(spark):
    from sitegraph.llm.whitening import whitened
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 3, 5).tolist()) for i in range(60)]
    bad = [(100, None), (101, [1.0, None, 0, 0, 0]), (102, [float("nan"), 0, 0, 0, 0]), (103, [0, 0, float("-inf"), 0, 0])]
    rows += [(None, [1.0, 2.0, 3.0, 4.0, 5.0])] * 3 + [(7, rows[7][1])] * 40 + [(200, [0.0, -0.0, 1e-300, -1e-300, 0.5])]

    def df(rows):
        return spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], *["z"] * len(CLASH)) for i, v in rows], SCHEMA)
    _compare(whitened(df(rows + bad)).collect(), rows + bad)
    wide = [(i, [float(a), float(a), b]) for i, (a, b) in enumerate(rng.normal(0, 1e4, (40, 2)).tolist())]  # one dimension twice
    _compare(whitened(df(wide + [(99, [1.0])])).collect(), wide)
    assert len(whitened(df(wide)).where("component = 1").collect()) == 40
    huge = whitened(df([(1, [1e14, 0.0]), (2, [-1e14, 1.0]), (3, [1e300, 1.0]), (4, [3.0, 2.0])]))
    assert {r.vec_id for r in huge.collect()} == {1, 2, 4} and huge.where("deviation is null").count() > 0
    assert whitened(df([(1, [1.0, 2.0])] * 5)).count() == 0 and whitened(df(bad)).count() == 0 and whitened(df([])).count() == 0
    assert whitened(df([(1, [])])).count() == 0
