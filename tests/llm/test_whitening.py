"""Operator 11 against plain whole-number and NumPy versions, with its odd rows."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.conftest import SF001
from tidewise.llm import whitening as W
from tidewise.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, whitened string, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "w", 3) for i, v in rows], SCHEMA)


def plain(rows):
    """Whole-number vectors by id, n, sums and covariance (divisor n, centred first) of the usable rows."""
    good = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows
            if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in good], float)
    return good, [sum(c) for c in zip(*(v for _, v in good))], (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / len(x)


def check(rows, got):
    good, sums, cov = plain(rows)
    n = len(good)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(8, len(sums))
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = {}
    for i, v in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        for c in range(1, k + 1):
            r = by[i][c]
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            assert r["identity_error"] < 1e-9
            want = (np.array(v) - np.array(sums) / n) @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            sign = signs.setdefault(c, 1 if want * r["whitened"] > 0 else -1)
            assert r["whitened"] == pytest.approx(sign * want, abs=1e-7)


def test_query_on_whole_table(spark):
    rows = pq.read_table(f"{SF001}/embeddings.parquet").to_pylist()
    check([(r["vec_id"], r["embedding"]) for r in rows], QUERIES["op11_whitening"](spark, SF001).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [3e30, 0.0, 0.0])]
    rows += [rows[0], (7, [0.5, 0.5, 0.5])]  # a repeated row, and an id twice
    got = W.whiten(frame(spark, rows + odd).repartition(3)).collect()
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}
    _, sums, cov = plain(rows)
    n = len(rows)
    assert {r["n"] for r in got} == {n} and len(got) == 3 * n
    assert {r["explained"] for r in got if r["component"] == 1}.pop() == pytest.approx(np.linalg.eigvalsh(cov)[-1] / np.trace(cov))
    assert max(r["identity_error"] for r in got) < 1e-9


def test_empty_single_and_flat_tables(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = W.whiten(frame(spark, rows))
        assert got.columns == names and got.count() == 0
    got = W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (None, [3.0, 2.0])])).collect()  # one direction varies
    assert len(got) == 3 and {r["component"] for r in got} == {1} and {r["vec_id"] for r in got} == {1, 2, None}


def test_large_values_stay_exact(spark):
    rows = [(i, [1e5 * i + 0.25, 3e8 if i % 2 else -3e8]) for i in range(6)]
    got = {(r["vec_id"], r["component"]): r for r in W.whiten(frame(spark, rows)).collect()}
    good, sums, _ = plain(rows)
    for i, v in good:
        want = sum((6 * c - s) ** 2 for c, s in zip(v, sums))
        assert got[i, 1]["deviation"] == (want if want < 1 << 63 else None)


@pytest.mark.parametrize("values", [
    np.linspace(1, 40, 20),
    np.repeat([5.0, 3.0, 1.0], 6),  # equal eigenvalues
    1 + 1e-9 * np.arange(16),  # one cluster, closer than float32 can tell
    np.concatenate([1 + 1e-8 * np.arange(5), [1e-6, 1e-6 + 1e-13, 1e6]]),
])
def test_refinement_reaches_double_precision(values):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(values), dtype=np.longdouble) - 0.5 * (q.T @ q))
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = W.refined(a)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 2e-17 * np.abs(values).max() * len(values)
    assert np.abs(found - np.sort(values)[::-1].astype(np.longdouble)).max() < 1e-16 * np.abs(values).max()


def test_float32_start_alone_is_not_enough():
    rng = np.random.default_rng(9)
    m = rng.normal(size=(30, 30))
    a = m @ m.T
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    best = W.refined(a)[1].astype(float)
    ref = np.linalg.eigh(a)[1][:, ::-1]
    assert np.abs(np.abs(np.einsum("ij,ij->j", start[:, ::-1], ref)) - 1).max() > 1e-14 or np.abs(np.abs(start[:, ::-1]) - np.abs(ref)).max() > 1e-7
    assert np.abs(np.abs(best) - np.abs(ref)).max() < 1e-11
