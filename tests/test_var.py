"""VAR and least squares on triangular factors against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.operators import leastsq as L
from tidewise.operators import var as V


def _series(n, k, seed, offset=0.0):
    rng = np.random.default_rng(seed)
    y = np.zeros((n, k))
    for t in range(2, n):
        y[t] = 0.5 * y[t - 1] - 0.2 * y[t - 2][::-1] + rng.normal(size=k)
    return y + offset


def _frame(spark, y, by=None):
    names = [f"s{j}" for j in range(y.shape[1])]
    rows = [(*([by] if by is not None else []), t, *(None if np.isnan(v) else float(v) for v in r)) for t, r in enumerate(y)]
    return spark.createDataFrame(rows, ("g string, " if by is not None else "") + "t long, " + ", ".join(f"{c} double" for c in names)), names


def _plain(y, p):
    """OLS on centred columns, rows with a gap in them or their lags left out."""
    z = np.column_stack([y[p:], *[y[p - lag : len(y) - lag] for lag in range(1, p + 1)]])
    z = z[np.isfinite(z).all(axis=1)]
    c = z.mean(axis=0)
    k = y.shape[1]
    b = np.linalg.lstsq((z - c)[:, k:], (z - c)[:, :k], rcond=None)[0]
    return np.vstack([c[:k] - c[k:] @ b, b]), len(z)


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_coefficients_keep_their_digits_under_large_offsets(spark, offset):
    y = _series(700, 3, 1, offset)
    df, names = _frame(spark, y)
    want, _ = _plain(y, 2)
    got = V.fit(df, names, 2, ["t"], block_rows=64)
    np.testing.assert_allclose(got[1:], want[1:], atol=1e-9 if offset == 0 else 1e-6)
    x = np.column_stack([np.ones(698), y[1:-1], y[:-2]])
    ours, raw = x @ got - y[2:], x @ np.linalg.lstsq(x, y[2:], rcond=None)[0] - y[2:]
    assert (ours**2).sum() <= (raw**2).sum() * (1 + 1e-9)  # never worse than NumPy on the raw matrix


def test_gaps_ties_of_blocks_and_constant_columns(spark):
    y = _series(300, 2, 2)
    y[[40, 41, 150, 299], [0, 1, 1, 0]] = np.nan
    df, names = _frame(spark, y)
    for p in (1, 3):
        want, n = _plain(y, p)
        for block in (7, 300, 8192):
            np.testing.assert_allclose(V.fit(df, names, p, ["t"], block_rows=block), want, atol=1e-9)
        found = [tuple(r) for r in V.factors(df.withColumn("_t", F.col("t")), names, 3, "_t", block_rows=50).select("block", "q", "f").collect()]
        assert V.solve_order(found, 2, p)[1] == n  # every order from the factors of the largest
    flat = _series(50, 2, 3)
    flat[:, 1] = 0.1
    B = V.fit(_frame(spark, flat)[0], names, 1, ["t"], block_rows=8)
    np.testing.assert_allclose(B[:2, 0], _plain(flat[:, :1], 1)[0][:, 0], atol=1e-9)
    assert B[2, 0] == 0 and B[:, 1] == pytest.approx([0.1, 0, 0])


def test_empty_and_too_short_tables(spark):
    df, names = spark.createDataFrame([], "t long, s0 double"), ["s0"]
    assert np.isnan(V.fit(df, names, 2, ["t"])).all()
    assert V.search_orders(df, names, ["t"], max_lag=3, k=2).best is None
    one = spark.createDataFrame([(0, 1.0), (1, 4.0)], "t long, s0 double")
    assert V.fit(one, names, 1, ["t"])[:, 0] == pytest.approx([4.0, 0.0])


def test_merging_is_exact_in_any_grouping_and_order():
    z = np.random.default_rng(4).normal(size=(500, 4)) + [0, 1e6, -3, 1e3]
    parts = [L.factor(z[i : i + 37]) for i in range(0, 500, 37)]
    whole, _ = L.solved(L.factor(z), [0, 1, 2], [3])
    a = L.merged(parts)
    assert a.tobytes() == L.merged(parts[::-1]).tobytes() and a[0] == 500
    b = L.merged([L.merged(parts[:5]), L.merged(parts[5:])])
    for f in (a, b):
        np.testing.assert_allclose(L.solved(f, [0, 1, 2], [3])[0], whole, rtol=1e-8)
    np.testing.assert_allclose(L.solved(L.leading(a, 2), [0], [1])[0], L.solved(a, [0], [1])[0], rtol=1e-8)


def test_many_sets_of_series_one_of_them_hot(spark):
    sizes = {"hot": 900, "a": 40, "b": 7, "c": 2, "d": 1, None: 30}
    frames, data = [], {}
    for i, (g, n) in enumerate(sizes.items()):
        y = _series(n, 2, 10 + i, 5.0 * i)
        if g == "a":
            y[-1, 0] = np.nan
        data[g] = y
        f, names = _frame(spark, y, by=g or "null")
        frames.append(f.withColumn("g", F.lit(g).cast("string")))
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    df = df.withColumn("rank", F.lit(1))  # a column of the result's name in the input
    rows = V.fit_by(df, names, 1, ["t"], ["g"], block_rows=50).collect()
    assert {r["g"] for r in rows} == {"hot", "a", "b", "c", None}  # "d" has no complete row
    for g in ("hot", "a", "b", None):
        want, n = _plain(data[g], 1)
        got = {(r["regressor"], r["equation"]): r["coef"] for r in rows if r["g"] == g}
        B = np.array([[got[x, e] for e in names] for x in V.regressor_names(names, 1)])
        np.testing.assert_allclose(B, want, atol=1e-8)
        assert {(r["n_rows"], r["rank"]) for r in rows if r["g"] == g} == {(n, 3)}
    steps = V.forecast_by(df, names, 1, ["t"], ["g"], 4, block_rows=50).collect()
    assert len(steps) == 5 * 4
    for g in ("hot", None):
        want = V.recurse(_plain(data[g], 1)[0], data[g][-1:], 4)
        got = np.array([[r[c] for c in names] for r in sorted((r for r in steps if r["g"] == g), key=lambda r: r["step"])])
        np.testing.assert_allclose(got, want, atol=1e-8)
    assert all(r["s0"] is None and r["s1"] is None for r in steps if r["g"] == "a")  # its last row has a gap


def test_order_search_in_chunks_equals_one_chunk_and_refits(spark):
    y = _series(240, 2, 6)
    y[233, 1] = np.nan  # a test row
    df, names = _frame(spark, y)
    whole = V.search_orders(df, names, ["t"], max_lag=5, k=4)
    small = V.search_orders(df, names, ["t"], max_lag=5, k=4, block_rows=9)
    for (p, a), (q, b) in zip(whole.scores, small.scores):
        assert p == q and a == pytest.approx(b, rel=1e-9)
    scores = {p: m for p, m in whole.scores}
    assert whole.best == min(scores, key=lambda p: (scores[p], p)) == small.best
    np.testing.assert_allclose(whole.coef, _plain(y, whole.best)[0], atol=1e-9)


def test_state_of_a_chunk_is_a_power_of_the_companion_matrix():
    y = _series(200, 3, 8)
    B = _plain(y, 2)[0]
    z = np.concatenate([[1.0], y[-1], y[-2]])
    far = V.recurse(B, y[-2:], 57)
    for rows in (0, 1, 2, 31, 55):
        got = V._jump(B, z, rows)
        assert got[0] == 1 and np.allclose(got[1:4], far[rows - 1] if rows else y[-1], atol=1e-12)


def test_linear_regression_on_seven_features(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 7)) * [1, 10, 1e-3, 1e4, 1, 1, 1] + [0, 0, 0, 1e7, 5, 0, 0]
    y = x @ np.arange(1, 8) + 3 + rng.normal(size=500)
    rows = [tuple(map(float, r)) for r in np.column_stack([x, y])] + [(None,) * 7 + (1.0,)]
    names = [f"f{i}" for i in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"])).repartition(5)
    coef, n, rank = L.linear(df, names, "y")
    want = np.linalg.lstsq(np.column_stack([np.ones(500), x]), y, rcond=None)[0]
    assert (n, rank) == (500, 8)
    np.testing.assert_allclose(coef[1:], want[1:], rtol=1e-6)
    from tidewise.operators import models as M
    fit = M.regression_pipeline(names, "y", "linear", params={}).fit(df.dropna())
    pred = np.array([r[0] for r in fit.transform(df.dropna().orderBy("y")).select("prediction").collect()])
    full = np.column_stack([np.ones(500), x])[np.argsort(y)]
    np.testing.assert_allclose(pred, full @ want, atol=1e-4)


def test_var_and_trees_are_compared_on_the_same_steps(spark):
    from tidewise.operators import boost as B
    from tidewise.plans.q_models import compare_var_and_trees
    y = _series(200, 2, 12)
    df, names = _frame(spark, y)
    wide = df.select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("t").cast("int") * 6)).alias("bucket"), *names)
    got = {(r["model"], r["target"]): r for r in compare_var_and_trees(wide, names, "bucket", params=B.Params(trees=5, depth=2)).collect()}
    assert sorted(got) == [(m, t) for m in ("trees", "var") for t in names]
    train = y[:140]
    best = V.search_orders(_frame(spark, train)[0], names, ["t"], max_lag=10, k=5).best
    ahead = V.recurse(_plain(train, best)[0], train[-best:], 10)
    for j, t in enumerate(names):
        assert got["var", t]["rmse"] == pytest.approx(((ahead[:, j] - y[140:150, j]) ** 2).mean() ** 0.5, abs=1e-5)
        assert got["trees", t]["n_test"] == 10 and got["trees", t]["rmse"] > 0


def test_a_gap_before_a_test_block_leaves_the_orders_that_need_it_without_a_score(spark):
    y = _series(120, 1, 15)
    y[94] = np.nan  # the second last row before the test block from row 96 (k = 4: blocks of 24 rows)
    df, names = _frame(spark, y)
    got = V.search_orders(df, names, ["t"], max_lag=4, k=4)
    assert [m is None for _, m in got.scores] == [False, True, True] and got.best == 1
    y[95] = np.nan
    none = V.search_orders(_frame(spark, y)[0], names, ["t"], max_lag=4, k=4)
    assert none.best is None and none.coef is None and all(m is None for _, m in none.scores)
