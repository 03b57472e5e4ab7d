"""Feature stages, metrics, VAR against NumPy."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidewise.operators import models as M
from tidewise.operators import var as V
from tidewise.operators.features import ExactImputer, ExactMinMaxScaler, PopStandardScaler


def test_scalers_constant_column_and_imputer(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 4.0, None), (2.0, 4.0, 10.0), (3.0, 4.0, 9.0), (4.0, 4.0, 20.0)], "a double, c double, m double")
    pipe = Pipeline(stages=[ExactImputer(inputCols=["m"]), PopStandardScaler(inputCols=["a", "c"])])
    model = pipe.fit(df)
    path = str(tmp_path / "pipe")
    model.write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df).collect()
    assert [r["c"] for r in out] == [0.0] * 4
    a = np.array([1.0, 2, 3, 4])
    assert [r["a"] for r in out] == pytest.approx(((a - a.mean()) / a.std()).tolist())
    assert out[0]["m"] == 10.0  # exact median of 9, 10, 20
    mm = ExactMinMaxScaler(inputCols=["a", "c"]).fit(df).transform(df).collect()
    assert [r["c"] for r in mm] == [0.0] * 4 and mm[-1]["a"] == 1.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.0), (None, 1.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    y, p = np.array([1.0, 2, 3]), np.array([1.5, 1, 3])
    assert r["n_test"] == 3
    assert r["mae"] == pytest.approx(np.abs(y - p).mean())
    assert r["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_var_gram_solve_matches_lstsq(spark):
    rng = np.random.default_rng(5)
    n, k, p = 300, 2, 2
    y = np.zeros((n, k))
    for t in range(2, n):
        y[t] = 0.5 * y[t - 1] - 0.2 * y[t - 2] + rng.normal(size=k)
    df = spark.createDataFrame([(t, float(y[t, 0]), float(y[t, 1])) for t in range(n)], "t0 long, a double, b double")
    B = V.fit(df, ["a", "b"], p, ["t0"])
    X = np.column_stack([np.ones(n - p)] + [y[p - L:n - L] for L in range(1, p + 1)])
    ref = np.linalg.lstsq(X, y[p:], rcond=None)[0]
    np.testing.assert_allclose(B, ref, atol=1e-8)
    fc = V.recurse(B, y[-p:], 3)
    assert fc.shape == (3, 2)


def test_hash_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = M.hash_split(df, "k").where("split = 'test'").count()
    b = M.hash_split(df, "k").where("split = 'test'").count()
    assert a == b and 120 < a < 280


def test_column_diff(spark):
    from tidewise.functions.text import column_diff
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "y int, z int")
    assert column_diff(a, b) == {"only_left": ["x"], "only_right": ["z"], "both": ["y"]}


def test_var_order_search_scores_all_orders_on_the_same_folds(spark):
    from tidewise.operators import var as V

    rng = np.random.default_rng(5)
    y, rows = np.zeros(2), []
    for i in range(90):
        y = np.array([[0.6, 0.2], [-0.3, 0.5]]) @ y + rng.normal(0, 0.1, 2) + 1.0
        rows.append((i, float(y[0]), float(y[1])))
    df = spark.createDataFrame(rows, "step long, a double, b double")
    got = {r["p"]: r["mean_mse"] for r in V.select_order(df, ["a", "b"], ["step"], max_lag=7, k=4).collect()}
    data = np.array([r[1:] for r in rows])

    def plain(p):
        size, out = len(data) // 5, []
        for i in range(4):
            start, end = len(data) - (4 - i) * size, len(data) - (3 - i) * size
            if start <= 3 * p:
                return None
            x = np.array([np.concatenate([[1.0], *[data[t - lag] for lag in range(1, p + 1)]]) for t in range(p, start)])
            coef = np.linalg.lstsq(x, data[p:start], rcond=None)[0]
            past = list(data[:start])
            for _ in range(start, end):
                past.append(np.concatenate([[1.0], *[past[-lag] for lag in range(1, p + 1)]]) @ coef)
            out.append(((data[start:end] - np.array(past[start:])) ** 2).mean())
        return float(np.mean(out))

    assert sorted(got) == list(range(1, 7))
    for p, mse in got.items():
        want = plain(p)
        assert (mse is None) == (want is None) and (mse is None or mse == pytest.approx(want, rel=1e-4)), p
    assert got[6] is None and got[1] is not None


def test_too_many_series_are_refused(spark):
    from tidewise.operators import var as V

    df = spark.range(30).selectExpr("id AS k", "timestamp_ntz '2024-01-01' AS ts", "1.0D AS v")
    with pytest.raises(ValueError, match="series"):
        V.bucket_means(df, "ts", "k", "v", "1 hour", max_series=20)


def test_model_queries_use_the_reference_budget(monkeypatch):
    from tidewise.plans import q_models as Q
    seen = {}
    monkeypatch.setattr(Q, "_fit_eval", lambda spark, sf, model, params: seen.setdefault(model, params) and (None, None))
    monkeypatch.setattr(Q.M, "regression_metrics", lambda *a: None)
    Q.q_rf_metrics(None, None)
    assert Q.q_gbt_metrics.__defaults__ == (M.BOOST_PRODUCTION,)
    p = M.BOOST_PRODUCTION
    assert (p.trees, p.rate, p.depth, p.min_child, p.subsample, p.colsample, p.gamma, p.lam, p.alpha) == (800, 0.05, 6, 3, 0.8, 0.8, 0.1, 1, 0.1)
    assert M.GBT_PRODUCTION["maxIter"] == 800
    assert (seen["rf"]["numTrees"], seen["rf"]["maxDepth"], seen["rf"]["featureSubsetStrategy"]) == (100, 30, "all")


def test_search_and_forecast_queries_use_all_draws_and_folds(spark, monkeypatch):
    from tests.conftest import SF001
    from tidewise.plans import q_models as Q
    calls = []
    used = []
    monkeypatch.setattr(Q.B, "search", lambda df, feats, y, order, cands, k=5, **kw: calls.append((cands, k)) or ("scores", {"value": "model"}))
    monkeypatch.setattr(Q.B, "forecast_series", lambda m, *a, **kw: used.append(m) or spark.range(1).selectExpr("id AS step", "id AS ts", "id AS prediction"))
    assert Q.q_random_search(spark, SF001) == "scores"
    Q.q_recursive_forecast(spark, SF001)
    assert used == [{"value": "model"}]  # the searched model forecasts
    want = [M.search_params(c) for c in M.draw_params(20, seed=1234)]
    assert calls == [(want, 5), (want, 5)] and all(100 <= c.trees < 1000 for c in want)
