"""Model, evaluation, forecasting and VAR queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boost as B
from ..operators import models as M
from ..operators import var as V
from ..operators.clean import drop_any_null
from ..operators.features import hf_features
from ..operators.leastsq import linear
from ..operators.ordered import with_ordinal
from ..session import cut_lineage
from .common import events, original_events
from .q_clean import clean_flow_df
from .registry import query

ORDER = ["ts", "event_id"]
_W = "OVER (ORDER BY ts, event_id)"


# ---------------------------------------------------------------- metrics on baselines

@query("regression_metrics",
       "SELECT round(avg(abs(value - p)), 6) AS mae, round(avg((value - p) * (value - p)), 6) AS mse, "
       "round(sqrt(avg((value - p) * (value - p))), 6) AS rmse, "
       "round(1 - sum((value - p) * (value - p)) / nullif(var_pop(value) * count(*), 0), 6) AS r2, count(*) AS n_test "
       f"FROM (SELECT value, lag(value) {_W} AS p FROM events) WHERE p IS NOT NULL AND value IS NOT NULL")
def q_regression_metrics(spark, sf):
    """J10 on a one-step persistence forecast of ``events.value``."""
    pr = M.naive_predictions(events(spark, sf).select("event_id", "ts", "value"), "value", ORDER)
    return M.regression_metrics(pr, "value", "pred_lag1", digits=6)


_TEST_CTE = (
    f"s AS (SELECT event_id, ts, value, lag(value) {_W} AS pred, row_number() {_W} - 1 AS o, count(*) OVER () AS n FROM events), "
    "t AS (SELECT *, o - (n - CAST(ceil(n * 0.3) AS BIGINT)) AS step FROM s WHERE o >= n - ceil(n * 0.3))"
)


@query("pred_vs_actual", f"WITH {_TEST_CTE} SELECT step, event_id, value AS y_true, pred AS y_pred FROM t")
def q_pred_vs_actual(spark, sf):
    """(step, y_true, y_pred) over the chronological test part."""
    from ..operators.ordered import time_split
    e = events(spark, sf).select("event_id", "ts", "value")
    pr = M.naive_predictions(e, "value", ORDER)
    sp = time_split(pr, 0.3, ORDER).where(F.col("split") == "test")
    return M.pred_vs_actual(sp, "value", "pred_lag1", "ordinal", key="event_id")


@query("forecast_alignment",
       f"WITH {_TEST_CTE}, f AS (SELECT avg(value) AS yhat FROM (SELECT value FROM s WHERE o < n - ceil(n * 0.3) ORDER BY o DESC LIMIT 6)), "
       "h AS (SELECT unnest(range(0, 10)) AS step) "
       "SELECT h.step, t.ts, t.value AS y_true, round(f.yhat, 6) AS y_pred FROM h, f JOIN t ON t.step = h.step")
def q_forecast_alignment(spark, sf):
    """A 10-step forecast (mean of the last 6 training values) joined to
    the first 10 test rows by step."""
    from ..operators.ordered import last_n, time_split
    e = events(spark, sf).select("event_id", "ts", "value")
    sp = time_split(e, 0.3, ORDER)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    level = last_n(train, 6, ORDER).agg(F.avg("value").alias("yhat"))
    fc = level.select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("step"), F.round("yhat", 6).alias("y_pred"))
    return M.align_forecast(test, fc, "ordinal", "ts", "value")


_CMP_SQL = (
    "WITH s AS (SELECT event_type, value, row_number() OVER w - 1 AS o, count(*) OVER (PARTITION BY event_type) AS n, "
    "lag(value) OVER w AS pred_lag1, CASE WHEN count(value) OVER w6 = 6 THEN avg(value) OVER w6 END AS pred_mean6 FROM events "
    "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id), "
    "w6 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)), "
    "t AS (SELECT * FROM s WHERE o >= n - ceil(n * 0.3) AND o < n - ceil(n * 0.3) + 10), "
    "l AS (SELECT 'naive_lag1' AS model, event_type AS target, value AS y, pred_lag1 AS yhat FROM t "
    "UNION ALL SELECT 'trailing_mean6', event_type, value, pred_mean6 FROM t) "
    "SELECT model, target, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, count(*) AS n_test FROM l "
    "WHERE yhat IS NOT NULL GROUP BY 1, 2"
)


@query("model_comparison", _CMP_SQL)
def q_model_comparison(spark, sf):
    """RMSE of two forecasters over the first 10 test rows of every
    series (one series per event type)."""
    e = events(spark, sf).select("event_id", "event_type", "ts", "value")
    od = with_ordinal(e, ORDER, by=["event_type"], name="o")
    n = od.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    pr = M.naive_predictions(od, "value", ORDER, by=["event_type"], mean_n=6).join(n, "event_type")
    start = F.col("n") - F.ceil(F.col("n") * 0.3)
    t = pr.where((F.col("o") >= start) & (F.col("o") < start + 10))
    long = t.select(F.lit("naive_lag1").alias("model"), F.col("event_type").alias("target"), F.col("value").alias("y"),
                    F.col("pred_lag1").alias("yhat")).unionByName(
        t.select(F.lit("trailing_mean6").alias("model"), F.col("event_type").alias("target"), F.col("value").alias("y"),
                 F.col("pred_mean6").alias("yhat")))
    return M.compare_models(long)


@query("hash_split",
       "SELECT event_id, CASE WHEN CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 "
       "THEN 'test' ELSE 'train' END AS split FROM events")
def q_hash_split(spark, sf):
    """Reproducible 80/20 shuffled split by key hash."""
    return M.hash_split(events(spark, sf).select("event_id"), "event_id", 20)


@query("linear_fit",
       "WITH o AS (SELECT value, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS DOUBLE) AS k FROM events) "
       "SELECT round(regr_slope(value, k), 6) AS slope, round(regr_intercept(value, k), 6) AS intercept, "
       "round(regr_r2(value, k), 6) AS r2, CAST(regr_count(value, k) AS BIGINT) AS n FROM o")
def q_linear_fit(spark, sf):
    """J8 with one feature: OLS slope / intercept / R2 as aggregates."""
    return M.ols_1d(original_events(spark, sf), "value", "k")


# ---------------------------------------------------------------- MLlib models (rows-only checks)

FEATS = ["k", "hour", "dayofweek", "month", "value_lag1", "value_lag24", "value_lag168"]


def _prep(spark, sf):
    from ..operators.clean import preprocess
    from .q_clean import polluted_named
    return preprocess(polluted_named(spark, sf))


def _fit_eval(spark, sf, model, params, impute=(), scale=()):
    d = cut_lineage(_prep(spark, sf))
    tr, te = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    pm = M.regression_pipeline(FEATS, "value", model, impute=impute, scale=scale, params=params).fit(tr)
    return pm, pm.transform(te)


@query("pipeline_predict")
def q_pipeline_predict(spark, sf):
    """J5 + J9: imputer + scaler + linear model fitted on the train part of
    the preprocessed table, scored on the test part."""
    _, pred = _fit_eval(spark, sf, "linear", {}, impute=FEATS, scale=FEATS)
    return pred.select("event_id", "ordinal", F.col("value").alias("y_true"), F.col("prediction").alias("y_pred"))


@query("linear_metrics")
def q_linear_metrics(spark, sf):
    """J8 + J10: OLS on seven features, test metrics."""
    _, pred = _fit_eval(spark, sf, "linear", {})
    return M.regression_metrics(pred, "value", "prediction")


@query("gbt_metrics")
def q_gbt_metrics(spark, sf, params=M.BOOST_PRODUCTION):
    """J6 + J10: boosted trees with the production settings (800 trees, leaf
    penalties, columns per tree), test metrics."""
    d = cut_lineage(_prep(spark, sf))
    model = B.fit_booster(d.where(F.col("split") == "train"), FEATS, "value", "ordinal", params)
    return M.regression_metrics(model.transform(d.where(F.col("split") == "test")), "value", "prediction")


_STUMP_SQL = """
WITH e AS (SELECT value, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k FROM events WHERE value IS NOT NULL),
b AS (SELECT avg(value) AS base, count(*) AS n FROM e),
g AS (SELECT k, sum(base - value) AS g, count(*) AS n FROM e, b GROUP BY k),
c AS (SELECT k, sum(g) OVER (ORDER BY k) AS gl, sum(n) OVER (ORDER BY k) AS nl, sum(g) OVER () AS gt, sum(n) OVER () AS nt FROM g),
s AS (SELECT *, greatest(abs(gl) - 0.1, 0) ^ 2 / (nl + 1) + greatest(abs(gt - gl) - 0.1, 0) ^ 2 / (nt - nl + 1) - greatest(abs(gt) - 0.1, 0) ^ 2 / (nt + 1) AS gain
      FROM c WHERE nl >= 3 AND nt - nl >= 3),
w AS (SELECT * FROM s ORDER BY gain DESC, k LIMIT 1)
SELECT round(base - sign(gl) * greatest(abs(gl) - 0.1, 0) / (nl + 1), 6) AS prediction, CAST(nl AS BIGINT) AS n FROM w, b
UNION ALL SELECT round(base - sign(gt - gl) * greatest(abs(gt - gl) - 0.1, 0) / (nt - nl + 1), 6), CAST(nt - nl AS BIGINT) FROM w, b
"""


@query("boost_stump", _STUMP_SQL)
def q_boost_stump(spark, sf):
    """One tree of one level with leaf penalties: its two predictions and
    how many rows have each."""
    d = original_events(spark, sf).where("value IS NOT NULL").select("event_id", "value", "k")
    one = B.Params(trees=1, depth=1, rate=1.0, min_child=3.0, lam=1.0, alpha=0.1)
    rows = B.fit_booster(d, ["k"], "value", "event_id", one).transform(d)
    return rows.groupBy(F.round("prediction", 6).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("rf_metrics")
def q_rf_metrics(spark, sf, params=M.RF_REFERENCE):
    """J7 + J10: random forest as in the reference (100 trees, seed 42, all
    features at every split, grown to MLlib's limit of 30 levels)."""
    _, pred = _fit_eval(spark, sf, "rf", dict(params))
    return M.regression_metrics(pred, "value", "prediction")


def _candidates(draws):
    return [M.search_params(c) for c in M.draw_params(draws, seed=1234)]


@query("random_search")
def q_random_search(spark, sf, draws=M.SEARCH_DRAWS, k=M.SEARCH_FOLDS):
    """20 seeded draws of the notebook's space, each with its own number
    of trees, scored by 5 expanding folds."""
    d = cut_lineage(_prep(spark, sf).where(F.col("split") == "train"))
    return B.search(d, FEATS, ["value"], ["ordinal"], _candidates(draws), k=k)[0]


_HF = ["k", "hora", "minuto", "dia_de_semana", "dia_del_ano", "lag_value_1_hora", "lag_value_24_horas",
       "rolling_mean_value_1_hora", "rolling_mean_value_24_horas"]


@query("recursive_forecast")
def q_recursive_forecast(spark, sf, draws=M.SEARCH_DRAWS, k=M.SEARCH_FOLDS):
    """10-step recursive forecast of the cleaned series with the best
    boosted tree model of the random search (20 draws, 5 folds) on the
    high-frequency features (context 200 rows)."""
    cl = drop_any_null(clean_flow_df(spark, sf).select("event_id", "ts", "value", "k"))
    feats = cut_lineage(hf_features(cl, "value", "ts", ORDER))
    _, models = B.search(feats, _HF, ["value"], ORDER, _candidates(draws), k=k)
    return B.forecast_series(models, cl, 10, "ts", ORDER).select("step", "ts", "prediction")


# ---------------------------------------------------------------- VAR

def _var_input(spark, sf):
    wide, keys = V.bucket_means(events(spark, sf), "ts", "event_type", "value", "6 hours")
    return wide, keys


def _lagged_sql(p):
    ls = ", ".join(str(i) for i in range(1, p + 1))
    return (
        "g AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, event_type AS s, avg(value) AS v FROM events GROUP BY 1, 2), "
        "gt AS (SELECT date_diff('hour', (SELECT min(bucket) FROM g), bucket) // 6 AS t, s, v FROM g), "
        "nn AS (SELECT max(t) + 1 AS n FROM gt), "
        f"lg AS (SELECT t + l AS tt, 'L' || l || '.' || s AS name, v FROM gt, (SELECT unnest([{ls}]) AS l) "
        "UNION ALL SELECT t, 'const', 1.0 FROM (SELECT DISTINCT t FROM gt)), "
        f"lx AS (SELECT lg.* FROM lg, nn WHERE tt >= {p} AND tt < n)"
    )


_VAR_P = 2


@query("var_gram",
       f"WITH {_lagged_sql(_VAR_P)} "
       "SELECT 'XtX' AS mat, a.name AS row, b.name AS col, round(sum(a.v * b.v), 6) AS value FROM lx a JOIN lx b ON a.tt = b.tt GROUP BY 1, 2, 3 "
       "UNION ALL SELECT 'XtY', a.name, y.s, round(sum(a.v * y.v), 6) FROM lx a JOIN gt y ON a.tt = y.t GROUP BY 1, 2, 3")
def q_var_gram(spark, sf):
    """X'X and X'Y of a VAR(2) on 6-hour means of ``value`` per event
    type (5 series), one aggregate of products."""
    wide, keys = _var_input(spark, sf)
    g = V.gram(V.lagged_design(wide, keys, _VAR_P, ["bucket"]), keys, _VAR_P)
    return g.where(F.col("fold") == -1).select("mat", "row", "col", F.round("value", 6).alias("value"))


@query("var_coefficients")
def q_var_coefficients(spark, sf):
    """VAR(2) coefficients (regressor x equation) from the Gram solve."""
    wide, keys = _var_input(spark, sf)
    coef = V.fit(wide, keys, _VAR_P, ["bucket"])
    return V.coefficients_frame(spark, coef, keys, _VAR_P)


@query("var_select")
def q_var_select(spark, sf):
    """VAR order search 1..9 over 5 expanding folds (whole test folds
    forecast recursively), mean fold MSE and its square root."""
    wide, keys = _var_input(spark, sf)
    return V.select_order(wide, keys, ["bucket"], max_lag=10, k=5)


@query("var_forecast")
def q_var_forecast(spark, sf):
    """10-step VAR(2) forecast after the last bucket, on a time spine."""
    wide, keys = _var_input(spark, sf)
    coef = V.fit(wide, keys, _VAR_P, ["bucket"])
    fc = V.forecast(wide, coef, keys, ["bucket"], 10)
    last = wide.agg(F.max("bucket").alias("_b"))
    rows = [(i, *map(float, fc[i])) for i in range(fc.shape[0])]
    f = spark.createDataFrame(rows, "step int, " + ", ".join(f"`{k}` double" for k in keys))
    return f.crossJoin(last).select(
        "step", (F.col("_b") + F.make_dt_interval(F.lit(0), (F.col("step") + 1) * 6)).alias("bucket"), *[F.col(f"`{k}`") for k in keys])


@query("regression_metrics_by_type",
       "SELECT event_type, round(avg(abs(value - p)), 6) AS mae, round(avg((value - p) * (value - p)), 6) AS mse, "
       "round(sqrt(avg((value - p) * (value - p))), 6) AS rmse, "
       "round(1 - sum((value - p) * (value - p)) / nullif(var_pop(value) * count(*), 0), 6) AS r2, count(*) AS n_test "
       "FROM (SELECT event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM events) "
       "WHERE p IS NOT NULL AND value IS NOT NULL GROUP BY event_type")
def q_regression_metrics_by_type(spark, sf):
    """J10 per series: persistence-forecast metrics of every event type."""
    pr = M.naive_predictions(events(spark, sf).select("event_id", "event_type", "ts", "value"), "value", ORDER, by=["event_type"])
    return M.regression_metrics(pr, "value", "pred_lag1", by=["event_type"], digits=6)


# ---------------------------------------------------------------- VAR of many sets, order search, comparison

_BY_USER = (
    "o AS (SELECT *, row_number() OVER w AS rn, lag(value) OVER w AS x FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
    "u AS (SELECT user_id, CASE WHEN max(x) > min(x) THEN regr_slope(value, x) ELSE 0 END AS b, avg(value) AS my, avg(x) AS mx, "
    "count(*) AS n_rows, CASE WHEN max(x) > min(x) THEN 2 ELSE 1 END AS rank FROM o WHERE x IS NOT NULL AND value IS NOT NULL GROUP BY user_id)"
)


@query("var_coefficients_by",
       f"WITH {_BY_USER} SELECT user_id, 'const' AS regressor, 'value' AS equation, round(my - b * mx, 4) AS coef, n_rows, rank FROM u "
       "UNION ALL SELECT user_id, 'L1.value', 'value', round(b, 4), n_rows, rank FROM u")
def q_var_coefficients_by(spark, sf):
    """J12 for many sets of series: an autoregression of order 1 for every user."""
    e = events(spark, sf).select("user_id", "ts", "event_id", "value")
    got = V.fit_by(e, ["value"], 1, ORDER, ["user_id"])
    return got.withColumn("coef", F.round("coef", 4))


@query("var_forecast_by",
       f"WITH {_BY_USER}, l AS (SELECT user_id, my - b * mx AS a, b, (SELECT last(value ORDER BY rn) FROM o WHERE o.user_id IS NOT DISTINCT FROM u.user_id) AS y FROM u), "
       "f AS (SELECT user_id, a + b * y AS f1, a + b * (a + b * y) AS f2, a + b * (a + b * (a + b * y)) AS f3 FROM l) "
       "SELECT user_id, 1 AS step, round(f1, 4) AS value FROM f UNION ALL SELECT user_id, 2, round(f2, 4) FROM f UNION ALL SELECT user_id, 3, round(f3, 4) FROM f")
def q_var_forecast_by(spark, sf):
    """J14 for many sets of series: three steps after every user's last event."""
    e = events(spark, sf).select("user_id", "ts", "event_id", "value")
    got = V.forecast_by(e, ["value"], 1, ORDER, ["user_id"], 3)
    return got.withColumn("value", F.round("value", 4))


_ORDER_ONE_SQL = """
WITH o AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS t, value AS y, lag(value) OVER (ORDER BY ts, event_id) AS x FROM events),
n AS (SELECT count(*) AS n, count(*) // 6 AS size FROM events),
f AS (SELECT i, n - (5 - i) * size AS s, n - (4 - i) * size AS e FROM n, (SELECT unnest(range(5)) AS i)),
c AS (SELECT i, s, e, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(CASE WHEN t = s - 1 THEN y END) AS y0 FROM f JOIN o ON t >= 1 AND t < s GROUP BY i, s, e),
m AS (SELECT i, avg((y - (a / (1 - b) + b ^ (t - s + 1) * (y0 - a / (1 - b)))) ^ 2) AS mse FROM c JOIN o ON t >= s AND t < e GROUP BY i)
SELECT 1 AS p, round(avg(mse), 6) AS mean_mse, round(sqrt(avg(mse)), 6) AS rmse FROM m
"""


@query("var_order_one", _ORDER_ONE_SQL)
def q_var_order_one(spark, sf):
    """J13 on one series of all events, order 1 only: its score over five
    expanding folds (closed form: a geometric approach to the mean)."""
    e = events(spark, sf).select("ts", "event_id", "value")
    got = V.select_order(e, ["value"], ORDER, max_lag=2, k=5)
    return got.select("p", F.round("mean_mse", 6).alias("mean_mse"), F.round("rmse", 6).alias("rmse"))


@query("linear_fit_two",
       "WITH d AS (SELECT value AS y, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS DOUBLE) AS x1, CAST(hour(ts) AS DOUBLE) AS x2 FROM events), "
       "s AS (SELECT count(*) AS n, covar_pop(x1, x1) AS c11, covar_pop(x2, x2) AS c22, covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, "
       "avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL), "
       "b AS (SELECT *, (c1 * c22 - c2 * c12) / (c11 * c22 - c12 * c12) AS b1, (c2 * c11 - c1 * c12) / (c11 * c22 - c12 * c12) AS b2 FROM s) "
       "SELECT round(my - b1 * m1 - b2 * m2, 6) AS const, round(b1, 6) AS k, round(b2, 6) AS hour, n FROM b")
def q_linear_fit_two(spark, sf):
    """J8 with two features (Cramer's rule in SQL)."""
    d = original_events(spark, sf).withColumn("hour", F.hour("ts"))
    coef, n, _ = linear(d, ["k", "hour"], "value")
    return spark.createDataFrame([(*[round(float(c), 6) for c in coef], n)], "const double, k double, hour double, n long")


@query("var_best_forecast")
def q_var_best_forecast(spark, sf):
    """J13 + J14: search the order, fit the best one again on all rows and
    forecast ten buckets with it (no rows if no order has a score)."""
    wide, keys = _var_input(spark, sf)
    got = V.search_orders(wide, keys, ["bucket"], max_lag=10, k=5)
    fc = V.forecast(wide, got.coef, keys, ["bucket"], 10) if got.best else []
    rows = [(got.best, i + 1, *map(float, r)) for i, r in enumerate(fc)]
    return spark.createDataFrame(rows, "p int, step int, " + ", ".join(f"`{k}` double" for k in keys))


def compare_var_and_trees(wide, keys, ts, steps=10, test_size=0.3, minutes=360, params=M.BOOST_PRODUCTION):
    """(model, target, rmse, n_test) of the first ``steps`` test rows:
    the best VAR of the training rows against boosted trees for each series,
    both forecasting recursively from the training rows alone.  The trees see
    the calendar, the values 1 and 24 rows back and the means of 1 and 24 rows."""
    from ..operators.ordered import time_split
    sp = cut_lineage(time_split(wide, test_size, [ts], ordinal="_o"))
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    got = V.search_orders(train, keys, [ts], max_lag=10, k=5)
    spark = wide.sparkSession
    said = []
    if got.best:
        fc = V.forecast(train, got.coef, keys, [ts], steps)
        said = [("var", k, i + 1, float(fc[i, j])) for i in range(steps) for j, k in enumerate(keys)]
    own = "model string, target string, step int, yhat double"
    guesses = spark.createDataFrame(said, own)
    models = {}
    for k in keys:
        rows = cut_lineage(hf_features(train.select("_o", ts, F.col(f"`{k}`").alias(k)), k, ts, [ts], steps_per_hour=1).where(F.col(f"`{k}`").isNotNull()))
        names = ["hora", "minuto", "dia_de_semana", "dia_del_ano", f"lag_{k}_1_hora", f"lag_{k}_24_horas", f"rolling_mean_{k}_1_hora", f"rolling_mean_{k}_24_horas"]
        models[k] = B.fit_booster(rows, names, k, "_o", params)
    trees = B.forecast_series(models, train, steps, ts, [ts], context=24, minutes=minutes, features=lambda t: B.hf_row(t, 1)).select(F.lit("trees").alias("model"), "target", "step", F.col("prediction").alias("yhat"))
    first = test.agg(F.min("_o")).first()[0]
    known = test.where(F.col("_o") < (first or 0) + steps).select(
        (F.col("_o") - F.lit(first or 0) + 1).cast("int").alias("step"), F.explode(F.create_map(*[x for k in keys for x in (F.lit(k), F.col(f"`{k}`"))])).alias("target", "y"))
    return M.compare_models(guesses.unionByName(trees).join(known, ["target", "step"]))


@query("model_comparison_var_trees")
def q_model_comparison_var_trees(spark, sf):
    """VAR against boosted trees (800 each) on six-hour means per event type."""
    wide, keys = _var_input(spark, sf)
    return compare_var_and_trees(wide, keys, "bucket")
