"""Models, evaluation and forecasting.

Metrics are plain aggregates (one pass, map-side combined).  Model fits use
``pyspark.ml`` or, for boosted trees with all settings, searches and
forecasts, ``boost``.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage
from .boost import Params
from .features import ExactImputer, PopStandardScaler
from .forest import Forest
from .ordered import DEFAULT_BLOCK_ROWS, lag_exprs, last_n, trailing_mean_expr, windowed


def _c(n: str) -> Column:
    return F.col(qident(n))


# ---------------------------------------------------------------- metrics

def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Mae, mse, rmse, r2 (= 1 - SSE/SST, NULL when SST = 0), n_test.

    Rows where either side is NULL are skipped.  SST is ``n * var_pop(y)``,
    which Spark merges stably across tasks.
    """
    d = df.where(_c(y).isNotNull() & _c(yhat).isNotNull())
    e = _c(y) - _c(yhat)
    g = d.groupBy(*by) if by else d
    out = g.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(_c(y)) * F.count(F.lit(1))).alias("_sst"),
        F.count(F.lit(1)).alias("n_test"),
    )
    out = out.withColumn("rmse", F.sqrt("mse")).withColumn(
        "r2", 1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0))
    ).drop("_sse", "_sst")
    cols = [*by, "mae", "mse", "rmse", "r2", "n_test"]
    out = out.select(*cols)
    if digits is not None:
        out = out.select(*by, *[F.round(c, digits).alias(c) for c in ("mae", "mse", "rmse", "r2")], "n_test")
    return out


def metrics_record(metrics: DataFrame, run_id: str) -> DataFrame:
    """A10 row shape: ``struct<run_id, metrics struct<mae, mse, rmse, r2, n_test>>``."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.struct("mae", "mse", "rmse", "r2", F.col("n_test").cast("int").alias("n_test")).alias("metrics"),
    )


# ---------------------------------------------------------------- baselines

def naive_predictions(df: DataFrame, target: str, order: Sequence[str], by: Sequence[str] = (), mean_n: int = 6,
                      block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One-step baselines used as exactly reproducible "models": the
    previous value (``pred_lag1``) and the trailing mean of ``mean_n`` rows
    (``pred_mean{n}``)."""
    exprs = dict(lag_exprs(target, [1], ["pred_lag1"]))
    exprs[f"pred_mean{mean_n}"] = trailing_mean_expr(target, mean_n)
    return windowed(df, exprs, order, by, before=mean_n, block_rows=block_rows)


# ---------------------------------------------------------------- splits

def hash_split(df: DataFrame, key: str, test_pct: int = 20, flag: str = "split") -> DataFrame:
    """Reproducible shuffled split by a hash of the key (MD5, first 32
    bits): ``test`` when it falls in the first ``test_pct`` of 100 buckets."""
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(flag, F.when(h % 100 < test_pct, "test").otherwise("train"))


def fold_frames(df: DataFrame, ordinal: str, n: int, k: int) -> list[tuple[DataFrame, DataFrame]]:
    """E8 as (train, test) frames: train = all rows before the test block."""
    t = n // (k + 1)
    out = []
    for i in range(k):
        s, e = n - (k - i) * t, n - (k - i - 1) * t
        out.append((df.where(_c(ordinal) < s), df.where((_c(ordinal) >= s) & (_c(ordinal) < e))))
    return out


# ---------------------------------------------------------------- pipelines

def regression_pipeline(features: Sequence[str], label: str, model: str = "linear", impute: Sequence[str] = (),
                        scale: Sequence[str] = (), params: dict | None = None) -> Pipeline:
    """J4 + J5: imputer and scaler on listed columns (others pass through),
    vector assembly in the remembered feature order, then the model."""
    params = dict(params or {})
    stages = []
    if impute:
        stages.append(ExactImputer(inputCols=list(impute)))
    if scale:
        stages.append(PopStandardScaler(inputCols=list(scale)))
    stages.append(VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"))
    if model == "linear":
        est = LinearRegression(featuresCol="features", labelCol=label, solver="normal", **params)
    elif model == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol=label, lossType="squared", **params)
    elif model == "rf":
        est = (Forest if Forest.takes(params) else RandomForestRegressor)(featuresCol="features", labelCol=label, **params)
    else:
        raise ValueError(f"unknown model {model!r}")
    stages.append(est)
    return Pipeline(stages=stages)


# The production boosted-tree settings, mapped to MLlib names
# (800 trees, learning rate 0.05, depth 6, min child 3, subsample 0.8,
# column sample 0.8, gamma 0.1, seed 42).  L1/L2 leaf penalties have no
# MLlib counterpart; column sampling is per node in MLlib.
GBT_PRODUCTION = dict(maxIter=800, stepSize=0.05, maxDepth=6, minInstancesPerNode=3, subsamplingRate=0.8,
                      featureSubsetStrategy="0.8", minInfoGain=0.1, seed=42)

# The same settings with the leaf penalties (lambda 1, alpha 0.1) and columns
# drawn once a tree.
BOOST_PRODUCTION = Params(trees=800, rate=0.05, depth=6, min_child=3.0, subsample=0.8, colsample=0.8, gamma=0.1, lam=1.0, alpha=0.1, seed=42)

# The reference's forest: 100 trees, every feature at every split, no depth
# limit (30 levels are MLlib's limit), seed 42.
RF_REFERENCE = dict(numTrees=100, maxDepth=30, featureSubsetStrategy="all", seed=42)

# The reference's random search: 20 draws, 5 expanding folds.
SEARCH_DRAWS, SEARCH_FOLDS = 20, 5


def save_model(model: PipelineModel, path: str) -> None:
    """The whole fitted pipeline (keeps feature order and transforms)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- search

def draw_params(n_iter: int, seed: int = 1234) -> list[dict]:
    """Seeded draws of the notebook's search space: trees in [100, 1000),
    depth in [3, 10), learning rate U[0.01, 0.21), row and column sampling
    U[0.6, 1.0)."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n_iter):
        out.append(dict(
            maxIter=rnd.randrange(100, 1000), maxDepth=rnd.randrange(3, 10), stepSize=rnd.uniform(0.01, 0.21),
            subsamplingRate=rnd.uniform(0.6, 1.0), featureSubsetStrategy=str(round(rnd.uniform(0.6, 1.0), 3)),
        ))
    return out


def search_params(draw: dict, seed: int = 42) -> Params:
    """A draw as the settings of ``boost``; what the notebook leaves open has the usual defaults (lambda 1, alpha and gamma 0)."""
    return Params(trees=draw["maxIter"], depth=draw["maxDepth"], rate=draw["stepSize"], subsample=draw["subsamplingRate"],
                  colsample=float(draw["featureSubsetStrategy"]), seed=seed)


# ---------------------------------------------------------------- recursive forecast

def recursive_forecast(model: PipelineModel, history: DataFrame, steps: int, target: str, ts: str,
                       features_fn: Callable[[DataFrame], DataFrame], by: Sequence[str] = (), context: int = 200,
                       minutes: int = 10, compat: bool = False, order: Sequence[str] | None = None) -> DataFrame:
    """``steps`` one-step predictions fed back as history, per series.

    Each series keeps only its last ``context`` rows (bounded state).  By
    default the future row (time + ``minutes``, other columns carried
    forward, target unknown) is appended first and its own features are
    used; ``compat=True`` predicts from the last observed row's features
    (the reference's off-by-one).  ``order`` (default ``[ts]``) should end with
    a tiebreak where times repeat.  Any Spark feature function and model will
    do, at some jobs a step; ``boost.forecast_series`` needs one pass.
    Returns ``(by..., step, ts, prediction)``.
    """
    by = list(by)
    cols = history.columns
    # the context table holds <= ``context`` rows per series, so windows over
    # it are small; the history itself is reduced with a partial top-k
    order = list(order or [ts])
    last_first = [F.col(qident(o)).desc() for o in order]
    w_last = Window.partitionBy(*by).orderBy(*last_first) if by else Window.orderBy(*last_first)
    ctx = cut_lineage(last_n(history, context, order, by))
    preds = []
    for step in range(steps):
        last = ctx.withColumn("_rn", F.row_number().over(w_last)).where(F.col("_rn") == 1).drop("_rn")
        nxt = last.withColumn(ts, F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)))
        if compat:
            feats = features_fn(ctx)
            row = feats.withColumn("_rn", F.row_number().over(w_last)).where(F.col("_rn") == 1).drop("_rn")
            p = model.transform(row).select(*by, F.col("prediction"))
            new = nxt.drop(target).join(p, by, "inner") if by else nxt.drop(target).crossJoin(p)
            new = new.withColumnRenamed("prediction", target)
        else:
            pending = ctx.unionByName(nxt.withColumn(target, F.lit(None).cast("double")))
            feats = features_fn(pending)
            row = feats.join(nxt.select(*by, ts), [*by, ts], "left_semi")
            p = model.transform(row).select(*by, F.col("prediction"))
            new = nxt.drop(target).join(p, by, "inner") if by else nxt.drop(target).crossJoin(p)
            new = new.withColumnRenamed("prediction", target)
        new = new.select(*cols)
        preds.append(new.select(*by, F.lit(step + 1).alias("step"), ts, F.col(target).alias("prediction")))
        ctx = ctx.unionByName(new)
        ctx = cut_lineage(ctx.withColumn("_rn", F.row_number().over(w_last)).where(F.col("_rn") <= context).drop("_rn"))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- reports on predictions

def pred_vs_actual(df: DataFrame, y: str, yhat: str, ordinal: str, key: str | None = None) -> DataFrame:
    """``(step, [key], y_true, y_pred)``; step counts from the first row
    of ``df`` by ``ordinal`` (one-row minimum, applied as a literal)."""
    first = df.agg(F.min(_c(ordinal))).first()[0]
    first = 0 if first is None else first
    cols = [(_c(ordinal) - F.lit(first)).alias("step")]
    if key:
        cols.append(_c(key))
    return df.select(*cols, _c(y).alias("y_true"), _c(yhat).alias("y_pred"))


def align_forecast(actual: DataFrame, forecast: DataFrame, ordinal: str, ts: str, y: str) -> DataFrame:
    """The first ``h`` actual rows (by ``ordinal``) matched to the
    forecast's ``step`` 0..h-1: ``(step, ts, y_true, y_pred)``."""
    h = forecast.agg(F.max("step")).first()[0]
    first = actual.agg(F.min(_c(ordinal))).first()[0]
    if h is None or first is None:
        return forecast.select("step", F.lit(None).alias(ts), F.lit(None).cast("double").alias("y_true"), "y_pred").where("false")
    act = actual.where(_c(ordinal) <= first + h).select((_c(ordinal) - F.lit(first)).cast("bigint").alias("step"), _c(ts), _c(y).alias("y_true"))
    return forecast.select(F.col("step").cast("bigint").alias("step"), "y_pred").join(act, "step").select("step", ts, "y_true", "y_pred")


def compare_models(long: DataFrame, model: str = "model", target: str = "target", y: str = "y", yhat: str = "yhat",
                   digits: int | None = 6) -> DataFrame:
    """RMSE (and n) per (model, target) from long predictions."""
    m = regression_metrics(long, y, yhat, by=[model, target])
    r = F.round("rmse", digits) if digits is not None else F.col("rmse")
    return m.select(model, target, r.alias("rmse"), "n_test")


def ols_1d(df: DataFrame, y: str, x: str, digits: int | None = 6) -> DataFrame:
    """J8 with one feature: slope, intercept, R2 and n as aggregates."""
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return df.agg(r(F.regr_slope(_c(y), _c(x))).alias("slope"), r(F.regr_intercept(_c(y), _c(x))).alias("intercept"),
                  r(F.regr_r2(_c(y), _c(x))).alias("r2"), F.regr_count(_c(y), _c(x)).alias("n"))
