"""Regression tests for the rules that differ from the reference."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewise.operators import clean as CL
from tidewise.operators import models as M
from tidewise.operators import outliers as O


def test_q3_coerce_target_only_keeps_feature_text(spark):
    from tidewise.plans.q_clean import polluted_named
    raw = polluted_named(spark, SF001)
    allc = CL.preprocess(raw)
    tgt = CL.preprocess(raw, CL.PreprocessSpec(coerce="target"))
    assert dict(allc.dtypes)["k"] == "double"
    assert dict(tgt.dtypes)["k"] == "string"  # production behaviour: the feature stays text


def test_q19_floor_can_be_disabled(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 21)], "x double")
    assert O.iqr_fences(df, ["x"], k=3.0).first()["lo"] == 0.0
    lo = O.iqr_fences(df, ["x"], k=3.0, floor=None).first()["lo"]
    q1, q3 = np.percentile(np.arange(1, 21.0), [25, 75])
    assert lo == pytest.approx(q1 - 3 * (q3 - q1)) and lo < 0


def test_q6_recursive_forecast_rules(spark):
    base = dt.datetime(2024, 1, 1)
    n = 60
    rows = [(base + dt.timedelta(minutes=10 * i), float(i % 7), float(i)) for i in range(n)]
    hist = spark.createDataFrame(rows, "ts timestamp_ntz, x double, value double")
    feats = lambda d: d.withColumn("minute_of_day", (F.hour("ts") * 60 + F.minute("ts")).cast("double"))
    train = feats(hist)
    model = M.regression_pipeline(["minute_of_day"], "value", "linear").fit(train)
    new = M.recursive_forecast(model, hist, 3, "value", "ts", feats)
    old = M.recursive_forecast(model, hist, 3, "value", "ts", feats, compat=True)
    a = [r["prediction"] for r in new.orderBy("step").collect()]
    b = [r["prediction"] for r in old.orderBy("step").collect()]
    ts = [r["ts"] for r in new.orderBy("step").collect()]
    assert ts == [base + dt.timedelta(minutes=10 * (n - 1 + s)) for s in (1, 2, 3)]
    # the value is linear in minute_of_day, so the correct rule predicts the
    # future row's own value and the compatibility rule lags one step behind
    assert a == pytest.approx([float(n), float(n + 1), float(n + 2)], abs=1e-6)
    assert b == pytest.approx([float(n - 1), float(n), float(n + 1)], abs=1e-6)


def test_recursive_forecast_per_series(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(g, base + dt.timedelta(minutes=10 * i), float(i + 100 * g)) for g in (0, 1) for i in range(40)]
    hist = spark.createDataFrame(rows, "g long, ts timestamp_ntz, value double")
    feats = lambda d: d.withColumn("minute_of_day", (F.hour("ts") * 60 + F.minute("ts")).cast("double")) \
        .withColumn("gx", F.col("g").cast("double"))
    model = M.regression_pipeline(["minute_of_day", "gx"], "value", "linear").fit(feats(hist))
    out = M.recursive_forecast(model, hist, 2, "value", "ts", feats, by=["g"]).orderBy("g", "step").collect()
    assert [(r["g"], r["step"]) for r in out] == [(0, 1), (0, 2), (1, 1), (1, 2)]
    # value = i + 100 g with i = minute / 10: the next stamps are i = 40, 41
    assert [r["prediction"] for r in out] == pytest.approx([40.0, 41.0, 140.0, 141.0], abs=1e-6)
