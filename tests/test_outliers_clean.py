"""Outlier handlers and cleaning steps on literal frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.operators import clean as CL
from tidewise.operators import outliers as O


def test_upper_outliers_to_median(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(i, v, 5.0) for i, v in enumerate(vals)], "i int, x double, c double")
    out, counts = O.replace_upper_outliers(df, ["x", "c"], 2.0)
    got = [r["x"] for r in out.orderBy("i").collect()]
    s = np.array([1, 2, 3, 4, 100.0])
    q1, q3 = np.percentile(s, [25, 75])
    assert 100.0 > q3 + 2 * (q3 - q1)
    assert got == [1.0, 2.0, 3.0, 4.0, float(np.median(s)), None]
    cnt = {r["col_name"]: r["n_replaced"] for r in counts.collect()}
    assert cnt == {"x": 1, "c": 0}  # constant column: IQR 0, left alone


def test_fences_floor_and_null(spark):
    ref = spark.createDataFrame([(float(v),) for v in range(1, 21)], "x double")
    f = O.iqr_fences(ref, ["x"], k=3.0).first()
    assert f["lo"] == 0.0  # q1 - 3 IQR < 0 is floored
    df = spark.createDataFrame([(-1.0,), (10.0,), (200.0,), (None,)], "x double")
    got = [r["x"] for r in O.apply_fences(df, O.iqr_fences(ref, ["x"]), ["x"], "null").collect()]
    assert got == [None, 10.0, None, None]


def test_handle_outliers_modes(spark):
    vals = [10.0, 11.0, 12.0, 11.0, 10.0, 12.0, 11.0, 95.0]
    df = spark.createDataFrame([(i, v, float(i)) for i, v in enumerate(vals)], "i int, x double, y double")
    assert O.handle_outliers(df, ["x"], "IQR", "drop").count() == 7
    rep = {r["i"]: r["x"] for r in O.handle_outliers(df, ["x"], "IQR", "replace", "mode").collect()}
    assert rep[7] == 11.0
    rep = {r["i"]: r["x"] for r in O.handle_outliers(df, ["x"], "IQR", "replace", "mean").collect()}
    assert rep[7] == pytest.approx(np.mean(vals))
    seq = O.handle_outliers(df, ["x", "y"], "IQR", "drop", sequential=True).count()
    assert seq == 7


def test_zscore_constant_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r["x_z"] for r in O.zscore(df, "x").collect()] == [None, None]


def test_sparse_null_row_drop(spark):
    rows = [(i, None if i == 0 else 1.0, None if i % 2 else 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    # a: 2.5 % null (< 5 -> subset), b: 50 % null (left alone)
    out = CL.drop_sparse_nulls(df, 5.0)
    assert out.count() == 39 and out.where("b IS NULL").count() == 20


def test_row_nulls_and_nonfinite(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (math.inf, 1.0), (2.0, 3.0)], "a double, b double")
    assert CL.drop_rows_min_nulls(df, ["a", "b"], 2).count() == 3
    assert CL.drop_nonfinite(df, ["a"]).count() == 2


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert CL.drop_empty_columns(df).columns == ["a"]


def test_clean_is_idempotent_on_its_output(spark):
    from tests.conftest import SF001
    from tidewise.plans.common import original_events
    from tidewise.plans.q_clean import polluted_named
    raw = polluted_named(spark, SF001)
    once = CL.clean(raw, original_events(spark, SF001))
    n1 = once.count()
    assert 0 < n1 < raw.count()
    # row accounting: every dropped row is explained by a step
    assert once.select("ts").distinct().count() == n1


def test_clean_flow_idempotent(spark):
    from tests.conftest import SF001
    from tidewise.plans.common import original_events
    from tidewise.plans.q_clean import polluted_named
    ref = original_events(spark, SF001)
    once = CL.clean(polluted_named(spark, SF001), ref)
    twice = CL.clean(once, ref)
    cols = ["event_id", "ts", "value", "k"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_preprocess_dedupe_option(spark):
    from tests.conftest import SF001
    from tidewise.plans.q_clean import polluted_named
    raw = polluted_named(spark, SF001)
    a = CL.preprocess(raw)
    b = CL.preprocess(raw, CL.PreprocessSpec(dedupe=True))
    assert b.count() <= a.count()
    # train + test = all rows, and the split is chronological
    for d in (a, b):
        n = d.count()
        n_test = d.where("split = 'test'").count()
        assert n_test == int(np.ceil(n * 0.3))


def test_preprocess_parses_each_text_once(spark):
    from pyspark.sql import functions as F

    from tidewise.operators.clean import PreprocessSpec, preprocess

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    raw = spark.range(300, numPartitions=3).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "date_format(timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, 10 * cast(id AS int)), 'M/d/yyyy H:mm') AS raw_ts",
        "cast(id % 50 AS string) AS value", "cast(id % 9 AS string) AS k")
    out = preprocess(raw.withColumn("value", read("value")), PreprocessSpec(lags=(1, 2)))
    assert out.count() == 298
    assert seen.value == 300
