"""Missing values, typed time columns, exact quantiles, name resolution and quoting."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewise.functions.text import clean_names, resolve_column, under_names
from tidewise.operators import clean as CL
from tidewise.operators import ordered as OD
from tidewise.operators import outliers as O
from tidewise.operators import profile as P
from tidewise.operators.quantiles import frequency_table, quantile_values, quantiles
from tidewise.operators.timeseries import seasonal_decompose


@pytest.mark.parametrize("scale", [1.0, 1e-12, 1e12])
def test_exact_quantiles_equal_numpy(spark, scale):
    rng = np.random.default_rng(11)
    a = rng.normal(0, scale, 3000)
    b = np.where(rng.random(3000) < 0.4, 3.0 * scale, rng.integers(0, 50, 3000) * scale)  # a hot value
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "`o'hare` double, b double, c double")
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = quantile_values(df, ["o'hare", "b", "c"], probs)
    for p in probs:
        for name, v in (("o'hare", a), ("b", b)):
            want = float(np.quantile(v, p))
            assert got[name, p] == pytest.approx(want, rel=1e-14, abs=1e-14 * scale), (name, p)
        assert got["c", p] is None


def test_quantiles_see_values_not_rows(spark):
    """One value on a third of the rows is one row of the table that is sorted."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 100).cast("double").alias("x"))
    freq = frequency_table(df, ["x"])
    assert freq.count() == 100 and freq.agg(F.sum("n")).first()[0] == 30_000
    plan = freq._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # combined before the shuffle


def test_quantiles_of_empty_and_single(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantile_values(empty, ["x"], (0.5,)) == {("x", 0.5): None}
    one = spark.createDataFrame([(4.0,), (float("nan"),), (None,)], "x double")
    assert [r["q"] for r in quantiles(one, ["x"], (0.0, 0.3, 1.0)).collect()] == [4.0] * 3
    with pytest.raises(ValueError):
        quantile_values(one, ["x"], (0.5,), "two")


def test_approx_quantiles_stay_within_their_rank_error(spark):
    x = np.random.default_rng(3).normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for (_, p), q in quantile_values(df, ["x"], (0.1, 0.5, 0.9), "approx", accuracy=100).items():
        assert abs((x <= q).mean() - p) <= 0.01 + 1 / len(x)


def test_quantile_trim_and_fences_with_a_quote_in_the_name(spark):
    df = spark.createDataFrame([(float(v), float(v * v)) for v in range(1, 101)], "`it's` double, y double")
    assert CL.quantile_trim(df, "it's", 0.1, 0.9).count() == 80
    assert O.iqr_fences(df, ["it's"], k=1.5, floor=None).first()["q1"] == 25.75
    assert P.box_stats(df, ["it's", "y"]).count() == 2
    assert P.corr_matrix(df, ["it's", "y"]).where("col_a <> col_b").count() == 2
    assert O.handle_outliers(df, ["it's"], "IQR", "replace", "mean").count() == 100


def test_nan_is_missing_in_cleaning_steps(spark):
    nan = float("nan")
    df = spark.createDataFrame([(i, nan if i % 2 else 1.0, nan, nan if i == 3 else 2.0) for i in range(100)], "i long, half double, none double, few double")
    assert CL.null_rates(df)["half"] == 50.0
    assert CL.drop_empty_columns(df).columns == ["i", "half", "few"]
    assert CL.drop_sparse_nulls(df, 5.0).count() == 99
    assert CL.drop_rows_min_nulls(df, ["half", "none"], 2).count() == 50


def test_null_series_are_kept(spark):
    rows = [(i, None if i % 3 == 0 else i % 3, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s long, ts timestamp_ntz, v double")
    od = OD.with_ordinal(df, ["ts", "id"], by=["s"], total="n")
    assert sorted((r["id"], r["ordinal"], r["n"]) for r in od.collect()) == [(i, i // 3, 20) for i in range(60)]
    assert OD.time_split(df, 0.3, ["ts", "id"], by=["s"]).groupBy("split").count().where("split = 'test'").first()["count"] == 18
    assert seasonal_decompose(df, "v", 4, ["ts", "id"], by=["s"]).count() == 60


def test_hot_series_is_joined_by_partition(spark):
    """The join that gives a series its start also has the partition as key."""
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).alias("s"), F.col("id").alias("t"))
    out = OD.with_ordinal(df, ["t"], by=["s"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_spid" in plan and out.where("s = 0").agg(F.max("ordinal")).first()[0] == 3499


def test_deep_pages_equal_shallow_ones(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id"), (F.lit(1000) - F.col("id")).alias("k"))
    want = [r["id"] for r in OD.page(df, ["k"], 7, 50)[0].collect()]
    monkeypatch.setattr(OD, "TOP_ROWS", 10)
    items, total = OD.page(df, ["k"], 7, 50)
    assert [r["id"] for r in items.collect()] == want == list(range(699, 649, -1))
    assert total.first()["total"] == 1000


def test_flows_take_typed_time_columns(spark):
    from tidewise.functions.times import to_ts
    from tidewise.plans.common import original_events
    from tidewise.plans.q_clean import polluted_named

    raw = polluted_named(spark, SF001)
    typed = raw.withColumn("raw_ts", to_ts("raw_ts"))
    assert CL.preprocess(typed).count() == CL.preprocess(raw).count() > 0
    assert CL.clean(typed, original_events(spark, SF001)).count() == CL.clean(raw, original_events(spark, SF001)).count() > 0


def test_flows_refuse_a_time_column_that_is_none(spark):
    from tidewise.plans.q_clean import polluted_named

    wrong = polluted_named(spark, SF001).withColumn("raw_ts", F.lit("2024-01-01T00:00"))
    with pytest.raises(ValueError, match="raw_ts"):
        CL.preprocess(wrong)
    with pytest.raises(ValueError, match="raw_ts"):
        CL.clean(wrong, None)


def test_preprocess_finds_columns_by_their_key(spark):
    from tidewise.plans.q_clean import polluted_named

    raw = polluted_named(spark, SF001)
    odd = raw.withColumnsRenamed({"raw_ts": "Raw TS", "value": " Value "})
    assert CL.preprocess(odd).count() == CL.preprocess(raw).count()


def test_name_resolution(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Wind Speed` int, `wind-speed` int, `Zone 1` int")
    assert resolve_column(df, "Wind Speed") == "Wind Speed" and resolve_column(df, "zone1") == "Zone 1"
    with pytest.raises(ValueError, match="could be any of"):
        resolve_column(df, "wind_speed")
    with pytest.raises(ValueError, match="closest: .*Zone 1"):
        resolve_column(df, "zone_12")
    assert under_names(df, ["zone1"]).columns == ["Wind Speed", "wind-speed", "zone1"]
    with pytest.raises(ValueError):
        clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `A B ` int"))


def test_histogram_leaves_infinite_values_out(spark):
    df = spark.createDataFrame([(float(v),) for v in range(50)] + [(float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "x double")
    bins = P.histogram(df, "x", 5, None).collect()
    assert [r["n"] for r in bins] == [10] * 5 and bins[-1]["hi"] == 49.0


def test_outlier_counts(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [*range(20), 500]] + [(None, float("nan"))], "x double, y double")
    rows = {r["col_name"]: (r["total"], r["outliers"], r["percent"]) for r in O.outlier_counts(df, ["x", "y"]).collect()}
    assert rows == {"x": (21, 1, round(100 / 21, 6)), "y": (21, 0, 0.0)}


def test_preprocess_sorts_once_sized_by_the_input(spark, monkeypatch):
    from tidewise.plans.q_clean import polluted_named

    asked = []
    real = OD.with_ordinal
    monkeypatch.setattr(OD, "with_ordinal", lambda *a, **k: asked.append(k.get("partitions")) or real(*a, **k))
    monkeypatch.setattr(CL, "shuffle_partitions_for", lambda df: 5)
    CL.preprocess(polluted_named(spark, SF001)).count()
    assert asked == [5]
