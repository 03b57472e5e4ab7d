"""Ordered operators: blocked windows equal global windows; properties."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewise.operators import ordered as OD


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    n = 2500
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=10 * int(i // 2)) for i in range(n)]  # ties on ts
    user = rng.choice([1, 2, 3], size=n, p=[0.7, 0.2, 0.1])  # one hot series
    val = rng.normal(10, 3, n)
    val[rng.random(n) < 0.03] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "ts": ts, "user": user, "v": val})
    df = spark.createDataFrame(
        [(int(r.id), r.ts.to_pydatetime(), int(r.user), None if np.isnan(r.v) else float(r.v)) for r in pdf.itertuples()],
        "id long, ts timestamp_ntz, user long, v double")
    return pdf, df


def _expect_lags(pdf, by, lags):
    s = pdf.sort_values(["ts", "id"]) if not by else pdf.sort_values(["user", "ts", "id"])
    out = s.copy()
    for L in lags:
        out[f"v_lag{L}"] = (s.groupby("user")["v"] if by else s["v"]).shift(L)
    return out.set_index("id")


@pytest.mark.parametrize("by", [[], ["user"]])
@pytest.mark.parametrize("block", [97, 500, 100000])
def test_blocked_lags_equal_global(spark, series, by, block):
    pdf, df = series
    got = OD.add_lags(df, "v", [1, 24, 60], ["ts", "id"], by=by, block_rows=block).toPandas().set_index("id").sort_index()
    exp = _expect_lags(pdf, by, [1, 24, 60]).sort_index()
    for L in (1, 24, 60):
        np.testing.assert_allclose(got[f"v_lag{L}"].astype(float).to_numpy(), exp[f"v_lag{L}"].to_numpy(), equal_nan=True)


@pytest.mark.parametrize("by", [[], ["user"]])
def test_rolling_and_centered_equal_pandas(spark, series, by):
    pdf, df = series
    got = OD.rolling_mean(df, "v", {"r6": 6, "r30": 30}, ["ts", "id"], by=by, block_rows=113)
    got = OD.centered_mean(got, "v", 13, ["ts", "id"], by=by, block_rows=113).toPandas().set_index("id").sort_index()
    s = pdf.sort_values(["user", "ts", "id"] if by else ["ts", "id"])
    g = s.groupby("user")["v"] if by else s["v"]
    if by:
        r6 = g.transform(lambda x: x.shift(1).rolling(6).mean())
        r30 = g.transform(lambda x: x.shift(1).rolling(30).mean())
        tr = g.transform(lambda x: x.rolling(13, center=True).mean())
    else:
        r6, r30, tr = g.shift(1).rolling(6).mean(), g.shift(1).rolling(30).mean(), g.rolling(13, center=True).mean()
    exp = pd.DataFrame({"r6": r6, "r30": r30, "trend": tr}, index=s["id"]).sort_index()
    for c in ("r6", "r30", "trend"):
        np.testing.assert_allclose(got[c].astype(float).to_numpy(), exp[c].to_numpy(), equal_nan=True, rtol=1e-12)


def test_even_period_centered_mean(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(20)], "id long, v double")
    got = OD.centered_mean(df, "v", 4, ["id"], block_rows=5).orderBy("id").toPandas()["trend"].to_numpy(dtype=float)
    x = np.arange(20.0) ** 2
    w = np.array([0.5, 1, 1, 1, 0.5]) / 4
    exp = np.full(20, np.nan)
    exp[2:-2] = np.convolve(x, w[::-1], mode="valid")
    np.testing.assert_allclose(got, exp, equal_nan=True)


def test_ordinal_global_and_per_series(spark, series):
    pdf, df = series
    g = OD.with_ordinal(df, ["ts", "id"]).toPandas().set_index("id")["ordinal"].sort_index()
    exp = pdf.sort_values(["ts", "id"]).reset_index(drop=True).reset_index().set_index("id")["index"].sort_index()
    assert (g.to_numpy() == exp.to_numpy()).all()
    s = OD.with_ordinal(df, ["ts", "id"], by=["user"]).toPandas().set_index("id")["ordinal"].sort_index()
    exp_s = pdf.sort_values(["user", "ts", "id"]).groupby("user").cumcount()
    exp_s.index = pdf.sort_values(["user", "ts", "id"])["id"].to_numpy()
    assert (s.to_numpy() == exp_s.sort_index().to_numpy()).all()


def test_nulls_sort_last(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 1))], "id long, ts timestamp_ntz")
    got = [r["id"] for r in OD.with_ordinal(df, ["ts", "id"]).orderBy("ordinal").collect()]
    assert got == [3, 2, 1]


def test_time_split_properties(spark, series):
    _, df = series
    sp = OD.time_split(df, 0.3, ["ts", "id"])
    n = df.count()
    c = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert c["test"] == int(np.ceil(n * 0.3)) and c["train"] + c["test"] == n
    mx = sp.where("split = 'train'").agg(F.max("ordinal")).first()[0]
    mn = sp.where("split = 'test'").agg(F.min("ordinal")).first()[0]
    assert mx < mn


def test_folds_never_train_on_later_rows(spark, series):
    _, df = series
    f = OD.time_series_folds(df, 5, ["ts", "id"])
    g = f.groupBy("fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("ordinal"))).alias("tr_max"),
        F.min(F.when(F.col("role") == "test", F.col("ordinal"))).alias("te_min"),
        F.count(F.when(F.col("role") == "test", 1)).alias("n_test")).collect()
    n = df.count()
    for r in g:
        assert r["tr_max"] < r["te_min"]
        assert r["n_test"] == n // 6


def test_dedupe_first_keeps_smallest_tiebreak(spark):
    df = spark.createDataFrame([(5, "a", 1.0), (3, "a", 2.0), (4, "b", 3.0)], "id long, k string, v double")
    got = sorted(tuple(r) for r in OD.dedupe_first(df, ["k"], ["id"]).collect())
    assert got == [(3, "a", 2.0), (4, "b", 3.0)]


def test_no_single_partition_window_in_plan(spark, series):
    _, df = series
    plan = OD.add_lags(df, "v", [1, 24], ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    # windows run per block; the only unpartitioned window is over the per-partition count table
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_hot_series_is_spread_over_partitions(spark):
    """A series with a third of all rows must not land in one task."""
    n = 30000
    rows = [(i, (0 if i % 3 == 0 else 1 + i % 997), i) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, user long, t long").repartition(8)
    srt = df.repartitionByRange(16, F.col("user").asc(), F.col("t").asc_nulls_last())
    sizes = [r[1] for r in srt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < n / 6  # the hot user (n/3 rows) is split across several partitions
    lagged = OD.add_lags(df, "t", [1, 5], ["t", "id"], by=["user"], block_rows=512)
    hot = lagged.where("user = 0").orderBy("t").select("t", "t_lag1", "t_lag5").collect()
    assert hot[0]["t_lag1"] is None and all(r["t_lag1"] == r["t"] - 3 for r in hot[1:])
    assert all(r["t_lag5"] == r["t"] - 15 for r in hot[5:])


def test_rows_left_are_renumbered_without_a_second_sort(spark):
    rng = np.random.default_rng(3)
    n = 3000
    order = rng.permutation(n)
    df = spark.createDataFrame([(int(t), float(v)) for t, v in zip(order, rng.normal(size=n))], "t long, v double").repartition(7)
    out = OD.windowed(df, OD.lag_exprs("v", [2]), ["t"], before=2, block_rows=16, keep_ordinal="_at", keep_block="_in")
    kept = out.where("v > 0.8 AND t NOT BETWEEN 1000 AND 1100")
    got = OD.renumbered(kept, "_at", "_in", total="n")
    rows = sorted((r["t"], r["ordinal"], r["n"]) for r in got.collect())
    assert [r[1] for r in rows] == list(range(len(rows))) and {r[2] for r in rows} == {len(rows)}
    assert OD.renumbered(out.where("v > 1e9"), "_at", "_in").count() == 0
    many = OD.renumbered(out.withColumn("_in", F.col("_at")), "_at", "_in")  # one row a block: more than one span
    assert sorted((r["t"], r["ordinal"]) for r in many.collect()) == [(t, t) for t in range(n)]
