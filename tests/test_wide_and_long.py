"""Duplicates by digest, correlation by block products, long moving means."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewise.operators import duplicates as DU
from tidewise.operators import moving as MV
from tidewise.operators import ordered as OD
from tidewise.operators import profile as P
from tidewise.operators import widecorr as WC


def _same_digest(cols):
    return F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"))


ROWS = [(1, "a", None, 0.0), (1, "a", None, -0.0), (1, None, "a", 0.0), (2, "b", "", float("nan")), (2, "b", "", float("nan")), (2, "b", None, 1.0),
        (None, None, None, None), (None, None, None, None), (None, None, None, None)]


@pytest.mark.parametrize("digest", [DU.row_digest, _same_digest])
@pytest.mark.parametrize("few", [DU.FEW, 0])
def test_duplicates_even_if_all_digests_clash(spark, monkeypatch, digest, few):
    monkeypatch.setattr(DU, "FEW", few)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, k int, x string, y string, v double")
    assert DU.duplicate_rows(df.drop("i"), digest).first()[0] == 1 + 1 + 2
    assert sorted(r["i"] for r in DU.duplicates(df, ["k", "x", "y", "v"], digest).collect()) == [0, 1, 3, 4, 6, 7, 8]
    assert sorted(r["i"] for r in DU.duplicates(df, ["k", "x"], digest).collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    assert DU.duplicate_rows(df.limit(0), digest).first()[0] == 0


def test_null_cells_have_a_place_in_the_digest(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(DU.row_digest([F.col("x"), F.col("y")]).alias("d")).distinct().count() == 2


def test_only_digests_are_shuffled_when_nothing_repeats(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 500).alias("wide"))
    found, few = DU.repeated(df, df.columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert few and plan.index("BroadcastHashJoin") > 0  # whole rows meet after the semi join only
    assert found.count() == 0


@pytest.fixture(scope="module")
def wide():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(700, 9))
    v = base @ rng.normal(size=(9, 70)) + rng.normal(size=(700, 70)) * 0.5
    v[:, 3] += 1e8  # an offset far from the spread
    v[:, 5] = 4.5  # constant
    v[rng.random(v.shape) < 0.1] = np.nan
    v[:, 7] = np.nan  # empty
    v[:300, 8] = np.nan
    v[300:, 9] = np.nan  # never with column 8
    return pd.DataFrame(v, columns=[f"c {i}" for i in range(70)])


@pytest.mark.parametrize("block", [512, 16])
def test_wide_correlation_equals_pandas(spark, wide, block):
    names = list(wide.columns)
    rows = [[None if np.isnan(x) and i % 2 else float(x) for x in r] for i, r in enumerate(wide.to_numpy())]  # NULL and NaN
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    got = WC.corr_wide(df, names, digits=9, block=block).toPandas().pivot(index="col_a", columns="col_b", values="corr").loc[names, names]
    exp = wide.corr().loc[names, names].to_numpy()
    np.testing.assert_allclose(got.to_numpy(dtype=float), exp, atol=2e-7, equal_nan=True)
    assert P.corr_matrix(df, names).where("col_a = 'c 1' AND col_b = 'c 2'").first()["corr"] == round(exp[1, 2], 6)


def test_wide_correlation_odd_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, float("inf")), (2.0, 3.5, 1.0), (3.0, None, 2.0), (4.0, 5.0, None)], "a double, b double, c double")
    narrow = {(r[0], r[1]): r[2] for r in WC.corr_wide(df, ["a", "b", "c"]).collect()}
    assert narrow["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 3.5, 5])[0, 1], abs=1e-6)
    assert narrow["a", "c"] is None and narrow["b", "c"] is None and narrow["c", "c"] is None and narrow["a", "a"] == 1.0
    none = WC.corr_wide(df.limit(0), ["a", "b"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(5)
    n = 3000
    user = rng.choice(["a", "b", None], size=n, p=[0.6, 0.3, 0.1])
    v = rng.normal(3, 2, n)
    v[700] = 1e15  # leaves no rounding behind it
    v[rng.random(n) < 0.002] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "user": user, "v": v})
    df = spark.createDataFrame([(int(r.id), r.user, None if np.isnan(r.v) else float(r.v)) for r in pdf.itertuples()], "id long, user string, v double")
    return pdf, df.repartition(7)


@pytest.mark.parametrize("by", [[], ["user"]])
@pytest.mark.parametrize("block", [10, 37, 8192])
def test_long_means_equal_sums_of_the_rows(spark, walk, by, block):
    pdf, df = walk
    got = OD.rolling_mean(df, "v", {"s": 5, "m": 50, "l": 111}, ["id"], by, block_rows=block, long_rows=20)
    assert got.columns == ["id", "user", "v", "s", "m", "l"]
    got = OD.centered_mean(got, "v", 40, ["id"], by, "even", block_rows=block, long_rows=20)
    got = OD.centered_mean(got, "v", 41, ["id"], by, "odd", block_rows=block, long_rows=20).toPandas().set_index("id").sort_index()
    exp = {c: {} for c in ("s", "m", "l", "even", "odd")}
    for _, g in (pdf.assign(user=pdf["user"].fillna("-")).groupby("user") if by else [(None, pdf)]):
        v, ids = g["v"].to_numpy(), g["id"].to_numpy()
        for t in range(len(v)):
            for c, n in (("s", 5), ("m", 50), ("l", 111)):
                exp[c][ids[t]] = v[t - n:t].mean() if t >= n else np.nan
            inside = t >= 20 and t + 20 < len(v)
            own = v[t - 20:t + 21] if inside else np.array([np.nan])
            exp["odd"][ids[t]] = own.mean()
            exp["even"][ids[t]] = (own.sum() - 0.5 * own[0] - 0.5 * own[-1]) / 40 if inside else np.nan
    for c, want in exp.items():
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), pd.Series(want).sort_index().to_numpy(), rtol=1e-10, equal_nan=True)


def test_a_window_of_a_million_rows_needs_no_long_block(spark):
    n = 1_000_000
    df = spark.range(n + 50).select("id", (F.col("id") % 7).cast("double").alias("v"))
    base = df.withColumn(OD.ORD, F.col("id"))
    sums = MV.running_sums(base, "v", [], 8192, 8)
    assert sums.groupBy("_b").count().agg(F.max("count")).first()[0] == 8192
    got = {r["id"]: r["m"] for r in OD.rolling_mean(df, "v", {"m": n}, ["id"]).where(f"id >= {n - 1}").collect()}
    v = np.arange(n + 50) % 7
    assert got[n - 1] is None
    for t in range(n, n + 50):
        assert got[t] == pytest.approx(v[t - n:t].mean(), rel=1e-12)
