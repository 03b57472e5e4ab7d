"""Profile operators against literal expectations and NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.operators import profile as P


def test_moments_and_quantiles_of_small_set(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = {r["p"]: r["q"] for r in P.quantiles(df, ["x"], (0.01, 0.25, 0.5, 0.75, 0.99)).collect()}
    assert q == pytest.approx({0.01: 1.03, 0.25: 1.75, 0.5: 2.5, 0.75: 4.75, 0.99: 9.79})
    m = P.moments(df, ["x"], digits=12).first()
    assert m["skewness"] == pytest.approx(1.763632614803888, abs=1e-9)
    assert m["kurtosis"] == pytest.approx(3.228, abs=1e-9)


def test_corr_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 5.0, 7.0), (4.0, 4.0, 7.0)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.corr_matrix(df, ["a", "b", "c"], digits=15).collect()}
    assert got[("a", "b")] == pytest.approx(0.7857142857142857, abs=1e-12)
    assert got[("a", "c")] is None and got[("c", "c")] is None


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.exponential(3.0, 257)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = P.describe(df, ["x"], digits=9).first()
    assert r["count"] == 257
    assert r["mean"] == pytest.approx(x.mean(), abs=1e-8)
    assert r["std"] == pytest.approx(x.std(ddof=1), abs=1e-8)
    assert r["p25"] == pytest.approx(np.percentile(x, 25), abs=1e-8)
    assert r["p75"] == pytest.approx(np.percentile(x, 75), abs=1e-8)


@pytest.mark.parametrize("bins", ["fd", 17])
def test_histogram_matches_numpy(spark, bins):
    rng = np.random.default_rng(7)
    x = np.round(rng.lognormal(2.0, 0.8, 3000), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    trim = (0.01, 0.99) if bins == "fd" else None
    got = P.histogram(df, "x", bins, trim, digits=12).orderBy("bin").collect()
    xs = x
    if trim:
        lo, hi = np.percentile(x, [1, 99])
        xs = x[(x >= lo) & (x <= hi)]
    edges = np.histogram_bin_edges(xs, bins=bins)
    if bins == "fd" and len(edges) < 3:
        edges = np.histogram_bin_edges(xs, bins="auto")
    counts, _ = np.histogram(xs, bins=edges)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["lo"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None), (4, "b")], "i int, k string")
    assert P.duplicate_rows(df).first()[0] == 1
    dk = {r["col_name"]: r["n_duplicates"] for r in P.duplicate_keys(df, ["k"]).collect()}
    assert dk["k"] == 2  # one repeat of 'a' and one of NULL
    rows = sorted(r["i"] for r in P.duplicates(df, ["k"]).collect())
    assert rows == [1, 1, 2, 3]


def test_mode_smallest_of_ties_and_top_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    d = P.describe_text(df, ["s"]).first()
    assert (d["count"], d["unique"], d["top"], d["freq"]) == (5, 3, "a", 2)
    tv = [tuple(r) for r in P.top_values(df, "s", 2).collect()]
    assert tv == [("a", 2), ("b", 2)]


def test_empty_and_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    r = P.describe(df, ["x"]).first()
    assert r["count"] == 0 and r["mean"] is None
    mt = P.missing_table(df).collect()
    assert mt[0]["missing_percent"] == 100.0


def test_nan_is_missing_in_statistics(spark):
    from tidewise.operators import outliers as O
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (3.0,), (None,)], "x double")
    d = P.describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["max"], d["p50"]) == (3, 2.0, 3.0, 2.0)
    f = O.iqr_fences(df, ["x"], k=1.5).first()
    assert (f["q1"], f["q3"]) == (1.5, 2.5)
    assert P.corr_matrix(df.withColumn("y", F.col("x") * 2), ["x", "y"]).where("col_a = 'x' AND col_b = 'y'").first()["corr"] == 1.0


def test_mean_drift_zero_reference_mean(spark):
    ref = spark.createDataFrame([(-1.0, 10.0), (1.0, 10.0)], "a double, b double")
    cur = spark.createDataFrame([(2.0, 10.2), (2.0, 10.2)], "a double, b double")
    got = {r["col_name"]: r for r in P.mean_drift(ref, cur, ["a", "b"]).collect()}
    assert got["a"]["diff_pct"] is None and got["a"]["status"] == "WARN"
    assert got["b"]["diff_pct"] == pytest.approx(2.0) and got["b"]["status"] == "OK"
    assert got["b"]["verdict"] == "similar"  # the average skips the undefined column
