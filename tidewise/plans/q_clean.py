"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import to_number
from ..operators import clean as CL
from ..operators import profile as P
from .common import coerced, events, original_events, polluted_events
from .registry import query
from .sqlparts import ORIGINAL_CTE, num, ts, with_coerced, with_polluted

VK = ["value", "k"]


def polluted_named(spark, sf):
    """Polluted view with the value texts under their clean names."""
    return polluted_events(spark, sf).withColumnRenamed("raw_value", "value").withColumnRenamed("raw_k", "k")


# ---------------------------------------------------------------- B group

@query("require_target", with_coerced("SELECT event_id, value FROM c WHERE value IS NOT NULL"))
def q_require_target(spark, sf):
    """Drop rows whose coerced target is NULL."""
    return CL.require(coerced(spark, sf).select("event_id", "value"), ["value"])


@query("require_valid_ts", with_coerced("SELECT event_id, raw_ts, ts FROM c WHERE raw_ts IS NOT NULL AND ts IS NOT NULL"))
def q_require_valid_ts(spark, sf):
    """Drop missing time text, then unparseable time."""
    c = coerced(spark, sf).select("event_id", "raw_ts", "ts")
    return CL.require(CL.require(c, ["raw_ts"]), ["ts"])


@query("drop_any_null", with_coerced("SELECT event_id, ts, value, k FROM c WHERE ts IS NOT NULL AND value IS NOT NULL AND k IS NOT NULL"))
def q_drop_any_null(spark, sf):
    """Drop rows with any NULL."""
    return CL.drop_any_null(coerced(spark, sf).select("event_id", "ts", "value", "k"))


_SPARSE_COLS = ["event_id", "user_id", "event_type", "raw_ts", "ts", "value", "k", "mixed_type_col"]


@query("drop_sparse_nulls", with_coerced(
    "SELECT c2.* FROM c2, r WHERE NOT (" + " OR ".join(f"(r_{c} < 5 AND c2.{c} IS NULL)" for c in _SPARSE_COLS) + ")",
    "c2 AS (SELECT * FROM c WHERE value IS NOT NULL), r AS (SELECT "
    + ", ".join(f"avg(CAST({c} IS NULL AS DOUBLE)) * 100 AS r_{c}" for c in _SPARSE_COLS) + " FROM c2)"))
def q_drop_sparse_nulls(spark, sf):
    """B12 after B9: columns under 5 % NULL form the subset for a row drop."""
    c = CL.require(coerced(spark, sf), ["value"])
    return CL.drop_sparse_nulls(c, 5.0)


_RN = ["ts", "value", "k", "mixed_type_col"]


@query("row_null_threshold", with_coerced(
    "SELECT event_id, ts, value, k, mixed_type_col FROM c WHERE "
    + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _RN) + " < 2"))
def q_row_null_threshold(spark, sf):
    """Keep rows with fewer than 2 NULLs among four columns."""
    c = coerced(spark, sf).select("event_id", *_RN)
    return CL.drop_rows_min_nulls(c, _RN, 2)


_INF_SQL = ("CASE WHEN event_id % 53 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 59 = 0 THEN CAST('-inf' AS DOUBLE) "
            "ELSE value END")


@query("drop_nonfinite", f"SELECT event_id, x FROM (SELECT event_id, {_INF_SQL} AS x FROM events) WHERE isfinite(x)")
def q_drop_nonfinite(spark, sf):
    """A column holding +-Infinity (built per event); such rows drop."""
    e = events(spark, sf).select(
        "event_id",
        F.when(F.col("event_id") % 53 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 59 == 0, F.lit(float("-inf")))
        .otherwise(F.col("value")).alias("x"),
    )
    return CL.drop_nonfinite(e, ["x"])


@query("drop_empty_columns", with_polluted(
    f"SELECT event_id, user_id, {num('raw_value')} AS raw_value, {num('raw_k')} AS raw_k, {num('mixed_type_col')} AS mixed_type_col FROM p"))
def q_drop_empty_columns(spark, sf):
    """Every value text coerced to numbers; columns left with no value
    (the time text) are dropped."""
    p = polluted_events(spark, sf)
    text = ["raw_ts", "raw_value", "raw_k", "mixed_type_col"]
    num_all = p.select("event_id", "user_id", *[to_number(c).alias(c) for c in text])
    return CL.drop_empty_columns(num_all)


@query("aligned_target", with_coerced(
    "SELECT event_id, value FROM c WHERE event_id IN (SELECT event_id FROM c WHERE k IS NOT NULL AND isfinite(k))"))
def q_aligned_target(spark, sf):
    """Y rows whose id survived X's NULL / non-finite filter."""
    c = coerced(spark, sf)
    x = CL.drop_nonfinite(c.select("event_id", "k"), ["k"])
    return CL.aligned(c.select("event_id", "value"), x, ["event_id"])


# ---------------------------------------------------------------- I5 flow

def _fence(src, c, k=3.0):
    return (f"(SELECT CASE WHEN q1 - {k} * (q3 - q1) < 0 THEN 0.0 ELSE q1 - {k} * (q3 - q1) END AS {c}_lo, q3 + {k} * (q3 - q1) AS {c}_hi "
            f"FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src}))")


CLEAN_CTES = (
    ORIGINAL_CTE + ", "
    "cf0 AS (SELECT event_id, user_id, event_type, raw_ts, ts, value, k FROM c WHERE raw_ts IS NOT NULL AND ts IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id) = 1), "
    f"cf1 AS (SELECT event_id, user_id, event_type, raw_ts, ts, "
    f"CASE WHEN value < value_lo OR value > value_hi THEN NULL ELSE value END AS value, "
    f"CASE WHEN k < k_lo OR k > k_hi THEN NULL ELSE k END AS k FROM cf0, {_fence('o', 'value')}, {_fence('o', 'k')}), "
    "cl AS (SELECT * FROM cf1 WHERE CAST(value IS NULL AS INTEGER) + CAST(k IS NULL AS INTEGER) < 2)"
)


def clean_flow_df(spark, sf):
    return CL.clean(polluted_named(spark, sf), original_events(spark, sf))


@query("clean_flow", with_coerced("SELECT event_id, user_id, event_type, raw_ts, ts, value, k FROM cl", CLEAN_CTES))
def q_clean_flow(spark, sf):
    """The notebook cleaning flow, fences from the original table."""
    return clean_flow_df(spark, sf).select("event_id", "user_id", "event_type", "raw_ts", "ts", "value", "k")


@query("remaining_nulls", with_coerced(
    "SELECT col_name, n_null, pct FROM (SELECT 'value' AS col_name, count(*) - count(value) AS n_null, "
    "round((count(*) - count(value)) / count(*) * 100, 6) AS pct FROM cl UNION ALL "
    "SELECT 'k', count(*) - count(k), round((count(*) - count(k)) / count(*) * 100, 6) FROM cl) WHERE n_null > 0 "
    "UNION ALL SELECT '__total__', CAST(2 * count(*) - count(value) - count(k) AS BIGINT), "
    "round((2 * count(*) - count(value) - count(k)) / (count(*) * 2) * 100, 6) FROM cl", CLEAN_CTES))
def q_remaining_nulls(spark, sf):
    """NULLs left after the cleaning flow, per column and in total."""
    return P.remaining_nulls(clean_flow_df(spark, sf), VK)


@query("size_comparison", with_coerced(
    "SELECT (SELECT count(*) FROM events) AS original_rows, (SELECT count(*) FROM p) AS raw_rows, "
    "(SELECT count(*) FROM cl) AS clean_rows, (SELECT count(*) FROM p) - (SELECT count(*) FROM cl) AS dropped, "
    "round(((SELECT count(*) FROM p) - (SELECT count(*) FROM cl)) / (SELECT count(*) FROM p) * 100, 6) AS dropped_pct, "
    "round((SELECT count(*) FROM cl) / (SELECT count(*) FROM events) * 100, 6) AS recovery_pct", CLEAN_CTES))
def q_size_comparison(spark, sf):
    """Original vs polluted vs cleaned row counts."""
    return P.size_comparison(events(spark, sf), polluted_events(spark, sf), clean_flow_df(spark, sf))


_DRIFT = (
    "d AS (SELECT 'value' AS col_name, (SELECT avg(value) FROM o) AS ref_mean, (SELECT avg(value) FROM cl) AS cur_mean "
    "UNION ALL SELECT 'k', (SELECT avg(k) FROM o), (SELECT avg(k) FROM cl)), "
    "d2 AS (SELECT *, abs((cur_mean - ref_mean) / nullif(ref_mean, 0) * 100) AS diff_pct FROM d)"
)


@query("mean_drift", with_coerced(
    "SELECT col_name, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean, round(diff_pct, 6) AS diff_pct, "
    "CASE WHEN diff_pct < 5 THEN 'OK' ELSE 'WARN' END AS status, "
    "CASE WHEN avg(diff_pct) OVER () < 5 THEN 'similar' WHEN avg(diff_pct) OVER () < 10 THEN 'moderate' ELSE 'different' END AS verdict "
    "FROM d2", CLEAN_CTES + ", " + _DRIFT))
def q_mean_drift(spark, sf):
    """C4 + D27: per-column mean drift of the cleaned table vs the original."""
    return P.mean_drift(original_events(spark, sf), clean_flow_df(spark, sf), VK)


# ---------------------------------------------------------------- I6 flow

_PRE_COLS = ["event_id", "user_id", "event_type", "ts", "value", "k"]
_LAGW = "OVER (ORDER BY ts, event_id)"


def _up(c, k=2.0):
    return (f"CASE WHEN {c}_q3 - {c}_q1 IS NOT NULL AND {c}_q3 - {c}_q1 <> 0 AND {c} > {c}_q3 + {k} * ({c}_q3 - {c}_q1) "
            f"THEN {c}_med ELSE {c} END")


PRE_CTES = (
    "a1 AS (SELECT event_id, user_id, event_type, ts, value, k FROM c WHERE value IS NOT NULL), "
    "r AS (SELECT " + ", ".join(f"avg(CAST({x} IS NULL AS DOUBLE)) * 100 AS r_{x}" for x in _PRE_COLS) + " FROM a1), "
    "a2 AS (SELECT a1.* FROM a1, r WHERE NOT (" + " OR ".join(f"(r_{x} < 5 AND a1.{x} IS NULL)" for x in _PRE_COLS) + ")), "
    "s AS (SELECT quantile_cont(value, 0.25) AS value_q1, quantile_cont(value, 0.75) AS value_q3, median(value) AS value_med, "
    "quantile_cont(k, 0.25) AS k_q1, quantile_cont(k, 0.75) AS k_q3, median(k) AS k_med FROM a2), "
    f"a3 AS (SELECT event_id, user_id, event_type, ts, {_up('value')} AS value, {_up('k')} AS k FROM a2, s), "
    "a4 AS (SELECT *, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS dayofweek, CAST(month(ts) AS BIGINT) AS month, "
    f"lag(value, 1) {_LAGW} AS value_lag1, lag(value, 24) {_LAGW} AS value_lag24, lag(value, 168) {_LAGW} AS value_lag168 FROM a3), "
    "a5 AS (SELECT * FROM a4 WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL "
    "AND value IS NOT NULL AND k IS NOT NULL AND value_lag1 IS NOT NULL AND value_lag24 IS NOT NULL AND value_lag168 IS NOT NULL "
    "AND isfinite(k) AND isfinite(value_lag1) AND isfinite(value_lag24) AND isfinite(value_lag168)), "
    "a6 AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal, count(*) OVER () AS n FROM a5)"
)


@query("preprocess_flow", with_coerced(
    "SELECT event_id, user_id, event_type, value, k, hour, dayofweek, month, value_lag1, value_lag24, value_lag168, ordinal, "
    "CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM a6", PRE_CTES))
def q_preprocess_flow(spark, sf):
    """The production preprocessing flow (coerce="all") with lags
    [1, 24, 168] on one long series and a 70/30 chronological split."""
    out = CL.preprocess(polluted_named(spark, sf))
    return out.select("event_id", "user_id", "event_type", "value", "k", "hour", "dayofweek", "month",
                      "value_lag1", "value_lag24", "value_lag168", "ordinal", "split")


_FIT_LAGS = [f"value_lag{n}" for n in (1, 24, 168)]
_RAW_CTES = (
    PRE_CTES[: PRE_CTES.index("s AS (SELECT quantile_cont")]
    + "a3 AS (SELECT * FROM a2), " + PRE_CTES[PRE_CTES.index("a4 AS (SELECT"):]
    + ", sp AS (SELECT *, CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM a6), "
    "st AS (SELECT quantile_cont(value, 0.25) AS value_q1, quantile_cont(value, 0.75) AS value_q3, median(value) AS value_med, "
    "quantile_cont(k, 0.25) AS k_q1, quantile_cont(k, 0.75) AS k_q3, median(k) AS k_med FROM sp WHERE split = 'train')"
)


def _up_like(c, like, k=2.0):
    return (f"CASE WHEN {like}_q3 - {like}_q1 <> 0 AND {c} > {like}_q3 + {k} * ({like}_q3 - {like}_q1) THEN {like}_med ELSE {c} END AS {c}")


@query("preprocess_train_fit", with_coerced(
    f"SELECT event_id, user_id, event_type, {_up_like('value', 'value')}, {_up_like('k', 'k')}, hour, dayofweek, month, "
    + ", ".join(_up_like(c, "value") for c in _FIT_LAGS) + ", ordinal, split FROM sp, st", _RAW_CTES))
def q_preprocess_train_fit(spark, sf):
    """I6 with outlier statistics of the train rows alone."""
    out = CL.preprocess(polluted_named(spark, sf), CL.PreprocessSpec(fit_on="train"))
    return out.select("event_id", "user_id", "event_type", "value", "k", "hour", "dayofweek", "month", *_FIT_LAGS, "ordinal", "split")
