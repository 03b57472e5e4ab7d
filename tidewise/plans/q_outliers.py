"""Outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import outliers as O
from .common import coerced, events, original_events, table
from .registry import query
from .sqlparts import ORIGINAL_CTE, with_coerced

VK = ["value", "k"]


def _fence_sql(src: str, c: str, k: float = 3.0) -> str:
    return (f"SELECT '{c}' AS col_name, q1, q3, q3 - q1 AS iqr, CASE WHEN q1 - {k} * (q3 - q1) < 0 THEN 0.0 ELSE q1 - {k} * (q3 - q1) END AS lo, "
            f"q3 + {k} * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})")


def _r6(cols, sql):
    sel = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT col_name, {sel} FROM ({sql})"


@query("iqr_fences", _r6(["q1", "q3", "iqr", "lo", "hi"], _fence_sql("events", "value") + " UNION ALL " + _fence_sql("customer", "c_acctbal")))
def q_iqr_fences(spark, sf):
    """3 IQR fences floored at 0, for ``events.value`` and ``customer.c_acctbal``."""
    a = O.iqr_fences(events(spark, sf), ["value"], digits=6)
    b = O.iqr_fences(table(spark, sf, "customer"), ["c_acctbal"], digits=6)
    return a.unionByName(b)


_SELF_FENCES = "fz AS (" + _fence_sql("c", "value") + " UNION ALL " + _fence_sql("c", "k") + ")"


@query("outlier_report", with_coerced(
    "SELECT f.col_name, CAST(coalesce(cn.n_outliers, 0) AS BIGINT) AS n_outliers, "
    "(SELECT CAST(count(*) AS BIGINT) FROM o) AS total_outliers, ex.rank, ex.event_id, ex.value FROM fz f "
    "LEFT JOIN (SELECT col_name, count(*) AS n_outliers FROM o GROUP BY col_name) cn ON cn.col_name = f.col_name "
    "LEFT JOIN (SELECT col_name, CAST(row_number() OVER (PARTITION BY col_name ORDER BY event_id) AS BIGINT) AS rank, event_id, value FROM o "
    "QUALIFY rank <= 3) ex ON ex.col_name = f.col_name",
    _SELF_FENCES + ", o AS (SELECT c.event_id, f.col_name, CASE f.col_name WHEN 'value' THEN c.value ELSE c.k END AS value "
    "FROM c, fz f WHERE (CASE f.col_name WHEN 'value' THEN c.value ELSE c.k END) < f.lo "
    "OR (CASE f.col_name WHEN 'value' THEN c.value ELSE c.k END) > f.hi)"))
def q_outlier_report(spark, sf):
    """Extreme (3 IQR) outliers per column, fences from the same table."""
    return O.outlier_report(coerced(spark, sf).select("event_id", *VK), VK, "event_id")


_REF_FENCES = ORIGINAL_CTE + ", fz AS (" + _fence_sql("o", "value") + " UNION ALL " + _fence_sql("o", "k") + ")"
_FV = "(SELECT lo FROM fz WHERE col_name = '{c}') AS {c}_lo, (SELECT hi FROM fz WHERE col_name = '{c}') AS {c}_hi"


@query("fence_from_reference", with_coerced(
    "SELECT event_id, value, k, coalesce(value < value_lo OR value > value_hi, false) AS value_outside, "
    "coalesce(k < k_lo OR k > k_hi, false) AS k_outside FROM (SELECT *, " + _FV.format(c="value") + ", " + _FV.format(c="k") + " FROM c)",
    _REF_FENCES))
def q_fence_from_reference(spark, sf):
    """Fences of the original table applied to each polluted row."""
    ref = O.iqr_fences(original_events(spark, sf), VK)
    return O.apply_fences(coerced(spark, sf).select("event_id", *VK), ref, VK, "flag")


@query("fence_to_null", with_coerced(
    "SELECT event_id, CASE WHEN value < value_lo OR value > value_hi THEN NULL ELSE value END AS value, "
    "CASE WHEN k < k_lo OR k > k_hi THEN NULL ELSE k END AS k FROM (SELECT *, " + _FV.format(c="value") + ", " + _FV.format(c="k") + " FROM c)",
    _REF_FENCES))
def q_fence_to_null(spark, sf):
    """Values outside the original table's fences -> NULL."""
    ref = O.iqr_fences(original_events(spark, sf), VK)
    return O.apply_fences(coerced(spark, sf).select("event_id", *VK), ref, VK, "null")


def _upper_sql(c, k=2.0):
    return (f"(SELECT quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3, median({c}) AS {c}_med FROM c)")


_UP = f"s AS (SELECT * FROM {_upper_sql('value')}, {_upper_sql('k')})"


def _up_mask(c, k=2.0):
    return f"({c}_q3 - {c}_q1 IS NOT NULL AND {c}_q3 - {c}_q1 <> 0 AND {c} IS NOT NULL AND {c} > {c}_q3 + {k} * ({c}_q3 - {c}_q1))"


@query("outlier_to_median", with_coerced(
    f"SELECT event_id, CASE WHEN {_up_mask('value')} THEN value_med ELSE value END AS value, "
    f"CASE WHEN {_up_mask('k')} THEN k_med ELSE k END AS k FROM c, s", _UP))
def q_outlier_to_median(spark, sf):
    """Values above q3 + 2 IQR -> the column median."""
    out, _ = O.replace_upper_outliers(coerced(spark, sf).select("event_id", *VK), VK, 2.0)
    return out


@query("outlier_replaced_counts", with_coerced(
    f"SELECT 'value' AS col_name, count(*) FILTER (WHERE {_up_mask('value')}) AS n_replaced FROM c, s "
    f"UNION ALL SELECT 'k', count(*) FILTER (WHERE {_up_mask('k')}) FROM c, s", _UP))
def q_outlier_replaced_counts(spark, sf):
    """Number of values I1 replaced per column."""
    _, counts = O.replace_upper_outliers(coerced(spark, sf).select("event_id", *VK), VK, 2.0)
    return counts


def _iqr_stats(c, src="c"):
    return f"(SELECT quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3 FROM {src})"


def _iqr_out(c):
    return f"coalesce({c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1), false)"


@query("outlier_iqr_drop", with_coerced(
    f"SELECT event_id, value, k FROM c, {_iqr_stats('value')}, {_iqr_stats('k')} WHERE NOT {_iqr_out('value')} AND NOT {_iqr_out('k')}"))
def q_outlier_iqr_drop(spark, sf):
    """I4: drop rows outside 1.5 IQR in any column, all masks from one pass."""
    return O.handle_outliers(coerced(spark, sf).select("event_id", *VK), VK, "IQR", "drop")


@query("outlier_iqr_drop_seq", with_coerced(
    f"SELECT event_id, value, k FROM s1, {_iqr_stats('k', 's1')} WHERE NOT {_iqr_out('k')}",
    f"s1 AS (SELECT event_id, value, k FROM c, {_iqr_stats('value')} WHERE NOT {_iqr_out('value')})"))
def q_outlier_iqr_drop_seq(spark, sf):
    """I4 sequential: the second column's fences see the first filter's rows."""
    return O.handle_outliers(coerced(spark, sf).select("event_id", *VK), VK, "IQR", "drop", sequential=True)


def _z_out(c):
    return f"coalesce(abs(({c} - {c}_m) / nullif({c}_s, 0)) > 3, false)"


def _z_stats(c):
    return f"(SELECT avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s FROM c)"


@query("outlier_zscore_drop", with_coerced(
    f"SELECT event_id, value, k FROM c, {_z_stats('value')}, {_z_stats('k')} WHERE NOT {_z_out('value')} AND NOT {_z_out('k')}"))
def q_outlier_zscore_drop(spark, sf):
    """I4: drop rows with |z| > 3 in any column."""
    return O.handle_outliers(coerced(spark, sf).select("event_id", *VK), VK, "zscore", "drop")


def _replace_sql(metric):
    if metric == "mode":
        rv = ("(SELECT CAST({c} AS DOUBLE) FROM c WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
    else:
        rv = {"mean": "(SELECT avg({c}) FROM c)", "median": "(SELECT median({c}) FROM c)"}[metric]
    sel = ", ".join(
        f"round(CASE WHEN {_iqr_out(c)} THEN {rv.format(c=c)} ELSE {c} END, 6) AS {c}" for c in VK)
    return with_coerced(f"SELECT event_id, {sel} FROM c, {_iqr_stats('value')}, {_iqr_stats('k')}")


def _replace(metric):
    def fn(spark, sf):
        out = O.handle_outliers(coerced(spark, sf).select("event_id", *VK), VK, "IQR", "replace", metric)
        return out.select("event_id", *[F.round(c, 6).alias(c) for c in VK])
    fn.__doc__ = f"I4: 1.5 IQR outliers replaced by the column {metric} (taken before replacement)."
    return fn


for _m in ("mean", "median", "mode"):
    query(f"outlier_replace_{_m}", _replace_sql(_m))(_replace(_m))


@query("quantile_trim",
       "SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.01) AS t0, quantile_cont(value, 0.99) AS t1 FROM events) "
       "WHERE value >= t0 AND value <= t1")
def q_quantile_trim(spark, sf):
    """Keep q01 <= x <= q99 (inclusive)."""
    from ..operators.clean import quantile_trim
    return quantile_trim(events(spark, sf).select("event_id", "value"), "value", 0.01, 0.99)


@query("threshold_filter", "SELECT event_id, value FROM events WHERE value < 100")
def q_threshold_filter(spark, sf):
    """Constant threshold (pushed to the scan)."""
    from ..operators.clean import threshold_filter
    return threshold_filter(events(spark, sf).select("event_id", "value"), "value", 100)
