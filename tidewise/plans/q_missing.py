"""Missing values and typed inputs: NaN, NULL series and time columns that are times already."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import to_ts
from ..operators import clean as CL
from ..operators import ordered as OD
from ..operators import outliers as O
from ..operators.timeseries import seasonal_decompose
from .common import LINEITEM_NUM, events, original_events, table
from .q_clean import CLEAN_CTES, PRE_CTES, polluted_named
from .registry import query
from .sqlparts import with_coerced

ORDER = ["ts", "event_id"]
# every fifth user is not known
_SERIES = "CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END"
_S = f"s AS (SELECT event_id, ts, value, {_SERIES} AS series FROM events)"


def _series(spark, sf):
    return events(spark, sf).select("event_id", "ts", "value", F.expr(_SERIES).alias("series"))


def _typed(spark, sf):
    """The polluted table with a time column that has a time type (invalid texts are NULL)."""
    return polluted_named(spark, sf).withColumn("raw_ts", to_ts("raw_ts"))


@query("preprocess_typed_ts", with_coerced(
    "SELECT event_id, user_id, event_type, value, k, hour, dayofweek, month, value_lag1, value_lag24, value_lag168, ordinal, "
    "CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM a6", PRE_CTES))
def q_preprocess_typed_ts(spark, sf):
    """I6 on a typed time column: the same rows as from text."""
    out = CL.preprocess(_typed(spark, sf))
    return out.select("event_id", "user_id", "event_type", "value", "k", "hour", "dayofweek", "month",
                      "value_lag1", "value_lag24", "value_lag168", "ordinal", "split")


@query("clean_typed_ts", with_coerced("SELECT event_id, user_id, event_type, ts, value, k FROM cl", CLEAN_CTES))
def q_clean_typed_ts(spark, sf):
    """I5 on a typed time column: the same rows as from text."""
    return CL.clean(_typed(spark, sf), original_events(spark, sf)).select("event_id", "user_id", "event_type", "ts", "value", "k")


@query("drop_sparse_nulls_nan",
       "SELECT event_id, value AS x, CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS y FROM events WHERE event_id % 50 <> 0")
def q_drop_sparse_nulls_nan(spark, sf):
    """NaN is missing; 2 % of it drops rows, 50 % leaves the column alone."""
    nan = F.lit(float("nan"))
    e = events(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 50 == 0, nan).otherwise(F.col("value")).alias("x"),
        F.when(F.col("event_id") % 2 == 0, nan).otherwise(F.col("value")).alias("y"))
    return CL.drop_sparse_nulls(e, 5.0)


@query("drop_empty_columns_nan", "SELECT event_id, value AS x FROM events")
def q_drop_empty_columns_nan(spark, sf):
    """A column of NaN alone is empty."""
    e = events(spark, sf)
    return CL.drop_empty_columns(e.select("event_id", F.col("value").alias("x"), (F.col("value") * float("nan")).alias("z")))


@query("row_null_threshold_nan",
       "SELECT event_id, x, y FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS x, "
       "CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS y FROM events) WHERE x IS NOT NULL OR y IS NOT NULL")
def q_row_null_threshold_nan(spark, sf):
    """Rows with fewer than two missing values among two, NaN included."""
    nan = F.lit(float("nan"))
    e = events(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 3 == 0, nan).otherwise(F.col("value")).alias("x"),
        F.when(F.col("event_id") % 2 == 0, nan).otherwise(F.col("value")).alias("y"))
    return CL.drop_rows_min_nulls(e, ["x", "y"], 2)


@query("row_ordinal_null_series",
       f"WITH {_S} SELECT event_id, series, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) - 1 AS ordinal FROM s")
def q_row_ordinal_null_series(spark, sf):
    """E5 per series; the rows without a series are one."""
    return OD.with_ordinal(_series(spark, sf), ORDER, by=["series"]).select("event_id", "series", "ordinal")


@query("time_split_null_series",
       f"WITH {_S} SELECT event_id, series, ordinal, CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM "
       "(SELECT event_id, series, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) - 1 AS ordinal, "
       "count(*) OVER (PARTITION BY series) AS n FROM s)")
def q_time_split_null_series(spark, sf):
    """E7 per series; the rows without a series are one."""
    return OD.time_split(_series(spark, sf), 0.3, ORDER, by=["series"]).select("event_id", "series", "ordinal", "split")


@query("seasonal_decompose_null_series",
       f"WITH {_S}, t AS (SELECT event_id, series, value, row_number() OVER w - 1 AS ordinal, "
       "CASE WHEN count(value) OVER w13 = 13 THEN avg(value) OVER w13 END AS trend FROM s "
       "WINDOW w AS (PARTITION BY series ORDER BY ts, event_id), "
       "w13 AS (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)), "
       "ph AS (SELECT series, ordinal % 13 AS phase, avg(value - trend) AS pm FROM t GROUP BY 1, 2), "
       "se AS (SELECT series, phase, pm - avg(pm) OVER (PARTITION BY series) AS seasonal FROM ph) "
       "SELECT t.event_id, t.series, t.ordinal, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, "
       "round(value - trend - seasonal, 6) AS resid FROM t JOIN se ON se.series IS NOT DISTINCT FROM t.series AND se.phase = t.ordinal % 13")
def q_seasonal_decompose_null_series(spark, sf):
    """J18 per series; the rows without a series are one."""
    out = seasonal_decompose(_series(spark, sf), "value", 13, ORDER, by=["series"])
    return out.select("event_id", "series", "ordinal", *[F.round(c, 6).alias(c) for c in ("trend", "seasonal", "resid")])


@query("outlier_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count({c}) AS total, count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers, "
    f"round(count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100 / count({c}), 6) AS percent "
    f"FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)" for c in LINEITEM_NUM))
def q_outlier_counts(spark, sf):
    """I4's report: total, outliers and percent of each column."""
    return O.outlier_counts(table(spark, sf, "lineitem"), LINEITEM_NUM)


@query("events_deep_page",
       "SELECT event_id, user_id, value FROM events ORDER BY ts, event_id LIMIT 300 OFFSET (SELECT count(*) - 500 FROM events)")
def q_events_deep_page(spark, sf):
    """A page near the end, found by position."""
    at = OD.with_ordinal(events(spark, sf).select("event_id", "user_id", "value", "ts"), ORDER, name="at", total="n")
    return at.where("at >= n - 500 AND at < n - 200").select("event_id", "user_id", "value")
