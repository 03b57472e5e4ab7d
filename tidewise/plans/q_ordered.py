"""Ordered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import ts_text
from ..operators import ordered as OD
from .common import coerced, events
from .registry import query
from .sqlparts import with_coerced

ORDER = ["ts", "event_id"]
LAGS = [1, 24, 168]


def _lag_sql(part: str) -> str:
    w = f"OVER ({part} ORDER BY ts, event_id)"
    lags = ", ".join(f"lag(value, {L}) {w} AS value_lag{L}" for L in LAGS)
    return f"SELECT event_id, user_id, ts, value, {lags} FROM events"


@query("lag_features", _lag_sql("PARTITION BY user_id"))
def q_lag_features(spark, sf):
    """E1 per series (user): lags 1, 24, 168 rows of ``value``."""
    e = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return OD.add_lags(e, "value", LAGS, ORDER, by=["user_id"])


@query("lag_features_single", _lag_sql(""))
def q_lag_features_single(spark, sf):
    """E1 on one long series, without a single-partition window."""
    e = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return OD.add_lags(e, "value", LAGS, ORDER)


@query("lag_hour_day",
       "SELECT event_id, value, lag(value, 6) OVER (ORDER BY ts, event_id) AS lag_value_1_hora, "
       "lag(value, 144) OVER (ORDER BY ts, event_id) AS lag_value_24_horas FROM events")
def q_lag_hour_day(spark, sf):
    """Lags named by duration at 6 rows per hour."""
    e = events(spark, sf).select("event_id", "ts", "value")
    return OD.add_lags(e, "value", [6, 144], ORDER, names=["lag_value_1_hora", "lag_value_24_horas"]).drop("ts")


def _roll_sql(n: int) -> str:
    w = f"OVER (ORDER BY ts, event_id ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count(value) {w} = {n} THEN avg(value) {w} END, 6)"


@query("rolling_mean",
       f"SELECT event_id, value, {_roll_sql(6)} AS rolling_mean_value_1_hora, {_roll_sql(144)} AS rolling_mean_value_24_horas FROM events")
def q_rolling_mean(spark, sf):
    """Trailing means excluding the current row (6 and 144 rows)."""
    e = events(spark, sf).select("event_id", "ts", "value")
    out = OD.rolling_mean(e, "value", {"rolling_mean_value_1_hora": 6, "rolling_mean_value_24_horas": 144}, ORDER)
    return out.select("event_id", "value", *[F.round(c, 6).alias(c) for c in ("rolling_mean_value_1_hora", "rolling_mean_value_24_horas")])


@query("trend_component",
       "SELECT event_id, value, round(CASE WHEN count(value) OVER w = 13 THEN avg(value) OVER w END, 6) AS trend FROM events "
       "WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)")
def q_trend(spark, sf):
    """Centred 13-row moving average, NULL at both ends."""
    e = events(spark, sf).select("event_id", "ts", "value")
    out = OD.centered_mean(e, "value", 13, ORDER)
    return out.select("event_id", "value", F.round("trend", 6).alias("trend"))


@query("row_ordinal", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal FROM events")
def q_row_ordinal(spark, sf):
    """E5: 0-based position in time order, one long series."""
    return OD.with_ordinal(events(spark, sf).select("event_id", "ts"), ORDER).select("event_id", "ordinal")


@query("row_ordinal_by_user",
       "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal FROM events")
def q_row_ordinal_by_user(spark, sf):
    """E5 per series: the position restarts for each user."""
    return OD.with_ordinal(events(spark, sf).select("event_id", "user_id", "ts"), ORDER, by=["user_id"]).select(
        "event_id", "user_id", "ordinal")


@query("dedupe_first", with_coerced(
    "SELECT event_id, ts, value, k FROM c WHERE ts IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id) = 1"))
def q_dedupe_first(spark, sf):
    """First row per parsed timestamp (event id breaks ties)."""
    c = coerced(spark, sf).where(F.col("ts").isNotNull()).select("event_id", "ts", "value", "k")
    return OD.dedupe_first(c, ["ts"], ["event_id"])


@query("time_split",
       "SELECT event_id, ordinal, CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM "
       "(SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal, count(*) OVER () AS n FROM events)")
def q_time_split(spark, sf):
    """Chronological 70/30 split (time order, not a random shuffle)."""
    e = events(spark, sf).select("event_id", "ts")
    return OD.time_split(e, 0.3, ORDER).select("event_id", "ordinal", "split")


_FOLDS_SQL = (
    "WITH o AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal, count(*) OVER () AS n FROM events), "
    "f AS (SELECT i AS fold FROM range(0, 5) t(i)), "
    "j AS (SELECT fold, ordinal, n - (5 - fold) * (n // 6) AS ts0, n - (4 - fold) * (n // 6) AS ts1 FROM o, f) "
    "SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN ordinal < ts0 THEN 'train' ELSE 'test' END AS role, count(*) AS n_rows, "
    "min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal FROM j WHERE ordinal < ts1 GROUP BY 1, 2"
)


@query("ts_folds", _FOLDS_SQL)
def q_ts_folds(spark, sf):
    """Five expanding-window folds; rows per (fold, role) and their range."""
    e = events(spark, sf).select("event_id", "ts")
    f = OD.time_series_folds(e, 5, ORDER)
    return f.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"))


@query("last_n", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def q_last_n(spark, sf):
    """The last 200 rows of history (top-k, no global sort)."""
    return OD.last_n(events(spark, sf).select("event_id", "ts", "value"), 200, ORDER)


@query("last_n_by_user",
       "SELECT event_id, user_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20")
def q_last_n_by_user(spark, sf):
    """E9 per series: last 20 rows of every user."""
    return OD.last_n(events(spark, sf).select("event_id", "user_id", "ts", "value"), 20, ORDER, by=["user_id"])


@query("sort_nulls_last", with_coerced(
    "SELECT event_id, ts, row_number() OVER (ORDER BY ts ASC NULLS LAST, event_id) - 1 AS position FROM c"))
def q_sort_nulls_last(spark, sf):
    """time order with NULL time last; the position makes the order checkable."""
    c = coerced(spark, sf).select("event_id", "ts")
    return OD.with_ordinal(c, ORDER, name="position").select("event_id", "ts", "position")


@query("head_n", "SELECT event_id, ts, value FROM events ORDER BY event_id LIMIT 5")
def q_head_n(spark, sf):
    """first five rows in file (event id) order."""
    return OD.head_n(events(spark, sf).select("event_id", "ts", "value"), 5, ["event_id"])


@query("tail_n", "SELECT event_id, ts, value FROM events ORDER BY event_id DESC LIMIT 5")
def q_tail_n(spark, sf):
    """last five rows in file order."""
    return OD.last_n(events(spark, sf).select("event_id", "ts", "value"), 5, ["event_id"])


@query("events_page",
       "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime, user_id, event_type, value FROM events "
       "ORDER BY ts, event_id LIMIT 1000 OFFSET 2000")
def q_events_page(spark, sf):
    """Page 3 of 1000 rows in time order, time rendered as text."""
    e = events(spark, sf)
    items, _ = OD.page(e, ORDER, 3, 1000)
    return items.select("event_id", ts_text("ts").alias("datetime"), "user_id", "event_type", "value")


@query("events_page_total", "SELECT count(*) AS total FROM events")
def q_events_page_total(spark, sf):
    """The page's total row count."""
    _, total = OD.page(events(spark, sf), ORDER, 3, 1000)
    return total


@query("time_spine",
       "SELECT CAST(i AS INTEGER) AS step, (SELECT max(ts) FROM events) + INTERVAL 10 MINUTE * (i + 1) AS ts FROM range(0, 10) t(i)")
def q_time_spine(spark, sf):
    """Ten 10-minute stamps after the last observation."""
    from ..operators.timeseries import future_spine
    return future_spine(events(spark, sf), "ts", 10, 10)


@query("append_rows",
       "SELECT ts, value FROM events UNION ALL "
       "SELECT (SELECT max(ts) FROM events) + INTERVAL 10 MINUTE * (i + 1) AS ts, CAST(NULL AS DOUBLE) AS value FROM range(0, 10) t(i)")
def q_append_rows(spark, sf):
    """G1: history plus ten empty future rows, combined by column name."""
    from ..operators.timeseries import append_rows, future_spine
    e = events(spark, sf).select("ts", "value")
    fut = future_spine(e, "ts", 10, 10).select("ts")
    return append_rows(e, fut)


def _roll_by_sql(n: int) -> str:
    w = f"OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count(value) {w} = {n} THEN avg(value) {w} END, 6)"


@query("rolling_mean_by_user",
       f"SELECT event_id, user_id, value, {_roll_by_sql(6)} AS rolling_mean_value_1_hora, "
       f"{_roll_by_sql(144)} AS rolling_mean_value_24_horas FROM events")
def q_rolling_mean_by_user(spark, sf):
    """E3 per series (user): trailing 6- and 144-row means excluding the row."""
    e = events(spark, sf).select("event_id", "user_id", "ts", "value")
    out = OD.rolling_mean(e, "value", {"rolling_mean_value_1_hora": 6, "rolling_mean_value_24_horas": 144}, ORDER, by=["user_id"])
    return out.select("event_id", "user_id", "value",
                      *[F.round(c, 6).alias(c) for c in ("rolling_mean_value_1_hora", "rolling_mean_value_24_horas")])


@query("trend_by_type",
       "SELECT event_id, event_type, round(CASE WHEN count(value) OVER w = 13 THEN avg(value) OVER w END, 6) AS trend FROM events "
       "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)")
def q_trend_by_type(spark, sf):
    """E4 per series (event type): centred 13-row moving average."""
    e = events(spark, sf).select("event_id", "event_type", "ts", "value")
    out = OD.centered_mean(e, "value", 13, ORDER, by=["event_type"])
    return out.select("event_id", "event_type", F.round("trend", 6).alias("trend"))


@query("time_split_by_user",
       "SELECT event_id, user_id, ordinal, CASE WHEN ordinal >= n - ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM "
       "(SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal, "
       "count(*) OVER (PARTITION BY user_id) AS n FROM events)")
def q_time_split_by_user(spark, sf):
    """E7 per series: the last 30 % of every user's rows are test."""
    e = events(spark, sf).select("event_id", "user_id", "ts")
    return OD.time_split(e, 0.3, ORDER, by=["user_id"]).select("event_id", "user_id", "ordinal", "split")


WEEK = 7 * 144  # ten-minute rows


@query("rolling_mean_week",
       "SELECT event_id, value, round(CASE WHEN count(value) OVER w = 1008 THEN avg(value) OVER w END, 6) AS rolling_mean_value_week FROM events "
       "WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 1008 PRECEDING AND 1 PRECEDING)")
def q_rolling_mean_week(spark, sf):
    """A trailing mean over a week of ten-minute rows, two look-ups a row."""
    e = events(spark, sf).select("event_id", "ts", "value")
    out = OD.rolling_mean(e, "value", {"rolling_mean_value_week": WEEK}, ORDER)
    return out.select("event_id", "value", F.round("rolling_mean_value_week", 6).alias("rolling_mean_value_week"))


@query("trend_week_by_type",
       "SELECT event_id, event_type, round(CASE WHEN count(value) OVER w = 1009 THEN avg(value) OVER w END, 6) AS trend FROM events "
       "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 504 PRECEDING AND 504 FOLLOWING)")
def q_trend_week_by_type(spark, sf):
    """E4 per series (event type): the centred mean over a week, half of it on each side."""
    e = events(spark, sf).select("event_id", "event_type", "ts", "value")
    out = OD.centered_mean(e, "value", WEEK + 1, ORDER, by=["event_type"])
    return out.select("event_id", "event_type", F.round("trend", 6).alias("trend"))
