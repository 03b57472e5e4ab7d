"""Time-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.timeseries import resample_daily_mean, seasonal_decompose
from .common import events, table
from .registry import query


@query("daily_mean",
       "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders), "
       "g AS (SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, avg(o_totalprice) AS m FROM orders GROUP BY 1) "
       "SELECT CAST(d.day AS TIMESTAMP) AS day, round(g.m, 6) AS o_totalprice FROM "
       "(SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM b) d "
       "LEFT JOIN g ON g.day = d.day")
def q_daily_mean(spark, sf):
    """Calendar-day mean of order prices, empty days kept as NULL."""
    out = resample_daily_mean(table(spark, sf, "orders"), "o_orderdate", ["o_totalprice"])
    return out.select("day", F.round("o_totalprice", 6).alias("o_totalprice"))


@query("daily_mean_events",
       "WITH b AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS z FROM events), "
       "g AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, avg(value) AS m FROM events GROUP BY 1) "
       "SELECT CAST(d.day AS TIMESTAMP) AS day, round(g.m, 6) AS value FROM "
       "(SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM b) d "
       "LEFT JOIN g ON g.day = d.day")
def q_daily_mean_events(spark, sf):
    """D28 on the event stream: daily mean of ``value``."""
    out = resample_daily_mean(events(spark, sf), "ts", ["value"])
    return out.select("day", F.round("value", 6).alias("value"))


_DECOMP_SQL = (
    "WITH t AS (SELECT event_id, value, row_number() OVER w - 1 AS ordinal, "
    "CASE WHEN count(value) OVER w13 = 13 THEN avg(value) OVER w13 END AS trend FROM events "
    "WINDOW w AS (ORDER BY ts, event_id), w13 AS (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)), "
    "ph AS (SELECT ordinal % 13 AS phase, avg(value - trend) AS pm FROM t GROUP BY 1), "
    "se AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM ph) "
    "SELECT event_id, ordinal, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, "
    "round(value - trend - seasonal, 6) AS resid FROM t JOIN se ON se.phase = t.ordinal % 13"
)


@query("seasonal_decompose", _DECOMP_SQL)
def q_seasonal_decompose(spark, sf):
    """Additive decomposition of ``events.value`` with period 13."""
    e = events(spark, sf).select("event_id", "ts", "value")
    out = seasonal_decompose(e, "value", 13, ["ts", "event_id"])
    return out.select("event_id", "ordinal", *[F.round(c, 6).alias(c) for c in ("trend", "seasonal", "resid")])


_DECOMP_BY_SQL = (
    "WITH t AS (SELECT event_id, event_type, value, row_number() OVER w - 1 AS ordinal, "
    "CASE WHEN count(value) OVER w13 = 13 THEN avg(value) OVER w13 END AS trend FROM events "
    "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id), "
    "w13 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)), "
    "ph AS (SELECT event_type, ordinal % 13 AS phase, avg(value - trend) AS pm FROM t GROUP BY 1, 2), "
    "se AS (SELECT event_type, phase, pm - avg(pm) OVER (PARTITION BY event_type) AS seasonal FROM ph) "
    "SELECT t.event_id, t.event_type, t.ordinal, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, "
    "round(value - trend - seasonal, 6) AS resid FROM t JOIN se ON se.event_type = t.event_type AND se.phase = t.ordinal % 13"
)


@query("seasonal_decompose_by_type", _DECOMP_BY_SQL)
def q_seasonal_decompose_by_type(spark, sf):
    """J18 per series: additive decomposition (period 13) of every event type."""
    e = events(spark, sf).select("event_id", "event_type", "ts", "value")
    out = seasonal_decompose(e, "value", 13, ["ts", "event_id"], by=["event_type"])
    return out.select("event_id", "event_type", "ordinal", *[F.round(c, 6).alias(c) for c in ("trend", "seasonal", "resid")])
