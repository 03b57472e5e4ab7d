"""Scalar-function queries (2.H) and name cleaning (B1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..functions import times as TM
from .common import events, polluted_events
from .registry import query
from .sqlparts import num, tokens_list, ts, with_polluted


@query("to_number", with_polluted(f"SELECT event_id, raw_value, raw_k, {num('raw_value')} AS value, {num('raw_k')} AS k FROM p"))
def q_to_number(spark, sf):
    """H1 on both polluted numeric texts."""
    p = polluted_events(spark, sf)
    return p.select("event_id", "raw_value", "raw_k", N.to_number("raw_value").alias("value"), N.to_number("raw_k").alias("k"))


@query("null_tokens", with_polluted(
    f"SELECT event_id, CASE WHEN raw_value IN ({tokens_list()}) THEN NULL ELSE raw_value END AS value_text, "
    f"CASE WHEN raw_k IN ({tokens_list()}) THEN NULL ELSE raw_k END AS k_text FROM p"))
def q_null_tokens(spark, sf):
    """H2: invalid spellings -> NULL on the text columns."""
    p = polluted_events(spark, sf)
    return p.select("event_id", N.null_tokens("raw_value").alias("value_text"), N.null_tokens("raw_k").alias("k_text"))


@query("decimal_comma", with_polluted(
    "SELECT event_id, comma_text, " + num("replace(comma_text, ',', '.')") + " AS value "
    "FROM (SELECT event_id, replace(raw_value, '.', ',') AS comma_text FROM p)"))
def q_decimal_comma(spark, sf):
    """H3: text written with a decimal comma (stand-in: the polluted value
    with '.' -> ',') parsed back to a number."""
    p = polluted_events(spark, sf).select("event_id", F.replace("raw_value", F.lit("."), F.lit(",")).alias("comma_text"))
    return p.select("event_id", "comma_text", N.decimal_comma("comma_text").alias("value"))


@query("parse_ts", with_polluted(f"SELECT event_id, raw_ts, {ts('raw_ts')} AS ts FROM p"))
def q_parse_ts(spark, sf):
    """H4: fixed pattern, invalid -> NULL."""
    p = polluted_events(spark, sf)
    return p.select("event_id", "raw_ts", TM.to_ts("raw_ts").alias("ts"))


_MULTI_SQL = with_polluted(
    "SELECT event_id, mixed_ts, COALESCE(" + ts("mixed_ts") + ", "
    "CASE WHEN regexp_matches(mixed_ts, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$') "
    "THEN try_strptime(mixed_ts, '%Y-%m-%d %H:%M:%S') END) AS ts FROM ("
    "SELECT p.event_id, CASE WHEN p.event_id % 2 = 0 THEN p.raw_ts ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS mixed_ts "
    "FROM p JOIN events e ON p.event_id = e.event_id)"
)


@query("parse_ts_multi", _MULTI_SQL)
def q_parse_ts_multi(spark, sf):
    """H5: a declared list of patterns, first that parses wins.  Input text
    alternates between the raw pattern and ISO text."""
    p = polluted_events(spark, sf).select("event_id", "raw_ts")
    e = events(spark, sf).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("iso"))
    m = p.join(e, "event_id").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.col("raw_ts")).otherwise(F.col("iso")).alias("mixed_ts")
    )
    return m.select("event_id", "mixed_ts", TM.to_ts_multi("mixed_ts", [TM.RAW_TS_FORMAT, "yyyy-MM-dd HH:mm:ss"]).alias("ts"))


@query("calendar_features",
       "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS dayofweek, "
       "CAST(month(ts) AS BIGINT) AS month FROM events")
def q_calendar(spark, sf):
    """H6: hour, dayofweek (Monday = 0), month."""
    e = events(spark, sf)
    return e.select("event_id", *[v.alias(k) for k, v in TM.calendar_parts("ts").items()])


@query("calendar_fine",
       "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hora, CAST(minute(ts) AS BIGINT) AS minuto, "
       "CAST(isodow(ts) - 1 AS BIGINT) AS dia_de_semana, CAST(dayofyear(ts) AS BIGINT) AS dia_del_ano FROM events")
def q_calendar_fine(spark, sf):
    """H7: hora, minuto, dia_de_semana, dia_del_ano."""
    e = events(spark, sf)
    return e.select("event_id", *[v.alias(k) for k, v in TM.calendar_fine("ts").items()])


@query("norm_text", with_polluted(
    "SELECT event_id, regexp_replace(lower(trim(mixed_type_col)), '[^0-9a-z]+', '', 'g') AS mixed_norm, "
    "regexp_replace(lower(trim(raw_value)), '[^0-9a-z]+', '', 'g') AS value_norm FROM p"))
def q_norm_text(spark, sf):
    """H9 column form on two polluted text columns."""
    p = polluted_events(spark, sf)
    return p.select("event_id", T.norm_text("mixed_type_col").alias("mixed_norm"), T.norm_text("raw_value").alias("value_norm"))


@query("add_interval", "SELECT event_id, ts + INTERVAL 10 MINUTE AS next_ts FROM events")
def q_add_interval(spark, sf):
    """``ts + 10 minutes``."""
    return events(spark, sf).select("event_id", TM.add_minutes("ts", 10).alias("next_ts"))


_LABEL_SQL = (
    "SELECT event_id, raw_label, array_to_string(list_transform(string_split(lower(replace(raw_label, '_', ' ')), ' '), "
    "lambda w: upper(w[1:1]) || w[2:]), ' ') AS label FROM "
    "(SELECT event_id, event_type || '_zone_' || CAST(user_id % 3 + 1 AS VARCHAR) || '_power_consumption' AS raw_label FROM events)"
)


@query("label_text", _LABEL_SQL)
def q_label_text(spark, sf):
    """``_`` -> space + title case on snake_case labels built per event."""
    e = events(spark, sf).select(
        "event_id",
        F.concat_ws("_", "event_type", F.lit("zone"), (F.col("user_id") % 3 + 1).cast("string"), F.lit("power_consumption")).alias("raw_label"),
    )
    return e.select("event_id", "raw_label", T.label_text("raw_label").alias("label"))


_NAMES_SQL = (
    'SELECT event_id AS event_id, ts AS datetime, value AS zone_2_power_consumption, '
    'CAST(user_id AS DOUBLE) AS wind_speed, event_type AS general_diffuse_flows FROM events'
)


@query("clean_names", _NAMES_SQL)
def q_clean_names(spark, sf):
    """B1: reference-style headers (double spaces, padding, capitals) cleaned."""
    e = events(spark, sf).select(
        F.col("event_id").alias("Event_ID"),
        F.col("ts").alias("DateTime"),
        F.col("value").alias("Zone 2  Power Consumption"),
        F.col("user_id").cast("double").alias(" Wind Speed "),
        F.col("event_type").alias("general diffuse flows"),
    )
    return T.clean_names(e)


@query("zscore", "SELECT event_id, round((value - avg(value) OVER ()) / nullif(stddev_pop(value) OVER (), 0), 6) AS z FROM events")
def q_zscore(spark, sf):
    """Population z-score from one broadcast statistics row."""
    from ..operators.outliers import zscore
    return zscore(events(spark, sf), "value").select("event_id", F.round("value_z", 6).alias("z"))
