"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import drop_any_null
from ..operators.features import ExactImputer, ExactMinMaxScaler, PopStandardScaler, hf_features
from .common import LINEITEM_NUM, coerced, table
from .q_clean import CLEAN_CTES, clean_flow_df
from .registry import query
from .sqlparts import with_coerced

VK = ["value", "k"]


@query("impute_median", with_coerced(
    "SELECT event_id, coalesce(value, (SELECT median(value) FROM c)) AS value, coalesce(k, (SELECT median(k) FROM c)) AS k FROM c"))
def q_impute_median(spark, sf):
    """NULLs -> exact median (fitted on the same table)."""
    c = coerced(spark, sf).select("event_id", *VK)
    return ExactImputer(inputCols=VK).fit(c).transform(c)


def _scale_sql(expr):
    cols = ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in LINEITEM_NUM)
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem"


@query("standard_scale", _scale_sql(
    "coalesce(({c} - (SELECT avg({c}) FROM lineitem)) / nullif((SELECT stddev_pop({c}) FROM lineitem), 0), 0.0 * {c})"))
def q_standard_scale(spark, sf):
    """Population-std standard scaling of lineitem's numeric columns."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_NUM)
    out = PopStandardScaler(inputCols=LINEITEM_NUM).fit(li).transform(li)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in LINEITEM_NUM])


@query("minmax_scale", _scale_sql(
    "coalesce(({c} - (SELECT min({c}) FROM lineitem)) / nullif((SELECT max({c}) - min({c}) FROM lineitem), 0), 0.0 * {c})"))
def q_minmax_scale(spark, sf):
    """Min-max scaling (constant -> 0, no clipping)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_NUM)
    out = ExactMinMaxScaler(inputCols=LINEITEM_NUM).fit(li).transform(li)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in LINEITEM_NUM])


_W = "OVER (ORDER BY ts, event_id"


def _roll(n):
    w = f"{_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(value) {w} = {n} THEN avg(value) {w} END"


_HF_COLS = ["hora", "minuto", "dia_de_semana", "dia_del_ano", "lag_value_1_hora", "lag_value_24_horas",
            "rolling_mean_value_1_hora", "rolling_mean_value_24_horas"]


@query("hf_features", with_coerced(
    "SELECT event_id, k, value, hora, minuto, dia_de_semana, dia_del_ano, lag_value_1_hora, lag_value_24_horas, "
    "round(rolling_mean_value_1_hora, 6) AS rolling_mean_value_1_hora, round(rolling_mean_value_24_horas, 6) AS rolling_mean_value_24_horas "
    "FROM hf WHERE k IS NOT NULL AND value IS NOT NULL AND lag_value_1_hora IS NOT NULL AND lag_value_24_horas IS NOT NULL "
    "AND rolling_mean_value_1_hora IS NOT NULL AND rolling_mean_value_24_horas IS NOT NULL",
    CLEAN_CTES + ", hf AS (SELECT event_id, k, value, CAST(hour(ts) AS BIGINT) AS hora, CAST(minute(ts) AS BIGINT) AS minuto, "
    "CAST(isodow(ts) - 1 AS BIGINT) AS dia_de_semana, CAST(dayofyear(ts) AS BIGINT) AS dia_del_ano, "
    f"lag(value, 6) {_W}) AS lag_value_1_hora, lag(value, 144) {_W}) AS lag_value_24_horas, "
    f"{_roll(6)} AS rolling_mean_value_1_hora, {_roll(144)} AS rolling_mean_value_24_horas "
    "FROM (SELECT * FROM cl WHERE value IS NOT NULL AND k IS NOT NULL))"))
def q_hf_features(spark, sf):
    """High-frequency features of the cleaned series (I5 output, then B11)."""
    cl = drop_any_null(clean_flow_df(spark, sf).select("event_id", "ts", "value", "k"))
    out = hf_features(cl, "value", "ts", ["ts", "event_id"]).drop("ts")
    return out.select("event_id", "k", "value", *[F.round(c, 6).alias(c) if c.startswith("rolling") else F.col(c) for c in _HF_COLS])
