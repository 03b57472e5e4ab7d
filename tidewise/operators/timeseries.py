"""Calendar resampling, spines and decomposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..functions.times import day_start
from .ordered import DEFAULT_BLOCK_ROWS, centered_mean_expr, windowed


STRETCH = 20  # ordinals are joined in stretches of 2**20


def future_spine(df: DataFrame, ts: str, periods: int, minutes: int) -> DataFrame:
    """``periods`` stamps every ``minutes`` after the last ``ts``:
    ``(step, ts)``; the start comes from one aggregate."""
    last = df.agg(F.max(F.col(qident(ts))).alias("_last"))
    steps = last.select("_last", F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("step"))
    return steps.select(
        F.col("step"),
        (F.col("_last") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("step") + 1) * minutes)).alias(ts),
    )


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """G1: UNION ALL by column name; columns missing on one side are NULL."""
    return df.unionByName(new, allowMissingColumns=True)


def day_spine(df: DataFrame, ts: str, name: str = "day") -> DataFrame:
    """One row per calendar day from the first to the last day of ``ts``."""
    b = df.agg(F.min(F.to_date(F.col(qident(ts)))).alias("_a"), F.max(F.to_date(F.col(qident(ts)))).alias("_b"))
    days = b.select(F.explode(F.sequence("_a", "_b")).alias("_d"))
    return days.select(F.to_timestamp_ntz(F.col("_d").cast("string")).alias(name))


def resample_daily_mean(df: DataFrame, ts: str, cols: Sequence[str], name: str = "day") -> DataFrame:
    """Calendar-day mean of each column; days without rows are present
    with NULL means (left join of the aggregate to the day spine)."""
    agg = df.groupBy(day_start(F.col(qident(ts))).alias(name)).agg(*[F.avg(F.col(qident(c))).alias(c) for c in cols])
    # one row per day in the span: a day-count-sized table
    return day_spine(df, ts, name).join(agg, name, "left")


def _same_series(by: Sequence[str]) -> Column:
    """Null-safe equality of the series columns with ``_s0``, ``_s1``, ..."""
    same = F.lit(True)
    for k, b in enumerate(by):
        same = same & F.col(qident(b)).eqNullSafe(F.col(f"_s{k}"))
    return same


def seasonal_decompose(df: DataFrame, col: str, period: int, order: Sequence[str], by: Sequence[str] = (),
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Additive decomposition (moving-average method).

    trend = centred moving average (E4); seasonal = mean of the detrended
    values at each ``ordinal % period`` minus the mean of those means;
    resid = x - trend - seasonal.  Adds ``trend, seasonal, resid`` and
    ``ordinal`` (per series).
    """
    by = list(by)
    h = period // 2
    base = windowed(df, {"trend": centered_mean_expr(col, period)}, order, by, before=h, after=h,
                    block_rows=block_rows, keep_ordinal="_g")
    # position within the series: global ordinal minus the series' first one
    if by:
        # per series and stretch of ordinals, so that a hot series is joined in many parts; NULL is a series
        chunk = F.shiftright(F.col("_g"), STRETCH)
        series = Window.partitionBy(*[F.col(f"_s{k}") for k in range(len(by))])
        own = base.groupBy(*[F.col(qident(b)).alias(f"_s{k}") for k, b in enumerate(by)], chunk.alias("_sc")).agg(F.min("_g").alias("_m"))
        own = own.withColumn("_g0", F.min("_m").over(series)).drop("_m")
        base = base.join(own, _same_series(by) & (chunk == F.col("_sc"))).withColumn("ordinal", F.col("_g") - F.col("_g0"))
        base = base.drop("_g", "_g0", "_sc", *[f"_s{k}" for k in range(len(by))])
    else:
        base = base.withColumnRenamed("_g", "ordinal")
    base = base.withColumn("_phase", F.pmod(F.col("ordinal"), F.lit(period)))
    det = F.col(qident(col)) - F.col("trend")
    keys = [F.col(qident(b)).alias(f"_s{k}") for k, b in enumerate(by)]
    means = base.groupBy(*keys, F.col("_phase").alias("_sp")).agg(F.avg(det).alias("_pm"))
    # at most ``period`` rows per series
    level = Window.partitionBy(*[F.col(f"_s{k}") for k in range(len(by))])
    centred = means.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(level)).drop("_pm")
    # ``period`` rows for one series: broadcast (size fixed by the period);
    # with many series the table has period x series rows and AQE decides
    centred = centred if by else F.broadcast(centred)
    out = base.join(centred, _same_series(by) & (F.col("_phase") == F.col("_sp")), "left")
    out = out.drop("_phase", "_sp", *[f"_s{k}" for k in range(len(by))])
    return out.withColumn("resid", F.col(qident(col)) - F.col("trend") - F.col("seasonal"))
