"""Fused per-column statistics.

Every report over several columns is ONE aggregate over the table: the
per-column expressions are laid side by side in a single ``agg`` (partial
aggregation on the map side, one tiny final row), then turned into a long
``(column, stat...)`` table with ``stack``.  Nothing is looped per column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .._col import qident, qtext


def nan_safe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN -> NULL on the floating columns among ``cols`` (all by default).

    The null model is decided once: pandas skips NaN like a missing value,
    while Spark's ``avg``/``max``/``percentile`` treat NaN as a value (the
    largest).  A projection, so it costs nothing extra at run time.
    """
    want = set(cols) if cols is not None else None
    ex = {}
    for f in df.schema.fields:
        if (want is None or f.name in want) and isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.col(qident(f.name))
            ex[f.name] = F.when(~F.isnan(c), c)
    return df.withColumns(ex) if ex else df


def fused_long(
    df: DataFrame,
    cols: Sequence[str],
    stats: dict[str, Callable[[Column], Column]],
    name_col: str = "col_name",
) -> DataFrame:
    """One aggregate computing ``stats`` for every column, returned long.

    Result: one row per input column with ``name_col`` plus one column per
    stat (in ``stats`` order).
    """
    cols = list(cols)
    df = nan_safe(df, cols)
    keys = list(stats)
    aggs = []
    for i, c in enumerate(cols):
        for j, k in enumerate(keys):
            aggs.append(stats[k](F.col(qident(c))).alias(f"_s{i}_{j}"))
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        parts.append(qtext(c))
        parts.extend(f"_s{i}_{j}" for j in range(len(keys)))
    out_names = ", ".join([qident(name_col)] + [qident(k) for k in keys])
    return wide.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) AS ({out_names})")


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "col_name", value: str = "value") -> DataFrame:
    """Wide -> long, values cast to a common type by Spark's rules."""
    return df.unpivot(list(ids), list(cols), name, value)


def sample_skewness(c: Column) -> Column:
    """Adjusted Fisher-Pearson G1 from Spark's population g1."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: Column) -> Column:
    """Excess, sample-adjusted G2 from Spark's population g2."""
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson on pair-complete rows; a constant side gives NULL.

    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode,
    so the ratio is written with ``nullif``.
    """
    both = a.isNotNull() & b.isNotNull()
    am, bm = F.when(both, a), F.when(both, b)
    den = F.stddev_pop(am) * F.stddev_pop(bm)
    return F.covar_pop(am, bm) / F.nullif(den, F.lit(0.0))


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for every non-null value of every column.

    Values are compared as text so several columns share one table.  The
    group-by combines map-side, so a value that fills a third of the table
    costs one row per task before the shuffle.
    """
    df = nan_safe(df, cols)
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(qident(c)).cast("string").alias("value")) for c in cols])
        ).alias("_kv")
    ).select("_kv.col_name", "_kv.value")
    return long.where(F.col("value").isNotNull()).groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"))


def mode_table(freq: DataFrame) -> DataFrame:
    """Most frequent value per column, smallest value on ties.

    Two aggregates over the (already reduced) frequency table; no group is
    collected into one task.
    """
    top = freq.groupBy("col_name").agg(F.max("n").alias("_top"))
    return (
        # one row per column: broadcast, so no column's values meet in one task
        freq.join(F.broadcast(top), "col_name")
        .where(F.col("n") == F.col("_top"))
        .groupBy("col_name")
        .agg(F.min("value").alias("top"), F.first("n").alias("freq"))
    )
