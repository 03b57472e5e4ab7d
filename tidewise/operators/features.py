"""Feature transforms (J1-J4) as ``pyspark.ml`` stages, and I7.

Spark's own stages give different numbers from the reference's:
``Imputer(median)`` picks an observed value, ``StandardScaler`` divides by
the sample std, ``MinMaxScaler`` maps a constant column to 0.5.  These
stages compute their statistics with one exact aggregate at ``fit`` and
apply them as column expressions at ``transform`` (no UDF), so they sit in
a ``Pipeline`` next to MLlib models and save/load with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._col import qident
from ..functions.times import calendar_fine
from .clean import drop_any_null
from .ordered import DEFAULT_BLOCK_ROWS, lag_exprs, trailing_mean_expr, windowed


class _StatsParams(HasInputCols):
    stats = Param(Params._dummy(), "stats", "per-column statistics (flattened)", typeConverter=TypeConverters.toListFloat)

    def _col_stats(self, k: int) -> list[list[float | None]]:
        flat = self.getOrDefault(self.stats)
        cols = self.getInputCols()
        return [[None if v != v else v for v in flat[i * k:(i + 1) * k]] for i in range(len(cols))]


def _flatten(row, names) -> list[float]:
    return [float("nan") if row[n] is None else float(row[n]) for n in names]


class ExactImputerModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills NULLs with the fitted exact median; all-NULL columns are dropped."""

    @keyword_only
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, (med,) in zip(self.getInputCols(), self._col_stats(1)):
            out = out.drop(c) if med is None else out.withColumn(c, F.coalesce(F.col(qident(c)), F.lit(med)))
        return out


class ExactImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation with the exact interpolated median of ``fit``'s data."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ExactImputerModel:
        from .quantiles import quantile_values
        from .stats import nan_safe

        cols = self.getInputCols()
        d = nan_safe(df.select(*[F.col(qident(c)).cast("double").alias(c) for c in cols]))
        med = {c: q for (c, _), q in quantile_values(d, cols, (0.5,)).items()}
        return ExactImputerModel(inputCols=cols, stats=[float("nan") if med.get(c) is None else float(med[c]) for c in cols])


class PopStandardScalerModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        ex = {}
        for c, (m, s) in zip(self.getInputCols(), self._col_stats(2)):
            x = F.col(qident(c)).cast("double")
            ex[c] = F.lit(0.0) * x if not s else (x - F.lit(m)) / F.lit(s)
        return df.withColumns(ex)


class PopStandardScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - mean) / std_pop``; a constant column becomes 0."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopStandardScalerModel:
        cols = self.getInputCols()
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(qident(c)).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        names = [n for i in range(len(cols)) for n in (f"m{i}", f"s{i}")]
        return PopStandardScalerModel(inputCols=cols, stats=_flatten(row, names))


class ExactMinMaxScalerModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        ex = {}
        for c, (lo, hi) in zip(self.getInputCols(), self._col_stats(2)):
            x = F.col(qident(c)).cast("double")
            ex[c] = F.lit(0.0) * x if lo is None or hi is None or hi == lo else (x - F.lit(lo)) / F.lit(hi - lo)
        return df.withColumns(ex)


class ExactMinMaxScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - min) / (max - min)``; a constant column becomes 0; no clipping."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ExactMinMaxScalerModel:
        cols = self.getInputCols()
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(qident(c)).cast("double")
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
        row = df.agg(*aggs).first()
        names = [n for i in range(len(cols)) for n in (f"a{i}", f"b{i}")]
        return ExactMinMaxScalerModel(inputCols=cols, stats=_flatten(row, names))


def hf_features(df: DataFrame, target: str, ts: str, order: Sequence[str], steps_per_hour: int = 6,
                by: Sequence[str] = (), block_rows: int = DEFAULT_BLOCK_ROWS, drop_nulls: bool = True) -> DataFrame:
    """Fine calendar parts (H7), 1 h / 24 h lags (E2) and trailing means
    (E3) of ``target``, then rows with any NULL dropped (B11) unless
    ``drop_nulls`` is False (used when scoring a row whose target is unknown)."""
    day = 24 * steps_per_hour
    t = target
    exprs = {}
    exprs.update(lag_exprs(t, [steps_per_hour, day], [f"lag_{t}_1_hora", f"lag_{t}_24_horas"]))
    exprs[f"rolling_mean_{t}_1_hora"] = trailing_mean_expr(t, steps_per_hour)
    exprs[f"rolling_mean_{t}_24_horas"] = trailing_mean_expr(t, day)
    out = df.withColumns(calendar_fine(F.col(qident(ts))))
    out = windowed(out, exprs, order, by, before=day, block_rows=block_rows)
    return drop_any_null(out) if drop_nulls else out
