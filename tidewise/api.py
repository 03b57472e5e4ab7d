"""One import surface, under the operator names of the SURVEY inventory.

    from tidewise import api as tw
    tw.describe(df, ["a", "b"]); tw.add_lags(df, "ts", "value", [1, 24, 168])

Each name is the implementation itself or a small adapter where the
planned signature orders arguments differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._col import qident
from .functions.numbers import csv_nulls, decimal_comma, is_finite, nan_to_null, null_tokens, to_number  # noqa: F401  H1-H3
from .functions.text import (  # noqa: F401  B1-B3, B5, B6, B8, H9, H14, D31
    clean_name,
    clean_names,
    column_diff,
    date_like_columns,
    label_text,
    norm_name,
    norm_text,
    numeric_columns,
    resolve_column,
    text_columns,
    value_columns,
)
from .functions.text import ensure_columns as ensure_schema  # noqa: F401  A7
from .functions.times import add_minutes, calendar_fine, calendar_parts, to_ts, to_ts_multi, ts_text  # noqa: F401  H4-H7, H12, H15
from .operators.clean import (  # noqa: F401  B4, B7, B9-B14, B17, B18, C1, I5, I6
    CleanSpec,
    PreprocessSpec,
    aligned,
    clean,
    drop_any_null,
    drop_columns,
    drop_empty_columns,
    drop_nonfinite,
    drop_rows_min_nulls,
    drop_sparse_nulls,
    preprocess,
    quantile_trim,
    require,
    threshold_filter,
)
from .operators.clean import drop_sparse_nulls as drop_rows_null_in_sparse_cols  # noqa: F401  B12
from .operators.clean import quantile_trim as trim  # noqa: F401  B17
from .operators.features import ExactImputer, ExactMinMaxScaler, PopStandardScaler, hf_features  # noqa: F401  J1-J3, I7
from .operators.boost import Booster, fit_booster  # noqa: F401  J6
from .operators.boost import forecast_series as recursive_forecast  # noqa: F401  J16
from .operators.boost import search as random_search  # noqa: F401  J15
from .operators.models import (  # noqa: F401  J5-J11, J17, J20, C5
    GBT_PRODUCTION,
    align_forecast,
    compare_models,
    draw_params,
    hash_split,
    load_model,
    metrics_record,
    naive_predictions,
    ols_1d,
    pred_vs_actual,
    regression_metrics,
    regression_pipeline,
    save_model,
)
from .operators.models import hash_split as random_split  # noqa: F401  J17
from .operators.models import pred_vs_actual as fit_series  # noqa: F401  J11
from .operators.ordered import (  # noqa: F401  E5-E9, F1-F3, A6
    centered_mean,
    dedupe_first,
    head_n,
    last_n,
    page,
    rolling_mean,
    sort_time,
    time_series_folds,
    time_split,
    windowed,
    with_ordinal,
)
from .operators.outliers import (  # noqa: F401  B15, C3, D13, D16, D29, H11, I1-I4
    apply_fences,
    handle_outliers,
    iqr_fences,
    outlier_report,
    outside,
    replace_upper_outliers,
    zscore,
)
from .operators.profile import (  # noqa: F401  D1-D30
    box_stats,
    central_stats,
    corr_matrix,
    describe,
    describe_all,
    describe_text,
    duplicate_keys,
    duplicate_rows,
    duplicates,
    histogram,
    histogram_pair,
    info,
    mean_drift,
    missing_table,
    moments,
    n_unique,
    non_numeric,
    null_counts,
    null_pct,
    remaining_nulls,
    row_null_histogram,
    shape,
    size_comparison,
    top_values,
    ts_quality,
)
from .operators.profile import mean_drift as compare_means  # noqa: F401  C4
from .operators.profile import top_values as value_counts  # noqa: F401  D8
from .operators.quantiles import quantile_values, quantiles  # noqa: F401  D12
from .operators.timeseries import (  # noqa: F401  D28, G1, G2, J18, J19
    append_rows,
    day_spine,
    future_spine,
    resample_daily_mean,
    seasonal_decompose,
)
from .operators.timeseries import seasonal_decompose as decompose  # noqa: F401  J18
from .operators.var import fit as var_fit  # noqa: F401  J12
from .operators.var import forecast as var_forecast  # noqa: F401  J14
from .operators.var import select_order as var_select  # noqa: F401  J13
from .plans.jobs import JobConfig, evaluate_job, load_job, preprocess_job, profile_job, run_all, train_job  # noqa: F401  M1-M6
from .sources.files import load, load_file, read_csv, read_parquet, write_csv, write_metrics, write_parquet, write_profile  # noqa: F401
from .sources.jdbc import count_options, options_from_env, page_options, read_jdbc, table_options  # noqa: F401  A5, A6
from .sources.runlog import best_run, log_run, runs  # noqa: F401  A12
from .streaming.stream_clean import clean_stream  # noqa: F401


def add_lags(df: DataFrame, ts: str, target: str, lags: Sequence[int], tiebreak: str | None = None,
             by: Sequence[str] = ()) -> DataFrame:
    """``{target}_lag{L}`` by rows in time order (per series with ``by``)."""
    from .operators.ordered import add_lags as _add_lags

    return _add_lags(df, target, lags, [ts, *([tiebreak] if tiebreak else [])], by=by)


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    """H6: hour, dayofweek (Monday = 0), month; unchanged if ``ts`` is absent."""
    return df.withColumns(calendar_parts(F.col(qident(ts)))) if ts in df.columns else df


def features(df: DataFrame, target: str) -> list[str]:
    """Every column but the target, in order (the feature order a
    fitted pipeline keeps)."""
    return [c for c in df.columns if c != target]


def time_spine(df: DataFrame, ts: str, periods: int = 10, minutes: int = 10) -> DataFrame:
    """``periods`` stamps every ``minutes`` after the last ``ts``."""
    return future_spine(df, ts, periods, minutes)


def skew(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample skewness per column."""
    return moments(df, cols).select("col_name", "skewness")


def kurt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample excess kurtosis per column."""
    return moments(df, cols).select("col_name", "kurtosis")


def resample(df: DataFrame, ts: str, cols: Sequence[str], rule: str = "day", how: str = "mean") -> DataFrame:
    """Calendar-day mean with empty days kept (the only rule the
    reference uses)."""
    if rule != "day" or how != "mean":
        raise ValueError("only rule='day', how='mean' is provided")
    return resample_daily_mean(df, ts, cols)


def null_outside_fences(df: DataFrame, fences: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values outside the (reference table's) fences -> NULL."""
    return apply_fences(df, fences, cols, action="null")
