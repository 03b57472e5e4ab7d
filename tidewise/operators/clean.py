"""Row/column cleaning (B4, B7, B9-B14, B16, B19) and the two cleaning flows
(I5 notebook form, I6 production form).

Everything is a ``DataFrame -> DataFrame`` step; the flows are chains of
``df.transform``.  The only driver-side decisions are on metadata: which
columns are empty (B7) or sparse (B12), each from one aggregate row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .._col import qident
from ..functions.numbers import is_finite, null_tokens, to_number
from ..functions.text import under_names
from ..functions.times import RAW_TS_FORMAT, calendar_parts, time_column
from ..session import cut_lineage, shuffle_partitions_for
from .ordered import DEFAULT_BLOCK_ROWS, dedupe_first, lag_exprs, renumbered, split_by_position, windowed
from .outliers import apply_fences, iqr_fences, replace_upper_outliers
from .quantiles import quantile_values
from .stats import nan_safe


def _c(n: str) -> Column:
    return F.col(qident(n))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column."""
    return df.dropna(how="any")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose non-null count is 0 (one aggregate row; NaN is missing)."""
    counts = nan_safe(df).agg(*[F.count(_c(c)).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"_{i}"] > 0]
    return df.select(*[_c(c) for c in keep])


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Percent NULL (or NaN) per column, from one aggregate row (metadata only)."""
    cols = list(cols or df.columns)
    row = nan_safe(df, cols).agg(*[(F.avg(_c(c).isNull().cast("double")) * 100).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"_{i}"] if row[f"_{i}"] is not None else 0.0) for i, c in enumerate(cols)}


def drop_sparse_nulls(df: DataFrame, pct: float = 5.0) -> DataFrame:
    """Columns with NULL rate strictly below ``pct`` % form the subset;
    rows NULL in any of them are dropped; sparser columns are left alone.
    NaN is missing and becomes NULL."""
    df = nan_safe(df)
    rates = null_rates(df)
    subset = [c for c, r in rates.items() if r < pct]
    return df.dropna(subset=subset) if subset else df


def null_count(cols: Sequence[str]) -> Column:
    return sum((_c(c).isNull().cast("int") for c in cols), F.lit(0))


def drop_rows_min_nulls(df: DataFrame, cols: Sequence[str], k: int = 4) -> DataFrame:
    """Keep rows with fewer than ``k`` NULLs (or NaNs) among ``cols``; NaN becomes NULL."""
    return nan_safe(df, cols).where(null_count(cols) < k)


def drop_nonfinite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """+-Inf (and NULL) in any of ``cols`` drops the row."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & is_finite(_c(c))
    return df.where(cond)


def aligned(y: DataFrame, x: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``y`` whose key survived ``x``'s filters (left semi join)."""
    return y.join(x.select(*key), list(key), "left_semi")


# ---------------------------------------------------------------- flows

@dataclass
class CleanSpec:
    """Parameters of the notebook cleaning flow."""

    raw_ts: str = "raw_ts"
    ts: str = "ts"
    value_cols: Sequence[str] = ("value", "k")
    tiebreak: str = "event_id"
    drop: Sequence[str] = ("mixed_type_col",)
    ts_format: str = RAW_TS_FORMAT
    fence_k: float = 3.0
    fence_floor: float | None = 0.0
    max_nulls: int = 2  # keep rows with fewer NULLs than this among value_cols
    quantile_method: str = "exact"  # or "approx"


def clean(df: DataFrame, reference: DataFrame | None, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Drop the mixed column -> invalid tokens and text -> numbers ->
    drop missing and unparseable time -> first row per timestamp ->
    values outside the reference table's 3-IQR fences -> NULL -> drop rows
    with too many NULLs.  Fences come from ``reference`` (the original
    table) or, when it is None, from the data itself."""
    vals = list(spec.value_cols)
    out = drop_columns(nan_safe(df), spec.drop)
    out = out.withColumns({c: to_number(null_tokens(_c(c).cast("string"))) for c in vals if c in out.columns})
    out = out.withColumn(spec.ts, time_column(out, spec.raw_ts, spec.ts_format))
    if isinstance(df.schema[spec.raw_ts].dataType, StringType):
        some = out.agg(F.count(_c(spec.raw_ts)), F.count(_c(spec.ts))).first()
        if some[0] and not some[1]:
            raise ValueError(f"no value of {spec.raw_ts!r} has the format {spec.ts_format!r}")
    out = out.where(_c(spec.ts).isNotNull())
    out = dedupe_first(out, [spec.ts], [spec.tiebreak])
    fences = iqr_fences(reference if reference is not None else out, vals, k=spec.fence_k, floor=spec.fence_floor,
                        quantile_method=spec.quantile_method)
    out = apply_fences(out, fences, vals, action="null")
    return drop_rows_min_nulls(out, vals, spec.max_nulls)


@dataclass
class PreprocessSpec:
    """Parameters of the production preprocessing flow."""

    raw_ts: str = "raw_ts"
    ts: str = "ts"
    target: str = "value"
    features: Sequence[str] = ("k",)
    ids: Sequence[str] = ("event_id", "user_id")
    tiebreak: str = "event_id"  # "" if there is no id: rows of one time are then ordered by their values
    drop: Sequence[str] = ("mixed_type_col",)
    coerce: str = "all"  # "target" reproduces the production code exactly
    lags: Sequence[int] = (1, 24, 168)
    test_size: float = 0.3
    sparse_pct: float = 5.0
    outlier_k: float = 2.0
    block_rows: int = DEFAULT_BLOCK_ROWS
    quantile_method: str = "exact"  # or "approx"
    dedupe: bool = False  # keep the first row per timestamp (the notebooks do; production does not)
    extra_drop: Sequence[str] = field(default_factory=lambda: ["raw_ts"])
    fit_on: str = "all"  # rows of the outlier statistics; "train" keeps the test part out of them


def preprocess(df: DataFrame, spec: PreprocessSpec = PreprocessSpec()) -> DataFrame:
    """Drop mixed -> parse time -> coerce -> require target ->
    (optional first row per time stamp) -> sparse NULL rows -> upper
    outliers to median -> calendar -> lags -> drop NULL rows -> drop
    non-finite features -> chronological split flag.

    Returns every feature, the target, ``ordinal`` and ``split``; the time
    column is dropped as in the reference.

    The texts are parsed once, into the checkpoint folder.
    The table is sorted once: the split numbers the rows that are left by the
    ordinal of the lags.  With ``fit_on="train"`` the split comes first and
    the outlier statistics are those of its train rows; target, features and
    lags are then replaced by them.  Which rows are left is decided before
    any replacement, so a row with an infinite feature or lag goes.
    """
    if spec.fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {spec.fit_on!r}")
    t = spec.target
    parts = shuffle_partitions_for(df)  # of the input: later plans have no estimate
    df = under_names(df, [spec.raw_ts, spec.target, *spec.features])
    out = drop_columns(nan_safe(df), spec.drop)
    extra = [c for c in spec.extra_drop if c != spec.ts]
    out = out.withColumn(spec.ts, time_column(out, spec.raw_ts)).transform(lambda d: drop_columns(d, extra))
    coerce_cols = [t] if spec.coerce == "target" else [t, *spec.features]
    # parsed once: the steps below read these columns in six passes, and a filter on one would parse it again
    out = cut_lineage(out.withColumns({c: to_number(_c(c)) for c in coerce_cols}))
    out = require(out, [t])
    if spec.dedupe:
        out = dedupe_first(out.where(_c(spec.ts).isNotNull()), [spec.ts], [spec.tiebreak] if spec.tiebreak else [t, *spec.features])
    num_cols = [c for c in [t, *spec.features] if c in coerce_cols]
    # one metadata pass: B12's NULL rates
    rates = null_rates(out)
    if out.columns and rates[spec.ts] == 100.0:
        raise ValueError(f"no value of {spec.raw_ts!r} is a time")
    subset = [c for c, r in rates.items() if r < spec.sparse_pct]
    out = out.dropna(subset=subset) if subset else out
    if spec.fit_on == "all":
        out, _ = replace_upper_outliers(out, num_cols, spec.outlier_k, spec.quantile_method)
    out = out.withColumns(calendar_parts(_c(spec.ts)))
    order = [spec.ts, spec.tiebreak] if spec.tiebreak else [spec.ts, t, *spec.features]
    lags = lag_exprs(t, list(spec.lags))
    out = windowed(out, lags, order, before=max(spec.lags), block_rows=spec.block_rows, partitions=parts, keep_ordinal="_at", keep_block="_in")
    out = drop_any_null(out)
    # X must be finite: every floating feature (the target stays as it is)
    float_feats = [f.name for f in out.schema.fields
                   if f.dataType.typeName() in ("double", "float") and f.name != t and f.name not in spec.ids]
    out = drop_nonfinite(out, float_feats)
    out = split_by_position(renumbered(out, "_at", "_in", total="_n").drop("_at", "_in"), spec.test_size)
    if spec.fit_on == "train":
        out, _ = replace_upper_outliers(out, num_cols, spec.outlier_k, spec.quantile_method, fit=out.where(F.col("split") == "train"),
                                        like=dict.fromkeys(lags, t) if t in num_cols else {})
    return out.drop(spec.ts)


def quantile_trim(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Keep rows with ``q(lo) <= x <= q(hi)`` (inclusive); the two
    exact quantiles are applied as literals."""
    got = quantile_values(df, [col], (lo, hi))
    if got[col, float(lo)] is None:
        return df.where(F.lit(False))
    return df.where(_c(col).between(F.lit(got[col, float(lo)]), F.lit(got[col, float(hi)])))


def threshold_filter(df: DataFrame, col: str, below: float) -> DataFrame:
    """``x < below`` (pushed down to the scan when ``col`` is stored)."""
    return df.where(_c(col) < F.lit(below))
