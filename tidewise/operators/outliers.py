"""Outlier statistics and handlers.

Statistics are a few numbers per column; they are applied as literals in a
single projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage
from .quantiles import quantile_values
from .stats import mode_table, nan_safe, value_frequencies


def _q(c: str) -> Column:
    return F.col(qident(c))


def quartiles(df: DataFrame, cols: Sequence[str], with_median: bool = False, quantile_method: str = "exact") -> dict[str, list]:
    """``{column: [q1, q3]}`` (and the median), a few numbers per column; NULLs for a column without values."""
    probs = (0.25, 0.75, 0.5) if with_median else (0.25, 0.75)
    got = quantile_values(df, cols, probs, quantile_method)
    return {c: [got[c, p] for p in probs] for c in cols}


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 3.0, floor: float | None = 0.0, digits: int | None = None,
               quantile_method: str = "exact") -> DataFrame:
    """``(col_name, q1, q3, iqr, lo, hi)``; ``lo`` floored at ``floor``."""
    rows = [(c, *map(lambda v: None if v is None else float(v), q)) for c, q in quartiles(df, cols, quantile_method=quantile_method).items()]
    long = df.sparkSession.createDataFrame(rows, "col_name string, q1 double, q3 double").withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - k * F.col("iqr")
    if floor is not None:
        lo = F.when(lo < floor, F.lit(float(floor))).otherwise(lo)
    out = long.select("col_name", "q1", "q3", "iqr", lo.alias("lo"), (F.col("q3") + k * F.col("iqr")).alias("hi"))
    if digits is not None:
        out = out.select("col_name", *[F.round(x, digits).alias(x) for x in ("q1", "q3", "iqr", "lo", "hi")])
    return out


def outside(c: Column, lo: Column, hi: Column) -> Column:
    """Strict outside-range test, FALSE for NULL."""
    return c.isNotNull() & ((c < lo) | (c > hi))


def _fence_values(fences: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """Fences are one row per column: collected once (metadata) and applied
    as literals, so later jobs over the result never recompute them."""
    got = {r["col_name"]: (r["lo"], r["hi"]) for r in fences.select("col_name", "lo", "hi").collect()}
    return {c: got.get(c, (None, None)) for c in cols}


def _lit(v) -> Column:
    return F.lit(v).cast("double")


def apply_fences(df: DataFrame, fences: DataFrame, cols: Sequence[str], action: str = "flag") -> DataFrame:
    """Fences (from this or a reference table) applied per row.

    ``flag`` adds ``{c}_outside``; ``null`` sets outside values to NULL.
    """
    fv = _fence_values(fences, cols)
    df = nan_safe(df, cols)
    outs = {}
    for c in cols:
        lo, hi = fv[c]
        m = F.coalesce(outside(_q(c), _lit(lo), _lit(hi)), F.lit(False))
        if action == "flag":
            outs[f"{c}_outside"] = m
        else:
            outs[c] = F.when(~m, _q(c))
    return df.withColumns(outs)


def outlier_report(df: DataFrame, cols: Sequence[str], order: str, fences: DataFrame | None = None, k: float = 3.0,
                   examples: int = 3) -> DataFrame:
    """Per column the outlier count and the first ``examples`` outliers
    by row order: ``(column, n_outliers, total_outliers, rank, <order>, value)``."""
    if fences is None:
        fences = iqr_fences(df, cols, k=k)
    flagged = apply_fences(df.select(order, *cols), fences, cols)
    long = flagged.select(
        order,
        F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), _q(c).cast("double").alias("value"), F.col(f"{c}_outside").alias("o")) for c in cols])).alias("kv"),
    ).select(order, "kv.*").where("o")
    counts = long.groupBy("col_name").agg(F.count(F.lit(1)).alias("n_outliers"))
    w = Window.partitionBy("col_name").orderBy(order)
    ex = long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= examples)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "col_name string")  # the column list itself
    allc = names.join(counts, "col_name", "left").fillna(0, ["n_outliers"])
    total = counts.agg(F.coalesce(F.sum("n_outliers"), F.lit(0)).alias("total_outliers"))
    allc = allc.crossJoin(F.broadcast(total))  # one-row total
    return allc.join(ex.select("col_name", "rank", order, "value"), "col_name", "left").select(
        "col_name", F.col("n_outliers").cast("bigint").alias("n_outliers"), F.col("total_outliers").cast("bigint").alias("total_outliers"),
        F.col("rank").cast("bigint").alias("rank"), order, "value",
    )


def replace_upper_outliers(df: DataFrame, cols: Sequence[str], k: float = 2.0, quantile_method: str = "exact",
                           fit: DataFrame | None = None, like: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """I1 (+ D29): per column, values above ``q3 + k*iqr`` -> the column's
    median; an all-NULL column or IQR of 0/NULL is left alone.  The
    statistics are those of ``fit`` (default: ``df``); ``like`` names further
    columns that are replaced by the statistics of another one (its lags).

    Returns the frame and ``(column, n_replaced)``; both come from the same
    statistics row (broadcast) and the counts from one aggregate.
    """
    df = nan_safe(df, cols)
    got = quartiles(df if fit is None else nan_safe(fit, cols), cols, with_median=True, quantile_method=quantile_method)
    like = {**{c: c for c in cols}, **(like or {})}
    masks, outs = {}, {}
    for c, known in like.items():
        q1, q3, med = got[known]
        if q1 is None or q3 is None or q3 - q1 == 0:
            m = F.lit(False)
        else:
            m = _q(c).isNotNull() & (_q(c).cast("double") > _lit(q3 + k * (q3 - q1)))
        masks[c] = m
        outs[c] = F.when(m, _lit(med)).otherwise(_q(c).cast("double"))
    counts_wide = df.agg(*[F.count_if(masks[c]).alias(c) for c in like])
    counts = counts_wide.unpivot([], list(like), "col_name", "n_replaced")
    return df.withColumns(outs), counts


def zscore(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``(x - mean) / std_pop`` with NULLs ignored; constant -> NULL."""
    df = nan_safe(df, [col])
    st = df.agg(F.avg(_q(col)).alias("_m"), F.stddev_pop(_q(col)).alias("_s")).first()  # two numbers
    if st["_m"] is None or not st["_s"]:
        return df.withColumn(name or f"{col}_z", F.lit(None).cast("double"))
    return df.withColumn(name or f"{col}_z", (_q(col) - _lit(st["_m"])) / _lit(st["_s"]))


def _mask_stats(df: DataFrame, cols: Sequence[str], method: str, metric: str | None, quantile_method: str = "exact") -> dict:
    """The few numbers per column that a handler needs: ``{c}__q`` (quartiles) or ``{c}__m``, ``{c}__s``; ``{c}__r`` to replace with."""
    if method not in ("IQR", "zscore"):
        raise ValueError(f"unknown method {method!r}")
    out, aggs = {}, []
    if method == "IQR" or metric == "median":
        for c, q in quartiles(df, cols, metric == "median", quantile_method).items():
            out[f"{c}__q"] = q[:2]
            if metric == "median":
                out[f"{c}__r"] = q[2]
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        if method == "zscore":
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        if metric == "mean":
            aggs.append(F.avg(x).alias(f"r{i}"))
    if aggs:
        row = df.agg(*aggs).first().asDict()
        out |= {f"{cols[int(name[1:])]}__{name[0]}": v for name, v in row.items()}
    return out


def _mask(c: str, method: str, st: dict, iqr_k: float = 1.5, z: float = 3.0) -> Column:
    """Outlier test with the statistics as literals (FALSE for NULL)."""
    x = _q(c).cast("double")
    if method == "IQR":
        q1, q3 = (st.get(f"{c}__q") or [None, None])[:2]
        if q1 is None or q3 is None:
            return F.lit(False)
        iqr = q3 - q1
        return F.coalesce((x < _lit(q1 - iqr_k * iqr)) | (x > _lit(q3 + iqr_k * iqr)), F.lit(False))
    m, sd = st.get(f"{c}__m"), st.get(f"{c}__s")
    if m is None or not sd:
        return F.lit(False)
    return F.coalesce(F.abs((x - _lit(m)) / _lit(sd)) > z, F.lit(False))


def handle_outliers(df: DataFrame, cols: Sequence[str], method: str = "IQR", action: str = "drop",
                    metric: str | None = None, sequential: bool = False, quantile_method: str = "exact") -> DataFrame:
    """I4: IQR (1.5) or |z| > 3 outliers, dropped or replaced by the
    column's mean / median / mode (taken before replacement).

    ``sequential=True`` reproduces the reference loop: each column's
    statistics see the rows left by the previous column's filter.  Lineage
    is cut with a reliable checkpoint between the steps.
    """
    cols = list(cols)
    df = nan_safe(df, cols)
    if action == "replace" and metric not in ("mean", "median", "mode"):
        raise ValueError("replace needs metric mean, median or mode")
    if sequential:
        cur = df
        for i, c in enumerate(cols):
            cur = handle_outliers(cur, [c], method, action, metric, sequential=False, quantile_method=quantile_method)
            if i < len(cols) - 1:
                cur = cut_lineage(cur)
        return cur
    row = _mask_stats(df, cols, method, metric if action == "replace" else None, quantile_method)
    if action == "replace" and metric == "mode":
        freq = value_frequencies(df.select(*[_q(c).cast("double").alias(c) for c in cols]), cols)
        modes = mode_table(freq.withColumn("value", F.col("value").cast("double")))
        row |= {f"{r['col_name']}__r": r["top"] for r in modes.collect()}  # one row per column
    if action == "drop":
        keep = F.lit(True)
        for c in cols:
            keep = keep & ~_mask(c, method, row)
        return df.where(keep)
    if action == "replace":
        return df.withColumns({c: F.when(_mask(c, method, row), _lit(row.get(f"{c}__r"))).otherwise(_q(c).cast("double"))
                               for c in cols})
    raise ValueError(f"unknown action {action!r}")


def outlier_counts(df: DataFrame, cols: Sequence[str], method: str = "IQR", quantile_method: str = "exact") -> DataFrame:
    """I4's report: ``(col_name, total, outliers, percent)``; total counts the non-null values."""
    cols = list(cols)
    df = nan_safe(df, cols)
    row = _mask_stats(df, cols, method, None, quantile_method)
    counts = df.agg(*[x for i, c in enumerate(cols) for x in (F.count(_q(c)).alias(f"t{i}"), F.count_if(_mask(c, method, row)).alias(f"o{i}"))]).first()
    rows = [(c, counts[f"t{i}"], counts[f"o{i}"]) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "col_name string, total long, outliers long")
    return out.withColumn("percent", F.when(F.col("total") > 0, F.round(F.col("outliers") * 100 / F.col("total"), 6)))
