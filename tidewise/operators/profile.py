"""Profiling reports (2.D): each is a DataFrame, computed in few fused scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident, qtext
from .duplicates import duplicate_rows, duplicates  # noqa: F401 - D4 and D6, reports like the others
from .stats import (
    fused_long,
    nan_safe,
    mode_table,
    safe_corr,
    sample_kurtosis,
    sample_skewness,
    value_frequencies,
)


def shape(df: DataFrame) -> DataFrame:
    """Rows x columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_count)``, largest first."""
    cols = list(cols or df.columns)
    out = fused_long(df, cols, {"null_count": lambda c: F.count_if(c.isNull())})
    return out.orderBy(F.desc("null_count"), "col_name")


def missing_table(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """D3: columns with missing cells: count and percent of rows."""
    cols = list(cols or df.columns)
    out = fused_long(
        df,
        cols,
        {"missing_count": lambda c: F.count_if(c.isNull()), "_rows": lambda c: F.count(F.lit(1))},
    )
    return (
        out.where(F.col("missing_count") > 0)
        .select(
            "col_name",
            "missing_count",
            F.round(F.col("missing_count") / F.col("_rows") * 100, digits).alias("missing_percent"),
        )
        .orderBy(F.desc("missing_count"), "col_name")
    )


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per key column, rows after the first of their value (NULL is a
    value).  One scan: every row yields ``(column, value)`` pairs, counted
    by a map-side-combined group-by."""
    cols = list(cols)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(qident(c)).cast("string").alias("v"), F.col(qident(c)).isNull().alias("isnull"))
        for c in cols])).alias("kv")).select("kv.*")
    g = pairs.groupBy("col_name", "v", "isnull").agg(F.count(F.lit(1)).alias("_n"))
    per = g.groupBy("col_name").agg(F.sum(F.col("_n") - 1).cast("bigint").alias("n_duplicates"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "col_name string")
    return names.join(per, "col_name", "left").select("col_name", F.coalesce("n_duplicates", F.lit(0)).cast("bigint").alias("n_duplicates"))


def n_unique(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (optionally HyperLogLog++)."""
    cols = list(cols or df.columns)
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return fused_long(df, cols, {"n_unique": fn})


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """``value_counts().head(k)``: NULL excluded, count desc, value asc."""
    return (
        df.where(F.col(qident(col)).isNotNull())
        .groupBy(F.col(qident(col)).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
    )


DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6, quantile_method: str = "exact") -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 % (interpolated), max."""
    from .quantiles import quantile_values

    stats = {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    got = quantile_values(df, cols, DESCRIBE_PROBS, quantile_method)
    quartiles = df.sparkSession.createDataFrame([(c, [got[c, p] for p in DESCRIBE_PROBS]) for c in cols], "col_name string, q array<double>")
    long = fused_long(df, cols, stats).join(F.broadcast(quartiles), "col_name")  # one row per column
    r = lambda c: F.round(c, digits)
    return long.select(
        "col_name",
        F.col("count").cast("bigint").alias("count"),
        r(F.col("mean")).alias("mean"),
        r(F.col("std")).alias("std"),
        r(F.col("min")).alias("min"),
        r(F.col("q")[0]).alias("p25"),
        r(F.col("q")[1]).alias("p50"),
        r(F.col("q")[2]).alias("p75"),
        r(F.col("max")).alias("max"),
    )


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, top (smallest of the most frequent), freq.

    Everything comes from one frequency table (one shuffle of map-side
    reduced ``(column, value)`` counts): count = sum of counts, unique =
    number of values."""
    cols = list(cols)
    freq = value_frequencies(df, cols)
    base = freq.groupBy("col_name").agg(F.sum("n").cast("bigint").alias("count"), F.count(F.lit(1)).alias("unique"))
    modes = mode_table(freq)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "col_name string")  # all-NULL columns too
    return names.join(base, "col_name", "left").join(modes, "col_name", "left").select(
        "col_name", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.coalesce("unique", F.lit(0)).cast("bigint").alias("unique"), "top", F.col("freq").cast("bigint").alias("freq"))


def _type_family(t: str) -> str:
    return {"timestamp_ntz": "timestamp", "int": "integer", "varchar": "string"}.get(t, t)


def info(df: DataFrame) -> DataFrame:
    """Position, name, non-null count and dtype of every column."""
    counts = fused_long(df, df.columns, {"non_null": lambda c: F.count(c)})
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(i, f.name, _type_family(f.dataType.simpleString())) for i, f in enumerate(df.schema.fields)],
        "position long, col_name string, dtype string",
    )
    return meta.join(F.broadcast(counts), "col_name").select("position", "col_name", "non_null", "dtype")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], digits: int = 6) -> DataFrame:
    """Exact interpolated quantiles, ``(column, p, q)``."""
    from .quantiles import quantiles as any_quantiles

    return any_quantiles(df, cols, probs, digits=digits)


def moments(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """D17 + D18: sample skewness and excess kurtosis."""
    long = fused_long(df, cols, {"skewness": sample_skewness, "kurtosis": sample_kurtosis})
    return long.select("col_name", F.round("skewness", digits).alias("skewness"), F.round("kurtosis", digits).alias("kurtosis"))


def central_stats(df: DataFrame, cols: Sequence[str], digits: int = 6, quantile_method: str = "exact") -> DataFrame:
    """Mean, median (exact) and mode (smallest of the
    most frequent)."""
    from .quantiles import quantile_values

    cols = list(cols)
    med = quantile_values(nan_safe(df, cols), cols, (0.5,), quantile_method)
    long = fused_long(df, cols, {"mean": lambda c: F.avg(c)})
    meds = df.sparkSession.createDataFrame([(c, med.get((c, 0.5))) for c in cols], "col_name string, median double")
    long = long.join(F.broadcast(meds), "col_name")  # one row per column
    freq = value_frequencies(df.select(*[F.col(qident(c)).cast("double").alias(c) for c in cols]), cols)
    freq = freq.withColumn("value", F.col("value").cast("double"))
    modes = mode_table(freq).select("col_name", F.col("top").alias("mode"))
    return long.join(modes, "col_name", "left").select(
        "col_name", F.round("mean", digits).alias("mean"), F.round("median", digits).alias("median"), "mode"
    )


WIDE = 32  # columns: about 500 pairs, each some expressions of one aggregate


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson for every ordered pair, ``(col_a, col_b, corr)``.

    One aggregate over the upper triangle (pair-complete rows per pair); the
    lower triangle mirrors it and the diagonal is 1 (NULL for a constant or
    empty column).  More than ``WIDE`` columns go by block products."""
    cols = list(cols)
    if len(cols) > WIDE:
        from .widecorr import corr_wide

        return corr_wide(df, cols, digits)
    df = nan_safe(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [safe_corr(F.col(qident(a)), F.col(qident(b))).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)]
    aggs += [F.stddev_pop(F.col(qident(c))).alias(f"_s{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    parts = []
    for i, (a, b) in enumerate(pairs):
        parts += [qtext(a), qtext(b), f"_c{i}", qtext(b), qtext(a), f"_c{i}"]
    for i, c in enumerate(cols):
        parts += [qtext(c), qtext(c), f"CASE WHEN _s{i} > 0 THEN 1.0D END"]
    n = 2 * len(pairs) + len(cols)
    long = wide.selectExpr(f"stack({n}, {', '.join(parts)}) AS (col_a, col_b, corr)")
    return long.select("col_a", "col_b", F.round("corr", digits).alias("corr"))


def box_stats(df: DataFrame, cols: Sequence[str], whis: float = 1.5, digits: int = 6, quantile_method: str = "exact") -> DataFrame:
    """Quartiles, mean, whisker ends (extreme points inside 1.5 IQR), flier count.

    Quartiles are exact and enter the second aggregate as
    literals; whiskers and fliers are one conditional aggregate."""
    from .quantiles import quantile_values

    cols = list(cols)
    df = nan_safe(df, cols)
    qv = quantile_values(df, cols, (0.25, 0.5, 0.75), quantile_method)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(qident(c)).cast("double")
        q1, q3 = qv.get((c, 0.25)), qv.get((c, 0.75))
        if q1 is None or q3 is None:
            inside = F.lit(False)
        else:
            inside = (x >= F.lit(q1 - whis * (q3 - q1))) & (x <= F.lit(q3 + whis * (q3 - q1)))
        aggs += [F.avg(x).alias(f"m{i}"), F.min(F.when(inside, x)).alias(f"lo{i}"), F.max(F.when(inside, x)).alias(f"hi{i}"),
                 F.count_if(x.isNotNull() & ~inside).alias(f"f{i}")]
    row = df.agg(*aggs)

    def lit(v):
        return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({float(v)!r} AS DOUBLE)"

    parts = []
    for i, c in enumerate(cols):
        parts += [qtext(c), lit(qv.get((c, 0.25))), lit(qv.get((c, 0.5))), lit(qv.get((c, 0.75))), f"m{i}", f"lo{i}", f"hi{i}", f"f{i}"]
    long = row.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) AS (col_name, q1, median, q3, mean, whisker_lo, whisker_hi, n_fliers)")
    return long.select("col_name", *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3", "mean", "whisker_lo", "whisker_hi")],
                       "n_fliers")


def row_null_histogram(df: DataFrame, cols: Sequence[str], cap: int = 4, digits: int = 6) -> DataFrame:
    """Rows by number of NULL cells (0, 1, ..., ``cap``+), with percent."""
    n_null = sum((F.col(qident(c)).isNull().cast("int") for c in cols), F.lit(0))
    b = df.select(F.least(n_null, F.lit(cap)).cast("bigint").alias("n_nulls"))
    g = b.groupBy("n_nulls").agg(F.count(F.lit(1)).alias("n_rows"))
    tot = Window.partitionBy()  # over the <= cap+1 bucket rows only
    return g.select("n_nulls", "n_rows", F.round(F.col("n_rows") / F.sum("n_rows").over(tot) * 100, digits).alias("pct"))


def remaining_nulls(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Per column with NULLs: count and % of rows; plus a ``__total__``
    row with all NULL cells as % of all cells."""
    cols = list(cols)
    long = fused_long(df, cols, {"n_null": lambda c: F.count_if(c.isNull()), "_rows": lambda c: F.count(F.lit(1))})
    per = long.where(F.col("n_null") > 0).select(
        "col_name", "n_null", F.round(F.col("n_null") / F.col("_rows") * 100, digits).alias("pct")
    )
    total = long.agg(
        F.lit("__total__").alias("col_name"),
        F.sum("n_null").cast("bigint").alias("n_null"),
        F.round(F.sum("n_null") / (F.max("_rows") * len(cols)) * 100, digits).alias("pct"),
    )
    return per.unionByName(total)


def null_pct(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """``round(mean(isnull) * 100, 2)`` per column."""
    cols = list(cols or df.columns)
    return fused_long(df, cols, {"null_pct": lambda c: F.round(F.avg(c.isNull().cast("double")) * 100, digits)})


def size_comparison(original: DataFrame, raw: DataFrame, clean: DataFrame, digits: int = 6) -> DataFrame:
    """Row counts of the three tables, dropped rows and recovery."""
    o = original.agg(F.count(F.lit(1)).alias("original_rows"))
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    c = clean.agg(F.count(F.lit(1)).alias("clean_rows"))
    j = o.crossJoin(r).crossJoin(c)  # three one-row aggregates
    return j.select(
        "original_rows", "raw_rows", "clean_rows",
        (F.col("raw_rows") - F.col("clean_rows")).alias("dropped"),
        F.round((F.col("raw_rows") - F.col("clean_rows")) / F.col("raw_rows") * 100, digits).alias("dropped_pct"),
        F.round(F.col("clean_rows") / F.col("original_rows") * 100, digits).alias("recovery_pct"),
    )


def mean_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str], warn: float = 5.0, digits: int = 6) -> DataFrame:
    """C4 + D27: per-column mean of both tables joined on the column name;
    ``abs((cur-ref)/ref)*100``; OK below ``warn``; the average decides the
    verdict (similar < 5, moderate < 10, else different)."""
    a = fused_long(reference, cols, {"ref_mean": lambda c: F.avg(c)})
    b = fused_long(current, cols, {"cur_mean": lambda c: F.avg(c)})
    j = a.join(b, "col_name")
    diff = F.abs(F.try_divide(F.col("cur_mean") - F.col("ref_mean"), F.col("ref_mean")) * 100)
    j = j.withColumn("diff_pct", diff)
    avg_diff = F.avg("diff_pct").over(Window.partitionBy())  # one row per column
    return j.select(
        "col_name",
        F.round("ref_mean", digits).alias("ref_mean"),
        F.round("cur_mean", digits).alias("cur_mean"),
        F.round("diff_pct", digits).alias("diff_pct"),
        F.when(F.col("diff_pct") < warn, "OK").otherwise("WARN").alias("status"),
        F.when(avg_diff < 5, "similar").when(avg_diff < 10, "moderate").otherwise("different").alias("verdict"),
    )


# ---------------------------------------------------------------- histograms

def _bin_index(x, mn, mx, nb):
    """Uniform-bin index with NumPy's edge corrections; the last bin is closed."""
    step = (mx - mn) / nb
    i0 = F.floor((x - mn) / (mx - mn) * nb).cast("bigint")
    i0 = F.when(i0 >= nb, nb - 1).otherwise(i0)
    lo_edge = i0 * step + mn
    i1 = F.when(x < lo_edge, i0 - 1).otherwise(i0)
    hi_edge = (i1 + 1) * step + mn
    i2 = F.when((x >= hi_edge) & (i1 != nb - 1), i1 + 1).otherwise(i1)
    return F.when(mx == mn, F.lit(0).cast("bigint")).otherwise(i2)


def histogram(df: DataFrame, col: str, bins: int | str = "fd", trim: tuple[float, float] | None = (0.01, 0.99), digits: int = 6,
              quantile_method: str = "exact") -> DataFrame:
    """``(bin, lo, hi, n)``.

    ``bins="fd"``: optional inclusive quantile trim, Freedman-Diaconis width
    ``2*IQR*n^(-1/3)`` on the trimmed values, and NumPy's ``auto`` rule when
    that yields a single bin.  An integer gives that many equal bins.  The
    few statistics (trim bounds, min, max, count, quartiles) are collected
    once; binning is a projection with literals and a group-by; the spine
    of ``nb`` bins comes from ``range``.
    """
    import math

    from .quantiles import quantile_values

    spark = df.sparkSession
    x = F.col(qident(col)).cast("double")
    # infinite values have no bin: they are left out, as NULL and NaN are
    data = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")))
    empty = spark.createDataFrame([], "bin long, lo double, hi double, n long")
    if trim is not None:
        qv = quantile_values(data, ["x"], trim, quantile_method)
        lo_t, hi_t = qv.get(("x", float(trim[0]))), qv.get(("x", float(trim[1])))
        if lo_t is None:
            return empty
        data = data.where((F.col("x") >= F.lit(lo_t)) & (F.col("x") <= F.lit(hi_t)))
    st = data.agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count("x").alias("n")).first()
    if not st["n"]:
        return empty
    mn, mx, n = st["mn"], st["mx"], float(st["n"])
    rng = mx - mn
    if isinstance(bins, int):
        nb = int(bins)
    else:
        qv = quantile_values(data, ["x"], (0.25, 0.75), quantile_method)
        fd = 2.0 * (qv[("x", 0.75)] - qv[("x", 0.25)]) * n ** (-1.0 / 3.0)
        nb = math.ceil(rng / fd) if fd > 0 else 1
        if nb < 2:  # NumPy's "auto": min(max(fd, sqrt / 2), sturges)
            auto_bw = min(max(fd, rng / math.sqrt(n) / 2), rng / (math.log2(n) + 1.0))
            nb = math.ceil(rng / auto_bw) if auto_bw > 0 else 1
    nb = max(int(nb), 1)
    idx = _bin_index(F.col("x"), F.lit(mn), F.lit(mx), F.lit(nb).cast("bigint"))
    counted = data.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    step = (F.lit(mx) - F.lit(mn)) / F.lit(nb)
    spine = spark.range(nb).withColumnRenamed("id", "bin")  # nb rows, bounded by range / bin width
    return spine.join(counted, "bin", "left").select(
        "bin",
        F.round(F.col("bin") * step + F.lit(mn), digits).alias("lo"),
        F.round(F.when(F.col("bin") == nb - 1, F.lit(mx)).otherwise((F.col("bin") + 1) * step + F.lit(mn)), digits).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
    )


def non_numeric(df: DataFrame, cols: Sequence[str], order: str, k: int = 15) -> DataFrame:
    """Cells that are non-null but fail H1, per column: the total and
    the first ``k`` distinct values by first appearance.

    ``(col_name, value, n, first_seen, total_bad, rank)``.  The per-value
    group-by combines map-side; the ``rank <= k`` filter is planned with a
    partial per-task group limit, so no column's values meet in one task.
    """
    from ..functions.numbers import to_number

    long = df.select(
        order,
        F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(qident(c)).cast("string").alias("value")) for c in cols])).alias("kv"),
    ).select(order, "kv.*")
    bad = long.where(F.col("value").isNotNull() & to_number(F.col("value")).isNull())
    per_value = bad.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    totals = per_value.groupBy("col_name").agg(F.sum("n").cast("bigint").alias("total_bad"))
    w = Window.partitionBy("col_name").orderBy("first_seen", "value")
    first = per_value.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
    return first.join(totals, "col_name")


def ts_quality(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows with missing time text, with unparseable text, and rows in a
    duplicate group of the raw text (the NULL group included); one row.
    One scan: a group-by on the raw text carries the unparseable count."""
    g = df.groupBy(F.col(qident(raw)).alias("_raw")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(qident(parsed)).isNull()).alias("_bad"))
    return g.agg(
        F.coalesce(F.sum(F.when(F.col("_raw").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_missing"),
        F.coalesce(F.sum(F.when(F.col("_raw").isNotNull(), F.col("_bad"))), F.lit(0)).cast("bigint").alias("n_unparseable"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_dup_rows"),
    )


def histogram_pair(a: DataFrame, b: DataFrame, col: str, bins: int = 50, labels: tuple[str, str] = ("original", "cleaned"),
                   digits: int = 6) -> DataFrame:
    """D22 ``pair=True``: the same column of two tables, each binned over its
    own range, with each table's mean: ``(source, bin, lo, hi, n, mean)``."""
    parts = []
    for lab, d in zip(labels, (a, b)):
        h = histogram(d, col, bins, None, digits)
        m = d.agg(F.round(F.avg(F.col(qident(col))), digits).alias("mean"))
        parts.append(h.crossJoin(m).select(F.lit(lab).alias("source"), "bin", "lo", "hi", "n", "mean"))
    return parts[0].unionByName(parts[1])


def describe_all(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """D10 ``include="all"``: one table over mixed columns.  Numeric columns
    get count / mean / std / min / quartiles / max, text columns count /
    unique / top / freq; inapplicable cells are NULL."""
    from pyspark.sql.types import NumericType

    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], NumericType)]
    txt = [c for c in cols if c not in num]
    parts = []
    if num:
        d = describe(df, num, digits)
        parts.append(d.select("col_name", "count", F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
                              F.lit(None).cast("bigint").alias("freq"), "mean", "std", "min", "p25", "p50", "p75", "max"))
    if txt:
        t = describe_text(df, txt)
        nulls = [F.lit(None).cast("double").alias(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        parts.append(t.select("col_name", "count", "unique", "top", F.col("freq").cast("bigint").alias("freq"), *nulls))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
