"""Profile queries (2.D) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from .common import LINEITEM_NUM, coerced, events, polluted_events, table
from .registry import query
from .sqlparts import num, with_coerced, with_polluted

LINEITEM_ALL = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
POLLUTED_COLS = ["event_id", "user_id", "event_type", "raw_ts", "raw_value", "raw_k", "mixed_type_col"]
COERCED_COLS = ["event_id", "user_id", "event_type", "raw_ts", "ts", "value", "k", "mixed_type_col"]
TEXT_COLS = ["event_type", "raw_ts", "raw_value", "raw_k", "mixed_type_col"]


def per_col(cols, template: str, src: str) -> str:
    """UNION ALL of one SELECT per column; ``{c}`` is the column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, " + template.format(c=c) + f" FROM {src}" for c in cols
    )


@query("shape", "SELECT count(*) AS n_rows, (SELECT count(*) FROM information_schema.columns "
                "WHERE table_name = 'lineitem') AS n_cols FROM lineitem")
def q_shape(spark, sf):
    """D1 on lineitem."""
    return P.shape(table(spark, sf, "lineitem"))


@query("null_counts", with_polluted(per_col(POLLUTED_COLS, "count(*) - count({c}) AS null_count", "p")))
def q_null_counts(spark, sf):
    """D2 on the polluted view."""
    return P.null_counts(polluted_events(spark, sf))


@query("missing_table", with_coerced(
    "SELECT col_name, missing_count, round(missing_count / n * 100, 6) AS missing_percent FROM ("
    + per_col(COERCED_COLS, "count(*) - count({c}) AS missing_count, count(*) AS n", "c") + ") WHERE missing_count > 0"))
def q_missing_table(spark, sf):
    """D3 on the coerced polluted view."""
    return P.missing_table(coerced(spark, sf))


@query("duplicate_row_count",
       "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY "
       + ", ".join(LINEITEM_ALL) + ")")
def q_duplicate_row_count(spark, sf):
    """D4 on lineitem (full-row duplicates)."""
    return P.duplicate_rows(table(spark, sf, "lineitem"))


REPEATING = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("duplicate_row_count_repeating",
       "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY "
       + ", ".join(REPEATING) + ")")
def q_duplicate_row_count_repeating(spark, sf):
    """D4 on columns of lineitem whose rows repeat."""
    return P.duplicate_rows(table(spark, sf, "lineitem").select(*REPEATING))


@query("duplicate_ts_count", with_coerced(
    " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM c GROUP BY {c})"
        for c in ("raw_ts", "ts"))))
def q_duplicate_ts_count(spark, sf):
    """Duplicate time keys, raw text and parsed (NULL counts as a value)."""
    return P.duplicate_keys(coerced(spark, sf), ["raw_ts", "ts"])


@query("duplicate_ts_rows", with_polluted(
    "SELECT event_id, raw_ts, raw_value FROM (SELECT *, count(*) OVER (PARTITION BY raw_ts) AS n FROM p) WHERE n > 1"))
def q_duplicate_ts_rows(spark, sf):
    """Every row of a duplicated raw time key (``keep=False``)."""
    p = polluted_events(spark, sf).select("event_id", "raw_ts", "raw_value")
    return P.duplicates(p, ["raw_ts"])


@query("n_unique", per_col(LINEITEM_ALL, "count(DISTINCT {c}) AS n_unique", "lineitem"))
def q_n_unique(spark, sf):
    """D7 on every lineitem column."""
    return P.n_unique(table(spark, sf, "lineitem"))


@query("top_values", with_polluted(
    "SELECT mixed_type_col AS value, count(*) AS n FROM p WHERE mixed_type_col IS NOT NULL "
    "GROUP BY 1 ORDER BY n DESC, value LIMIT 10"))
def q_top_values(spark, sf):
    """Ten most frequent values of the mixed column."""
    return P.top_values(polluted_events(spark, sf), "mixed_type_col", 10)


@query("describe_numeric", per_col(
    LINEITEM_NUM,
    "count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
    "round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    "round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max",
    "lineitem"))
def q_describe_numeric(spark, sf):
    """D9 on lineitem's numeric columns."""
    return P.describe(table(spark, sf, "lineitem"), LINEITEM_NUM)


@query("describe_all", with_polluted(per_col(
    TEXT_COLS,
    "count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
    "(SELECT {c} FROM p WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
    "(SELECT count(*) FROM p WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq",
    "p")))
def q_describe_all(spark, sf):
    """D10 on the polluted text columns."""
    return P.describe_text(polluted_events(spark, sf), TEXT_COLS)


@query("info",
       "SELECT CAST(ic.ordinal_position - 1 AS BIGINT) AS position, ic.column_name AS col_name, n.non_null, "
       "CASE lower(ic.data_type) WHEN 'varchar' THEN 'string' ELSE lower(ic.data_type) END AS dtype "
       "FROM information_schema.columns ic JOIN (" + per_col(LINEITEM_ALL, "count({c}) AS non_null", "lineitem")
       + ") n ON n.col_name = ic.column_name WHERE ic.table_name = 'lineitem'")
def q_info(spark, sf):
    """D11 on lineitem."""
    return P.info(table(spark, sf, "lineitem"))


QPROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS q FROM lineitem"
    for c in LINEITEM_NUM for p in QPROBS))
def q_quantiles(spark, sf):
    """Exact interpolated quantiles of lineitem's numeric columns."""
    return P.quantiles(table(spark, sf, "lineitem"), LINEITEM_NUM, QPROBS)


@query("skewness", per_col(LINEITEM_NUM, "round(skewness({c}), 6) AS skewness", "lineitem"))
def q_skewness(spark, sf):
    """Sample skewness."""
    return P.moments(table(spark, sf, "lineitem"), LINEITEM_NUM).select("col_name", "skewness")


@query("kurtosis", per_col(LINEITEM_NUM, "round(kurtosis({c}), 6) AS kurtosis", "lineitem"))
def q_kurtosis(spark, sf):
    """Sample excess kurtosis."""
    return P.moments(table(spark, sf, "lineitem"), LINEITEM_NUM).select("col_name", "kurtosis")


@query("central_stats", per_col(
    LINEITEM_NUM,
    "round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, "
    "(SELECT CAST({c} AS DOUBLE) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode",
    "lineitem"))
def q_central_stats(spark, sf):
    """Mean, median, mode."""
    return P.central_stats(table(spark, sf, "lineitem"), LINEITEM_NUM)


def _corr_sql(a, b):
    m = f"({a} IS NOT NULL AND {b} IS NOT NULL)"
    am, bm = f"CASE WHEN {m} THEN {a} END", f"CASE WHEN {m} THEN {b} END"
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({am}, {bm}) / "
            f"nullif(stddev_pop({am}) * stddev_pop({bm}), 0), 6) AS corr FROM lineitem")


@query("corr_matrix", " UNION ALL ".join(_corr_sql(a, b) for a in LINEITEM_NUM for b in LINEITEM_NUM))
def q_corr_matrix(spark, sf):
    """All-pairs Pearson in one aggregate."""
    return P.corr_matrix(table(spark, sf, "lineitem"), LINEITEM_NUM)


@query("corr_matrix_wide",
       "WITH dims AS (SELECT unnest(range(CAST((SELECT max(len(embedding)) FROM embeddings) AS BIGINT))) AS i), "
       "v AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, dims), "
       "f AS (SELECT vec_id, i, x FROM v WHERE x IS NOT NULL AND NOT isnan(x)), "
       "p AS (SELECT a.i AS ai, b.i AS bi, covar_pop(a.x, b.x) / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0) AS r "
       "FROM f a JOIN f b USING (vec_id) GROUP BY 1, 2) "
       "SELECT 'e' || a.i AS col_a, 'e' || b.i AS col_b, round(p.r, 6) AS corr "
       "FROM dims a CROSS JOIN dims b LEFT JOIN p ON p.ai = a.i AND p.bi = b.i")
def q_corr_matrix_wide(spark, sf):
    """D20 on many columns: every dimension of the embeddings, by block products."""
    e = table(spark, sf, "embeddings")
    width = e.agg(F.max(F.size("embedding"))).first()[0]  # one number
    names = [f"e{i}" for i in range(width)]
    return P.corr_matrix(e.select(*[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]), names)


def _hist_sql(src: str, x: str, bins, trim, prefix: str = "", body_only: bool = False) -> str:
    """Oracle for D21/D22: NumPy's uniform binning with edge corrections."""
    if trim:
        data = (f"d AS (SELECT {x} AS x FROM {src}, (SELECT quantile_cont({x}, {trim[0]}) AS t0, quantile_cont({x}, {trim[1]}) AS t1 FROM {src}) "
                f"WHERE {x} IS NOT NULL AND {x} >= t0 AND {x} <= t1)")
    else:
        data = f"d AS (SELECT {x} AS x FROM {src} WHERE {x} IS NOT NULL)"
    if isinstance(bins, int):
        nb = f"CAST({bins} AS BIGINT)"
    else:
        fd = "(2.0 * (q3 - q1) * pow(n, -1.0 / 3.0))"
        rng = "(mx - mn)"
        nb_fd = f"(CASE WHEN {fd} > 0 THEN ceil({rng} / {fd}) ELSE 1 END)"
        auto = f"least(greatest({fd}, {rng} / sqrt(n) / 2), {rng} / (log2(n) + 1.0))"
        nb_auto = f"(CASE WHEN {auto} > 0 THEN ceil({rng} / {auto}) ELSE 1 END)"
        nb = f"CAST(CASE WHEN {nb_fd} < 2 THEN {nb_auto} ELSE {nb_fd} END AS BIGINT)"
    st = (f"s0 AS (SELECT min(x) AS mn, max(x) AS mx, CAST(count(x) AS DOUBLE) AS n, quantile_cont(x, 0.25) AS q1, "
          f"quantile_cont(x, 0.75) AS q3 FROM d), s AS (SELECT mn, mx, greatest({nb}, 1) AS nb FROM s0)")
    i0 = "least(CAST(floor((x - mn) / (mx - mn) * nb) AS BIGINT), nb - 1)"
    idx = (f"b0 AS (SELECT x, mn, mx, nb, (mx - mn) / nb AS step, {i0} AS i0 FROM d, s), "
           "b1 AS (SELECT *, CASE WHEN x < i0 * step + mn THEN i0 - 1 ELSE i0 END AS i1 FROM b0), "
           "b2 AS (SELECT CASE WHEN mx = mn THEN 0 WHEN x >= (i1 + 1) * step + mn AND i1 <> nb - 1 THEN i1 + 1 ELSE i1 END AS bin FROM b1), "
           "cnt AS (SELECT bin, count(*) AS n FROM b2 GROUP BY bin)")
    head = f"WITH {prefix + ', ' if prefix else ''}{data}, {st}, {idx} "
    return (f"{head}SELECT g.bin, round(g.bin * ((mx - mn) / nb) + mn, 6) AS lo, "
            "round(CASE WHEN g.bin = nb - 1 THEN mx ELSE (g.bin + 1) * ((mx - mn) / nb) + mn END, 6) AS hi, "
            "CAST(coalesce(cnt.n, 0) AS BIGINT) AS n FROM s, (SELECT unnest(range(0, (SELECT nb FROM s))) AS bin) g "
            "LEFT JOIN cnt ON cnt.bin = g.bin")


@query("histogram_fd", _hist_sql("events", "value", "fd", (0.01, 0.99)))
def q_histogram_fd(spark, sf):
    """1-99 % trim + Freedman-Diaconis bins on ``events.value``."""
    return P.histogram(events(spark, sf), "value", "fd", (0.01, 0.99))


@query("histogram_fixed", _hist_sql("lineitem", "l_extendedprice", 50, None))
def q_histogram_fixed(spark, sf):
    """50 equal bins over the full range of ``l_extendedprice``."""
    return P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50, None)


def _box_sql(c):
    return (
        f"SELECT '{c}' AS col_name, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(mean, 6) AS mean, "
        f"round(min(CASE WHEN {c} >= lo AND {c} <= hi THEN {c} END), 6) AS whisker_lo, "
        f"round(max(CASE WHEN {c} >= lo AND {c} <= hi THEN {c} END), 6) AS whisker_hi, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} >= lo AND {c} <= hi)) AS n_fliers "
        f"FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3, "
        f"avg({c}) AS mean, quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM lineitem) "
        f"GROUP BY q1, med, q3, mean"
    )


@query("box_stats", " UNION ALL ".join(_box_sql(c) for c in LINEITEM_NUM))
def q_box_stats(spark, sf):
    """Boxplot statistics of lineitem's numeric columns."""
    return P.box_stats(table(spark, sf, "lineitem"), LINEITEM_NUM)


_RNH_COLS = ["ts", "value", "k", "mixed_type_col"]


@query("row_null_histogram", with_coerced(
    "SELECT n_nulls, n_rows, round(n_rows / sum(n_rows) OVER () * 100, 6) AS pct FROM (SELECT n_nulls, count(*) AS n_rows FROM "
    "(SELECT CAST(least(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _RNH_COLS) + ", 4) AS BIGINT) AS n_nulls FROM c) GROUP BY n_nulls)"))
def q_row_null_histogram(spark, sf):
    """Rows by number of NULL cells (0..4+)."""
    return P.row_null_histogram(coerced(spark, sf), _RNH_COLS)


@query("null_pct", with_coerced(per_col(COERCED_COLS, "round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 2) AS null_pct", "c")))
def q_null_pct(spark, sf):
    """Rounded NULL percentage per column."""
    return P.null_pct(coerced(spark, sf))


@query("non_numeric_census", with_polluted(
    "SELECT col_name, value, n, first_seen, total_bad, rank FROM ("
    "SELECT *, CAST(row_number() OVER (PARTITION BY col_name ORDER BY first_seen, value) AS BIGINT) AS rank, "
    "CAST(sum(n) OVER (PARTITION BY col_name) AS BIGINT) AS total_bad FROM ("
    "SELECT col_name, value, count(*) AS n, min(event_id) AS first_seen FROM ("
    f"SELECT event_id, 'raw_value' AS col_name, raw_value AS value FROM p WHERE raw_value IS NOT NULL AND {num('raw_value')} IS NULL "
    f"UNION ALL SELECT event_id, 'raw_k', raw_k FROM p WHERE raw_k IS NOT NULL AND {num('raw_k')} IS NULL) GROUP BY col_name, value)) "
    "WHERE rank <= 15"))
def q_non_numeric(spark, sf):
    """Non-numeric cells of the numeric text columns."""
    return P.non_numeric(polluted_events(spark, sf), ["raw_value", "raw_k"], "event_id", 15).select(
        "col_name", "value", "n", "first_seen", "total_bad", "rank")


@query("ts_quality", with_coerced(
    "SELECT count(*) FILTER (WHERE raw_ts IS NULL) AS n_missing, "
    "count(*) FILTER (WHERE raw_ts IS NOT NULL AND ts IS NULL) AS n_unparseable, "
    "(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM c GROUP BY raw_ts) WHERE n > 1) AS n_dup_rows FROM c"))
def q_ts_quality(spark, sf):
    """Missing / unparseable / duplicated time keys."""
    return P.ts_quality(coerced(spark, sf), "raw_ts", "ts")


_QSQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS q FROM lineitem"
    for c in LINEITEM_NUM for p in QPROBS)


@query("quantiles_two_pass", _QSQL)
def q_quantiles_two_pass(spark, sf):
    """D12 through the operator's own module (the same exact method as ``quantiles``)."""
    from ..operators.quantiles import quantiles as qq
    return qq(table(spark, sf, "lineitem"), LINEITEM_NUM, QPROBS)


@query("quantiles_approx")
def q_quantiles_approx(spark, sf):
    """D12, approximate mode (``percentile_approx``: observed values)."""
    from ..operators.quantiles import quantiles as qq
    return qq(table(spark, sf, "lineitem"), LINEITEM_NUM, QPROBS, method="approx")


def _pair_sql_simple():
    from .fixtures import DUCK_POLLUTED_CTE
    from .q_clean import CLEAN_CTES
    from .sqlparts import COERCED_CTE
    pre = DUCK_POLLUTED_CTE + ", " + COERCED_CTE + ", " + CLEAN_CTES
    a = _hist_sql("events", "value", 50, None)
    b = _hist_sql("cl", "value", 50, None, prefix=pre)
    mean_b = f"WITH {pre} SELECT round(avg(value), 6) FROM cl"
    return (f"SELECT 'original' AS source, h.*, (SELECT round(avg(value), 6) FROM events) AS mean FROM ({a}) h UNION ALL "
            f"SELECT 'cleaned', h.*, ({mean_b}) FROM ({b}) h")


@query("histogram_pair", _pair_sql_simple())
def q_histogram_pair(spark, sf):
    """D22 paired: 50 bins of ``value`` in the original table and in the
    cleaned table (I5), each over its own range, with both means."""
    from .common import original_events
    from .q_clean import clean_flow_df
    return P.histogram_pair(original_events(spark, sf), clean_flow_df(spark, sf), "value", 50)


@query("duplicate_ts_examples", with_polluted(
    "SELECT event_id, raw_ts, raw_value FROM (SELECT *, count(*) OVER (PARTITION BY raw_ts) AS n FROM p) WHERE n > 1 "
    "ORDER BY raw_ts NULLS LAST, event_id LIMIT 6"))
def q_duplicate_ts_examples(spark, sf):
    """The first six duplicated-time rows by key (report view)."""
    from ..operators.ordered import head_n
    p = polluted_events(spark, sf).select("event_id", "raw_ts", "raw_value")
    return head_n(P.duplicates(p, ["raw_ts"]), 6, ["raw_ts", "event_id"])


_MIX_NUM = ["event_id", "value", "k"]
_MIX_TXT = ["event_type", "raw_ts", "mixed_type_col"]


@query("describe_mixed", with_coerced(
    per_col(_MIX_NUM,
            "count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
            "round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            "round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            "round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max", "c")
    + " UNION ALL " +
    per_col(_MIX_TXT,
            "count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
            "(SELECT {c} FROM c WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
            "(SELECT count(*) FROM c WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq, "
            "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, "
            "CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max", "c")))
def q_describe_mixed(spark, sf):
    """D10 ``include="all"`` on the coerced view: numeric and text columns
    in one table."""
    return P.describe_all(coerced(spark, sf).select(*_MIX_NUM, *_MIX_TXT))
