"""File sources and sinks.

CSV is read with every column as text (no schema inference pass); the
reference reader's missing-value spellings become NULL by expression, and
date / number typing is decided from ONE aggregate that counts cells that
would fail the conversion, per column.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from .._col import qident
from ..functions.numbers import csv_nulls, decimal_comma, to_number
from ..functions.text import clean_names, date_like_columns, value_columns
from ..functions.times import RAW_TS_FORMAT, time_column, to_ts

DEFAULT_DATE_COLS = ("DateTime", "datetime")


def read_csv(spark: SparkSession, path: str, date_cols: Sequence[str] = DEFAULT_DATE_COLS, date_format: str = RAW_TS_FORMAT,
             infer_numbers: bool = True) -> DataFrame:
    """A1: header row, all text, reference null tokens -> NULL.

    Date parsing is tried only for listed names present in the header
    (case-sensitive); one unparseable cell leaves the whole column text.
    With ``infer_numbers`` a column whose non-null cells all parse (H1)
    becomes DOUBLE.  The decisions come from one aggregate.
    """
    header = spark.read.option("header", True).csv(path).columns  # header only, no data pass
    schema = StructType([StructField(c, StringType(), True) for c in header])
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)
    df = df.select(*[csv_nulls(F.col(qident(c))).alias(c) for c in header])
    dates = [c for c in date_cols if c in header]
    others = [c for c in header if c not in dates]
    checks = [F.count_if(F.col(qident(c)).isNotNull() & to_ts(F.col(qident(c)), date_format).isNull()).alias(f"d{i}")
              for i, c in enumerate(dates)]
    if infer_numbers:
        checks += [F.count_if(F.col(qident(c)).isNotNull() & to_number(F.col(qident(c))).isNull()).alias(f"n{i}")
                   for i, c in enumerate(others)]
    if not checks:
        return df
    bad = df.agg(*checks).first()
    out = []
    for c in header:
        if c in dates and bad[f"d{dates.index(c)}"] == 0:
            out.append(to_ts(F.col(qident(c)), date_format).alias(c))
        elif infer_numbers and c in others and bad[f"n{others.index(c)}"] == 0:
            out.append(to_number(F.col(qident(c))).alias(c))
        else:
            out.append(F.col(qident(c)))
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A2: schema from the file."""
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's own file system for this path or address has it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


#: Reader by file ending (A3).
READERS = {".csv": read_csv, ".parquet": read_parquet, ".pq": read_parquet}


def load_file(spark: SparkSession, path: str | None, **csv_opts) -> DataFrame:
    """A3: the reader that the lower-cased ending names, on any file system that Spark knows."""
    ending = os.path.splitext((path or "").rstrip("/"))[1].lower()
    if ending not in READERS:
        raise ValueError(f"a path ending in one of {sorted(READERS)} is needed, not {path!r}")
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return READERS[ending](spark, path, **(csv_opts if ending == ".csv" else {}))


def load(spark: SparkSession, source: str = "file", path: str | None = None, jdbc: dict | None = None,
         rename: bool = True, page: int | None = None, size: int | None = None, **opts) -> DataFrame:
    """A4 (+ B1): ``file`` or ``db``, case-insensitive; names cleaned.

    ``db`` without options takes the connection from the environment and one
    page (the first 1,000 rows if not told otherwise), in the database.
    """
    kind = (source or "file").lower()
    if kind == "file":
        df = load_file(spark, path, **opts)
    elif kind == "db":
        from .jdbc import options_from_env, page_options, read_jdbc
        df = read_jdbc(spark, jdbc or page_options(options_from_env(), page or 1, size or 1000))
    else:
        raise ValueError(f"unknown source {source!r}; use 'file' or 'db'")
    return clean_names(df) if rename else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite; parents are created by the writer."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metrics(metrics_row: DataFrame, path: str) -> None:
    """A10: ``{run_id, metrics{mae, mse, rmse, r2, n_test}}`` as JSON."""
    metrics_row.coalesce(1).write.mode("overwrite").json(path)


def coerced_values(df: DataFrame, exclude: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The text columns outside ``exclude`` as numbers (decimal comma allowed) where any value is one.

    Returns the frame and its numeric value columns.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = value_columns(df, exclude)
    text = [c for c in names if isinstance(kinds[c], StringType)]
    out = df.withColumns({c: decimal_comma(F.col(qident(c))) for c in text}) if text else df
    some = out.agg(*[F.count(F.col(qident(c))).alias(f"_{i}") for i, c in enumerate(text)]).first() if text else []
    empty = {c for i, c in enumerate(text) if not some[i]}
    return out, [c for c in names if c not in empty and (c in text or isinstance(kinds[c], NumericType))]


def write_profile(df: DataFrame, out_dir: str, value_cols: Sequence[str] | None = None,
                  time_cols: Sequence[str] | None = None, mixed_cols: Sequence[str] = ("mixed_type_col",), k: int = 10) -> list[str]:
    """The profile reports of 2.D and the data behind the figures
    (missing values, correlation, box statistics, histograms), each written
    as a Parquet table under ``out_dir``.  Returns the report names.

    Text is coerced to numbers first (``coerced_values``), so polluted columns
    are profiled too; what could not be coerced is in ``non_numeric``.
    """
    from ..operators import profile as P
    from ..operators.ordered import head_n, last_n
    from ..operators.outliers import iqr_fences, outlier_counts, outlier_report

    tcols = [c for c in (time_cols or date_like_columns(df)) if c in df.columns]
    mixed = [c for c in mixed_cols if c in df.columns]
    data, found = coerced_values(df, [*tcols, *mixed])
    num = [c for c in found if value_cols is None or c in value_cols]
    order = tcols[0] if tcols else df.columns[0]
    reports = {
        "shape": P.shape(df),
        "info": P.info(df),
        "head": head_n(df, k, [order]),
        "tail": last_n(df, k, [order]),
        "null_counts": P.null_counts(df),
        "missing": P.missing_table(df),
        "duplicates": P.duplicate_rows(df),
        "describe_all": P.describe_all(data.select(*[F.col(qident(c)) for c in data.columns if c not in tcols])),
    }
    for c in mixed:
        reports[f"frequencies_{c}"] = P.top_values(df, c, k)
    if tcols:
        kind = df.schema[order].dataType
        timed = df.withColumn("_parsed", time_column(df, order))
        raw = timed if isinstance(kind, StringType) else timed.withColumn(order, F.col(qident(order)).cast("string"))
        reports["duplicate_time_keys"] = P.duplicate_keys(df, tcols)
        reports["time_quality"] = P.ts_quality(raw, order, "_parsed")
        reports["duplicate_time_examples"] = P.duplicates(df.where(F.col(qident(order)).isNotNull()), [order]).orderBy(qident(order)).limit(k)
    if num:
        text = [c for c in num if isinstance(df.schema[c].dataType, StringType)]
        if text:
            reports["non_numeric"] = P.non_numeric(df, text, order)
        reports["describe"] = P.describe(data, num)
        reports["correlation"] = P.corr_matrix(data, num)
        fences = iqr_fences(data, num)
        reports["outliers"] = fences
        reports["outlier_counts"] = outlier_counts(data, num)
        reports["outlier_examples"] = outlier_report(data, num, order, fences)
        # figure data: box plot statistics and one trimmed FD histogram per column
        reports["box_stats"] = P.box_stats(data, num)
        for c in num:
            reports[f"histogram_{c}"] = P.histogram(data, c, "fd", (0.01, 0.99))
    text = [c for c in df.columns if c not in num and c not in tcols]
    if text:
        reports["describe_text"] = P.describe_text(df, text)
    for name, rep in reports.items():
        rep.write.mode("overwrite").parquet(os.path.join(out_dir, name))
    return list(reports)
