"""Run log (A12): an append-only Parquet table of runs.

Stands in for a tracking server: one row per run with its parameters and
metrics; "best run" is a sort on a metric.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, run_name string, params map<string,string>, metrics map<string,double>, logged_at timestamp_ntz"


def log_run(spark: SparkSession, path: str, params: dict, metrics: dict, run_name: str | None = None,
            run_id: str | None = None) -> str:
    """Append one run; returns its id."""
    rid = run_id or uuid.uuid4().hex
    row = [(rid, run_name, {str(k): str(v) for k, v in params.items()},
            {str(k): (None if v is None else float(v)) for k, v in metrics.items()}, dt.datetime.now())]
    spark.createDataFrame(row, SCHEMA).write.mode("append").parquet(path)
    return rid


def runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def best_run(spark: SparkSession, path: str, metric: str = "rmse", ascending: bool = True) -> DataFrame:
    m = F.col("metrics")[metric]
    return runs(spark, path).where(m.isNotNull()).orderBy(m.asc() if ascending else m.desc()).limit(1)
