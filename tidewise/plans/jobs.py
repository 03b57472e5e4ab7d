"""User-level jobs (M1-M6): load -> profile -> preprocess -> train -> evaluate.

Each job reads and writes tables by path so they can run one at a time
(as separate stages) or chained by ``run_all`` in one session.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.clean import PreprocessSpec, preprocess
from ..operators.models import GBT_PRODUCTION, load_model, metrics_record, regression_metrics, regression_pipeline, save_model
from ..sources.files import load, write_metrics, write_parquet, write_profile
from ..sources.runlog import log_run


@dataclass
class JobConfig:
    """One configuration for the whole run (paths relative to ``root``)."""

    root: str
    source: str = "file"
    input_path: str | None = None
    jdbc: dict | None = None
    spec: PreprocessSpec = field(default_factory=PreprocessSpec)
    model: str = "gbt"
    model_params: dict = field(default_factory=lambda: dict(GBT_PRODUCTION))
    run_name: str | None = None
    page: int | None = None  # of a database source
    size: int | None = None

    def p(self, name: str) -> str:
        return os.path.join(self.root, name)


def load_job(spark: SparkSession, cfg: JobConfig) -> str:
    """M2: A4 + B1 + A8 -> ``loaded``."""
    df = load(spark, cfg.source, cfg.input_path, jdbc=cfg.jdbc, page=cfg.page, size=cfg.size)
    write_parquet(df, cfg.p("loaded"))
    return cfg.p("loaded")


def profile_job(spark: SparkSession, cfg: JobConfig) -> list[str]:
    """M3: every report of 2.D -> ``reports/<name>``."""
    return write_profile(spark.read.parquet(cfg.p("loaded")), cfg.p("reports"), time_cols=[cfg.spec.raw_ts], mixed_cols=cfg.spec.drop)


def preprocess_job(spark: SparkSession, cfg: JobConfig) -> tuple[str, str]:
    """M4: I6 -> ``cleaned``, ``train``, ``test``."""
    out = preprocess(spark.read.parquet(cfg.p("loaded")), cfg.spec)
    write_parquet(out, cfg.p("cleaned"))
    cleaned = spark.read.parquet(cfg.p("cleaned"))
    write_parquet(cleaned.where(F.col("split") == "train").drop("split"), cfg.p("train"))
    write_parquet(cleaned.where(F.col("split") == "test").drop("split"), cfg.p("test"))
    return cfg.p("train"), cfg.p("test")


def feature_columns(df, spec: PreprocessSpec) -> list[str]:
    skip = {spec.target, "ordinal", "split", *spec.ids}
    return [f.name for f in df.schema.fields if f.name not in skip and f.dataType.typeName() in ("double", "long", "integer")]


def train_job(spark: SparkSession, cfg: JobConfig) -> str:
    """M5: J1 + J2 + model as one pipeline (so scoring uses the same
    transforms), saved whole (A11)."""
    train = spark.read.parquet(cfg.p("train"))
    feats = feature_columns(train, cfg.spec)
    pipe = regression_pipeline(feats, cfg.spec.target, cfg.model, impute=feats, scale=feats, params=cfg.model_params)
    save_model(pipe.fit(train), cfg.p("model"))
    return cfg.p("model")


def evaluate_job(spark: SparkSession, cfg: JobConfig) -> dict:
    """M6: A11 + J9 + J10 + J11 + A10 + A12."""
    test = spark.read.parquet(cfg.p("test"))
    model = load_model(cfg.p("model"))
    scored = model.transform(test).select("ordinal", F.col(cfg.spec.target).alias("y_true"), F.col("prediction").alias("y_pred"))
    write_parquet(scored, cfg.p("pred_vs_actual"))  # scored once; all else reads it
    m = regression_metrics(spark.read.parquet(cfg.p("pred_vs_actual")), "y_true", "y_pred")
    row = m.first().asDict()
    runs = os.environ.get("TIDEWISE_RUNS") or cfg.p("runs")
    name = cfg.run_name or os.environ.get("TIDEWISE_RUN_NAME")
    rid = log_run(spark, runs, {"model": cfg.model, **cfg.model_params}, row, run_name=name)
    write_metrics(metrics_record(m, rid), cfg.p("metrics"))
    return {"run_id": rid, **row}


def run_all(spark: SparkSession, cfg: JobConfig) -> dict:
    """M1: the whole flow; tables on disk between stages."""
    load_job(spark, cfg)
    profile_job(spark, cfg)
    preprocess_job(spark, cfg)
    model_path = train_job(spark, cfg)
    return {"model": model_path, "eval": evaluate_job(spark, cfg)}
