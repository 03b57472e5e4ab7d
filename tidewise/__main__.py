"""Run the jobs (M1-M6) one stage at a time or chained.

    python -m tidewise run-all  --root /shared/run1 --input /shared/raw.parquet
    python -m tidewise load     --root /shared/run1 --input /shared/raw.csv
    python -m tidewise profile|preprocess|train|evaluate --root /shared/run1
    python -m tidewise run-all  --root /shared/run1 --input /shared/raw.csv --time-column datetime --target zone_1_power_consumption \\
        --features temperature,humidity --ids "" --lags 1,24,168 --test-size 0.3

Under ``spark-submit`` the session comes from the submit configuration;
``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.clean import PreprocessSpec
from .plans import jobs as J
from .session import ensure_checkpoint_dir

STAGES = {
    "load": J.load_job,
    "profile": J.profile_job,
    "preprocess": J.preprocess_job,
    "train": J.train_job,
    "evaluate": J.evaluate_job,
    "run-all": J.run_all,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    ap = argparse.ArgumentParser(prog="python -m tidewise")
    ap.add_argument("stage", choices=sorted(STAGES))
    ap.add_argument("--root", required=True, help="folder for the stage tables (shared storage on a cluster)")
    ap.add_argument("--input", help="raw CSV / Parquet path for the load stage")
    ap.add_argument("--source", default="file", choices=["file", "db"])
    ap.add_argument("--model", default="gbt", choices=["gbt", "linear", "rf"])
    ap.add_argument("--page", type=int, help="page of a database source (default 1)")
    ap.add_argument("--size", type=int, help="rows of that page (default 1000)")
    ap.add_argument("--time-column", help="column with the time, text or time type")
    ap.add_argument("--target", help="column to forecast")
    ap.add_argument("--features", help="value columns, separated by commas")
    ap.add_argument("--ids", help="columns that identify a row, separated by commas; the first one breaks ties of time")
    ap.add_argument("--drop", help="columns to leave out, separated by commas")
    ap.add_argument("--lags", help="lags of the target in rows, separated by commas")
    ap.add_argument("--test-size", type=float)
    ap.add_argument("--run-name")
    ap.add_argument("--master", help="local runs only, e.g. local[8]")
    args = ap.parse_args(argv)
    if spark is None:
        b = SparkSession.builder.appName(f"tidewise-{args.stage}")
        if args.master:
            b = b.master(args.master).config("spark.ui.enabled", "false")
        spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    names = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    spec = PreprocessSpec()
    if args.time_column:
        spec.raw_ts = args.time_column
        spec.extra_drop = [args.time_column]
    if args.ids is not None:
        spec.ids = names(args.ids)
        spec.tiebreak = spec.ids[0] if spec.ids else ""
    given = {"target": args.target, "features": args.features and names(args.features), "drop": args.drop and names(args.drop),
             "lags": args.lags and [int(x) for x in names(args.lags)], "test_size": args.test_size}
    for field, value in given.items():
        if value is not None:
            setattr(spec, field, value)
    cfg = J.JobConfig(root=args.root, source=args.source, input_path=args.input, model=args.model, run_name=args.run_name, spec=spec,
                      page=args.page, size=args.size)
    if args.model != "gbt":
        cfg.model_params = {}
    result = STAGES[args.stage](spark, cfg)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
