"""Sources, sinks, JDBC option building, streaming and the job chain."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewise.sources import files as IO
from tidewise.sources import jdbc as J
from tidewise.sources.runlog import best_run, log_run


CSV = """DateTime,Temperature,Zone 2  Power Consumption,mixed_type_col
1/1/2017 0:00,6.5,100.5,x
1/1/2017 0:10,error,NA,1
1/1/2017 0:20, 7 ,n/a,
"""


def test_read_csv_typing(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    df = IO.read_csv(spark, str(p))
    types = dict(df.dtypes)
    assert types["DateTime"] == "timestamp_ntz"
    assert types["Temperature"] == "string"  # one bad cell keeps the column text
    assert types["Zone 2  Power Consumption"] == "double"  # NA / n/a are missing, rest numeric
    rows = df.orderBy("DateTime").collect()
    assert rows[0]["DateTime"] == dt.datetime(2017, 1, 1, 0, 0) and rows[1]["Zone 2  Power Consumption"] is None
    assert rows[2]["mixed_type_col"] is None
    loaded = IO.load(spark, "FILE", str(p))
    assert loaded.columns == ["datetime", "temperature", "zone_2_power_consumption", "mixed_type_col"]


def test_load_dispatch_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        IO.load_file(spark, None)
    with pytest.raises(FileNotFoundError):
        IO.load_file(spark, str(tmp_path / "missing.csv"))
    bad = tmp_path / "x.txt"
    bad.write_text("a")
    with pytest.raises(ValueError):
        IO.load_file(spark, str(bad))
    with pytest.raises(ValueError):
        IO.load(spark, "ftp", str(bad))


def test_parquet_round_trip_and_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    IO.write_parquet(df, str(tmp_path / "t.parquet"))
    assert sorted(IO.load_file(spark, str(tmp_path / "t.parquet")).collect()) == sorted(df.collect())
    IO.write_csv(df, str(tmp_path / "t_csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "t_csv"))
    assert back.columns == ["i", "s"] and back.count() == 2


def test_jdbc_options():
    base = {"url": "jdbc:mysql://h:3306/db", "user": "u", "password": "p"}
    o = J.table_options(base, partition_column="id", lower=0, upper=100, num_partitions=4)
    assert o["numPartitions"] == "4" and o["dbtable"] == "power_consumption"
    pg = J.page_options(base, page=3, size=10)
    assert "LIMIT 10 OFFSET 20" in pg["dbtable"] and "ORDER BY datetime ASC" in pg["dbtable"]
    with pytest.raises(ValueError):
        J.page_options(base, page=0)


def test_page_sql_on_temp_view(spark):
    """A6's SQL shape, run on a temp view (no database driver here)."""
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, i), float(i)) for i in range(25)], "datetime timestamp_ntz, zone1 double") \
        .createOrReplaceTempView("power_consumption_v")
    got = spark.sql("SELECT zone1 FROM power_consumption_v ORDER BY datetime ASC LIMIT 10 OFFSET 20").collect()
    assert [r[0] for r in got] == [20.0, 21.0, 22.0, 23.0, 24.0]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, {"depth": 6}, {"rmse": 2.0}, "a")
    log_run(spark, path, {"depth": 3}, {"rmse": 1.5}, "b")
    assert best_run(spark, path).first()["run_name"] == "b"


def test_stream_clean_matches_batch(spark, tmp_path):
    from tests.conftest import SF001
    from tidewise.plans.common import polluted_events
    from tidewise.streaming.stream_clean import clean_stream
    src = str(tmp_path / "in")
    polluted_events(spark, SF001).repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = clean_stream(stream, "raw_ts", ["raw_value", "raw_k"]).writeStream.format("memory").queryName("cleaned_stream") \
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    batch = clean_stream(spark.read.parquet(src), "raw_ts", ["raw_value", "raw_k"])
    assert spark.table("cleaned_stream").count() == batch.count() > 0


def test_job_chain(spark, tmp_path):
    from tests.conftest import SF001
    from tidewise.plans.jobs import JobConfig, run_all
    from tidewise.plans.q_clean import polluted_named
    raw = str(tmp_path / "raw.parquet")
    polluted_named(spark, SF001).write.parquet(raw)
    cfg = JobConfig(root=str(tmp_path / "run"), input_path=raw, model="linear", model_params={})
    out = run_all(spark, cfg)
    assert out["eval"]["n_test"] > 0 and out["eval"]["rmse"] >= 0
    rec = [json.loads(l) for f in os.listdir(cfg.p("metrics")) if f.endswith(".json")
           for l in open(os.path.join(cfg.p("metrics"), f))]
    assert set(rec[0]["metrics"]) == {"mae", "mse", "rmse", "r2", "n_test"}
    assert os.path.isdir(os.path.join(cfg.p("reports"), "describe"))
    assert os.path.isdir(os.path.join(cfg.p("reports"), "box_stats"))
    assert any(n.startswith("histogram_") for n in os.listdir(cfg.p("reports")))


def test_cli_stages(spark, tmp_path):
    from tests.conftest import SF001
    from tidewise.__main__ import main
    from tidewise.plans.q_clean import polluted_named
    raw = str(tmp_path / "raw.parquet")
    polluted_named(spark, SF001).write.parquet(raw)
    root = str(tmp_path / "run")
    main(["load", "--root", root, "--input", raw, "--model", "linear"], spark=spark)
    main(["preprocess", "--root", root, "--model", "linear"], spark=spark)
    main(["train", "--root", root, "--model", "linear"], spark=spark)
    out = main(["evaluate", "--root", root, "--model", "linear"], spark=spark)
    assert out["n_test"] > 0


HEADERS = "DateTime,Temperature,Humidity,Zone 1 Power Consumption,Zone 2  Power Consumption,mixed_type_col"


def _measurements(polluted: bool) -> str:
    rows = []
    for i in range(420):
        t = dt.datetime(2017, 1, 1) + dt.timedelta(minutes=10 * i)
        temp = "error" if polluted and i % 50 == 7 else f"{10 + i % 13}"
        zone = " ? " if polluted and i % 60 == 9 else f"{30000 + 10 * (i % 144)}"
        time = "bad" if polluted and i % 70 == 3 else f"{t.month}/{t.day}/{t.year} {t.hour}:{t.minute:02d}"
        rows.append(f"{time},{temp},{60 + i % 7},{zone},{20000 + i},{'x' if i % 2 else i}")
    return "\n".join([HEADERS, *rows]) + "\n"


@pytest.mark.parametrize("polluted", [True, False])
def test_run_all_on_another_schema(spark, tmp_path, polluted):
    """The command line on the measurement table's own headers, text polluted or clean."""
    from tidewise.__main__ import main

    raw, root = tmp_path / "raw.csv", str(tmp_path / "run")
    raw.write_text(_measurements(polluted))
    out = main(["run-all", "--root", root, "--input", str(raw), "--model", "linear", "--time-column", "datetime",
                "--target", "zone_1_power_consumption", "--features", "temperature,humidity", "--ids", "", "--lags", "1,24",
                "--drop", "mixed_type_col,zone_2_power_consumption"], spark=spark)
    assert out["eval"]["n_test"] > 80 and out["eval"]["rmse"] >= 0
    cleaned = spark.read.parquet(f"{root}/cleaned")
    assert cleaned.count() >= (350 if polluted else 396)
    report = lambda name: spark.read.parquet(f"{root}/reports/{name}").collect()
    means = {r["col_name"]: r["count"] for r in report("describe")}
    assert set(means) == {"temperature", "humidity", "zone_1_power_consumption"} and means["temperature"] == (411 if polluted else 420)
    assert report("shape")[0][0] == 420 and len(report("head")) == len(report("tail")) == 10
    assert report("time_quality")[0]["n_unparseable"] == (6 if polluted else 0)
    assert {r["col_name"] for r in report("outlier_counts")} == set(means)
    assert {r["value"] for r in report("frequencies_mixed_type_col")} >= {"x"}
    if polluted:
        assert {r["value"] for r in report("non_numeric")} == {"error", " ? "}


def test_paths_go_through_sparks_file_system(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    assert IO.load_file(spark, f"file://{p}").count() == IO.load_file(spark, f"file:{p}").count() == 3
    with pytest.raises(FileNotFoundError):
        IO.load_file(spark, f"file://{tmp_path}/none.csv")


def test_database_source_takes_environment_and_page(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(J, "read_jdbc", lambda spark, options: asked.update(options) or spark.createDataFrame([(1,)], "`Zone 1` int"))
    monkeypatch.setenv("DB_HOST", "db.example")
    monkeypatch.setenv("DB_NAME", "power")
    assert IO.load(spark, "DB").columns == ["zone_1"]
    assert asked["url"] == "jdbc:mysql://db.example:3306/power" and "LIMIT 1000 OFFSET 0" in asked["dbtable"]
    IO.load(spark, "db", page=3, size=10)
    assert "LIMIT 10 OFFSET 20" in asked["dbtable"]
