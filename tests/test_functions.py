"""Scalar functions: FIXTURES section 5 literals."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidewise.functions.numbers import decimal_comma, nan_to_null, null_tokens, to_number
from tidewise.functions.text import clean_name, clean_names, label_text, norm_name, resolve_column
from tidewise.functions.times import calendar_fine, calendar_parts, to_ts, to_ts_multi

NUM_IN = ['1.5', ' 2 ', '1e3', 'error', '?', 'nan', 'NAN', ' NAN ', 'inf', '-Infinity', '1_0', '', '0x10',
          '1d', '1f', 'TRUE', '1,5', 'n/a', None]
NUM_OUT = [1.5, 2.0, 1000.0, None, None, None, None, None, math.inf, -math.inf] + [None] * 9


def test_to_number_literals(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(NUM_IN)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(to_number("s")).collect()]
    assert got == NUM_OUT


def test_to_number_on_doubles_maps_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    got = [r[0] for r in df.select(to_number("x")).collect()]
    assert got[0] == 1.0 and got[1] is None and got[2] == math.inf and got[3] is None
    got2 = [r[0] for r in df.select(nan_to_null("x")).collect()]
    assert got2[1] is None and got2[0] == 1.0


def test_null_tokens_and_decimal_comma(spark):
    df = spark.createDataFrame([(" NAN ",), ("error",), ("1,25",), ("x",)], "s string")
    assert [r[0] for r in df.select(null_tokens("s")).collect()] == [None, None, "1,25", "x"]
    assert [r[0] for r in df.select(decimal_comma("s")).collect()] == [None, None, 1.25, None]


TS_OK = ['1/1/2017 0:00', '01/01/2017 00:00', '1/1/2017 0:5']
TS_BAD = [' 1/1/2017 0:10 ', '13/1/2017 0:00', 'bad', '2/30/2017 1:00', None]


def test_to_ts_literals(spark):
    df = spark.createDataFrame([(s,) for s in TS_OK + TS_BAD], "s string")
    got = [r[0] for r in df.select(to_ts("s")).collect()]
    assert got[:3] == [dt.datetime(2017, 1, 1, 0, 0), dt.datetime(2017, 1, 1, 0, 0), dt.datetime(2017, 1, 1, 0, 5)]
    assert got[3:] == [None] * 5
    assert df.select(to_ts("s")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_to_ts_multi(spark):
    df = spark.createDataFrame([("2017-01-02 03:04:05",), ("1/2/2017 3:04",), ("x",)], "s string")
    got = [r[0] for r in df.select(to_ts_multi("s", ["M/d/yyyy H:m", "yyyy-MM-dd HH:mm:ss"])).collect()]
    assert got == [dt.datetime(2017, 1, 2, 3, 4, 5), dt.datetime(2017, 1, 2, 3, 4), None]


def test_calendar_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 7),), (dt.datetime(2024, 1, 7, 0, 0),)], "t timestamp_ntz")
    rows = df.select(*[v.alias(k) for k, v in calendar_parts("t").items()]).collect()
    assert (rows[0]["hour"], rows[0]["dayofweek"], rows[0]["month"]) == (13, 0, 1)
    assert rows[1]["dayofweek"] == 6
    fine = df.select(*[v.alias(k) for k, v in calendar_fine("t").items()]).first()
    assert (fine["hora"], fine["minuto"], fine["dia_de_semana"], fine["dia_del_ano"]) == (13, 7, 0, 1)


def test_clean_names_rules(spark):
    assert clean_name("Zone 2  Power Consumption") == "zone_2_power_consumption"
    assert clean_name(" Wind Speed ") == "wind_speed"
    assert clean_name("a   b") == "a__b"  # three spaces: one pair collapses, two underscores
    assert clean_name("a \t b", collapse="all") == "a_b"
    df = spark.createDataFrame([(1, 2)], "`DateTime` int, `Zone 3  Power Consumption` int")
    assert clean_names(df).columns == ["datetime", "zone_3_power_consumption"]


def test_resolve_column_and_norm(spark):
    df = spark.createDataFrame([(1, 2)], "`Zone 1 Power Consumption` int, datetime int")
    assert resolve_column(df, "zone_1_power_consumption") == "Zone 1 Power Consumption"
    assert norm_name(" Wind-Speed ") == "windspeed"
    try:
        resolve_column(df, "zone")
    except ValueError as e:
        assert "Zone 1 Power Consumption" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_label_text(spark):
    df = spark.createDataFrame([("zone_1_power_consumption",)], "s string")
    assert df.select(label_text("s")).first()[0] == "Zone 1 Power Consumption"


def test_to_ts_strip_option(spark):
    df = spark.createDataFrame([(" 1/1/2017 0:10 ",)], "s string")
    assert df.select(to_ts("s")).first()[0] is None
    assert df.select(to_ts("s", strip=True)).first()[0] == dt.datetime(2017, 1, 1, 0, 10)


def test_column_selection_helpers(spark):
    from tidewise.functions.text import date_like_columns, ensure_columns, numeric_columns, text_columns, value_columns
    df = spark.createDataFrame([(1, 2.0, "a", "x", "m")], "id long, `Zone 1` double, DateTime string, `time_of_day` string, mixed_type_col string")
    assert numeric_columns(df) == ["id", "Zone 1"]
    assert text_columns(df) == ["DateTime", "time_of_day", "mixed_type_col"]
    assert date_like_columns(df) == ["DateTime", "time_of_day"]
    assert value_columns(df) == ["id", "Zone 1", "time_of_day"]
    empty = ensure_columns(df.where("false"), ["id", "DateTime"])
    assert empty.count() == 0 and empty.columns == ["id", "DateTime"]


def test_empty_page_keeps_schema(spark):
    from tidewise.operators.ordered import page
    df = spark.createDataFrame([(1, 2.0)], "id long, v double")
    items, total = page(df, ["id"], page_no=5, size=10)
    assert items.count() == 0 and items.columns == ["id", "v"] and total.first()[0] == 1


def test_api_surface_imports_and_adapters(spark):
    from tidewise import api as tw
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, i), float(i)) for i in range(30)], "ts timestamp_ntz, value double")
    out = tw.add_lags(df, "ts", "value", [1, 2]).orderBy("ts").collect()
    assert out[2]["value_lag2"] == 0.0 and out[0]["value_lag1"] is None
    assert tw.add_calendar(df, "ts").columns[-3:] == ["hour", "dayofweek", "month"]
    assert tw.features(df, "value") == ["ts"]
    assert tw.time_spine(df, "ts", 3, 10).count() == 3
    for name in ("describe", "ensure_schema", "value_counts", "compare_means", "decompose", "var_fit", "var_select",
                 "random_split", "fit_series", "drop_rows_null_in_sparse_cols", "trim", "run_all", "read_csv", "clean_stream"):
        assert callable(getattr(tw, name))


def test_to_number_overflow_is_not_a_number(spark):
    df = spark.createDataFrame([("1e400",), ("-2e308",), ("1e-400",), ("-inf",), ("1e308",), (" -inf ",)], "s string")
    got = [r[0] for r in df.select(to_number("s")).collect()]
    assert got[0] is None and got[1] is None and got[2] == 0.0 and got[3] == -math.inf and got[4] == 1e308
    assert got[5] is None  # pandas pads digits, not the spellings of infinity
