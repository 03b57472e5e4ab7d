"""H1 against pandas itself: random numeric-looking text, one Spark job per batch."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewise.functions.numbers import to_number

ATOMS = ["0", "1", "7", "42", ".", "e", "E", "+", "-", " ", "\t", "inf", "INF", "Infinity", "nan", "_", ",", "x", "d", "1e3", ".5"]
texts = st.lists(st.sampled_from(ATOMS), min_size=0, max_size=6).map("".join)


def _pandas(values):
    out = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").tolist()
    return [None if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v) for v in out]


@settings(max_examples=8, deadline=None)
@given(st.lists(texts, min_size=20, max_size=120))
def test_to_number_matches_pandas(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(to_number("s")).collect()]
    want = _pandas(values)
    for v, g, w in zip(values, got, want):
        assert g == w or (g is not None and w is not None and math.isclose(g, w, rel_tol=1e-15)), (repr(v), g, w)


from tidewise.functions.times import to_ts  # noqa: E402

DATE_ATOMS = ["1", "01", "001", "12", "13", "2", "29", "30", "31", "0", "00", "5", "59", "60", "23", "24"]
dates = st.tuples(st.sampled_from(DATE_ATOMS), st.sampled_from(DATE_ATOMS), st.sampled_from(["2017", "2016", "02017", "17"]),
                  st.sampled_from(DATE_ATOMS), st.sampled_from(DATE_ATOMS), st.sampled_from(["", " ", "x"])) \
    .map(lambda t: f"{t[0]}/{t[1]}/{t[2]} {t[3]}:{t[4]}{t[5]}")


@settings(max_examples=6, deadline=None)
@given(st.lists(dates, min_size=20, max_size=120))
def test_to_ts_matches_pandas(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(to_ts("s")).collect()]
    want = pd.to_datetime(pd.Series(values, dtype=object), format="%m/%d/%Y %H:%M", errors="coerce").tolist()
    for v, g, w in zip(values, got, want):
        w = None if pd.isna(w) else w.to_pydatetime()
        assert g == w, (repr(v), g, w)


from tidewise.functions.text import clean_name  # noqa: E402


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" aZ1_\t", max_size=12))
def test_clean_name_rule(name):
    # B1 stated directly: strip, lower, one left-to-right pass turning "  " into " ", then " " into "_"
    expect = name.strip().lower().replace("  ", " ").replace(" ", "_")
    assert clean_name(name) == expect
    assert " " not in clean_name(name)
