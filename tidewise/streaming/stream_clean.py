"""Row-local cleaning on a streaming DataFrame.

The reference has no streaming operator.  The stateless steps of the
cleaning flow (text -> number, text -> time, invalid tokens, required
columns, non-finite rows, calendar parts) are plain column expressions, so
they apply unchanged to ``readStream`` input; stateful steps (quantile
fences, de-duplication by time, lags) need the whole history and stay
batch jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._col import qident
from ..functions.numbers import is_finite, null_tokens, to_number
from ..functions.times import RAW_TS_FORMAT, calendar_parts, to_ts


def clean_stream(df: DataFrame, raw_ts: str, value_cols: Sequence[str], ts: str = "ts", fmt: str = RAW_TS_FORMAT,
                 drop: Sequence[str] = ("mixed_type_col",), require: Sequence[str] = ()) -> DataFrame:
    """Coerce, parse and filter rows of a (streaming or batch) DataFrame."""
    out = df.drop(*[c for c in drop if c in df.columns])
    out = out.withColumns({c: to_number(null_tokens(F.col(qident(c)).cast("string"))) for c in value_cols})
    out = out.withColumn(ts, to_ts(F.col(qident(raw_ts)), fmt)).where(F.col(ts).isNotNull())
    for c in require:
        out = out.where(is_finite(F.col(qident(c))))
    return out.withColumns(calendar_parts(F.col(ts)))
