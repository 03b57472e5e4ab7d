"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .._col import as_col, qident

# Fixed value: the raw table's time pattern (month/day/year hour:minute,
# one- or two-digit fields accepted).
RAW_TS_FORMAT = "M/d/yyyy H:m"


_FIELD_WIDTH = {"yyyy": r"\d{4}", "MM": r"\d{1,2}", "M": r"\d{1,2}", "dd": r"\d{1,2}", "d": r"\d{1,2}",
                "HH": r"\d{1,2}", "H": r"\d{1,2}", "mm": r"\d{1,2}", "m": r"\d{1,2}", "ss": r"\d{1,2}", "s": r"\d{1,2}"}


def _shape(fmt: str) -> str | None:
    """Regex of the text a numeric pattern may match, with the field widths
    of C ``strptime`` (Java's parser takes any number of digits for ``M``,
    ``d``, ``H``, ``m``, ``s`` and ``yyyy``).  None for other patterns."""
    out, i = "^", 0
    while i < len(fmt):
        for tok in sorted(_FIELD_WIDTH, key=len, reverse=True):
            if fmt.startswith(tok, i):
                out += _FIELD_WIDTH[tok]
                i += len(tok)
                break
        else:
            ch = fmt[i]
            if ch.isalpha():
                return None
            out += "\\" + ch if ch in r".^$*+?()[]{}|\/" else ch
            i += 1
    return out + "$"


def to_ts(c, fmt: str = RAW_TS_FORMAT, strip: bool = False) -> Column:
    """H4: parse text with one pattern to TIMESTAMP_NTZ; invalid -> NULL.

    ``try_to_timestamp`` decides validity; the value is produced by
    ``to_timestamp_ntz`` so no session time zone is involved.  Field widths
    follow ``strptime`` (a 3-digit minute is invalid).  Padded text is
    rejected unless ``strip`` (H8) trims it first.
    """
    c = F.trim(as_col(c)) if strip else as_col(c)
    ok = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    shape = _shape(fmt)
    if shape is not None:
        ok = ok & c.rlike(shape)
    return F.when(ok, F.to_timestamp_ntz(c, F.lit(fmt)))


def time_column(df: DataFrame, name: str, fmt: str = RAW_TS_FORMAT) -> Column:
    """H4 by the column's type: time types pass through (as TIMESTAMP_NTZ), text is parsed."""
    kind = df.schema[name].dataType
    c = F.col(qident(name))
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return c.cast("timestamp_ntz")
    return to_ts(c.cast("string"), fmt)


def to_ts_multi(c, fmts: Sequence[str]) -> Column:
    """H5: first pattern of a declared list that parses."""
    return F.coalesce(*[to_ts(c, f) for f in fmts])


def calendar_parts(ts) -> dict[str, Column]:
    """H6: hour, dayofweek (Monday = 0), month as BIGINT."""
    ts = as_col(ts)
    return {
        "hour": F.hour(ts).cast("bigint"),
        "dayofweek": F.weekday(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
    }


def calendar_fine(ts) -> dict[str, Column]:
    """H7: hora, minuto, dia_de_semana (Monday = 0), dia_del_ano as BIGINT."""
    ts = as_col(ts)
    return {
        "hora": F.hour(ts).cast("bigint"),
        "minuto": F.minute(ts).cast("bigint"),
        "dia_de_semana": F.weekday(ts).cast("bigint"),
        "dia_del_ano": F.dayofyear(ts).cast("bigint"),
    }


def add_minutes(ts, minutes: int) -> Column:
    """``ts + INTERVAL n MINUTES`` keeping the timestamp type."""
    return as_col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))


def ts_text(ts) -> Column:
    """``str(datetime)`` form used in page items."""
    return F.date_format(as_col(ts), "yyyy-MM-dd HH:mm:ss")


def day_start(ts) -> Column:
    """Calendar-day floor that keeps TIMESTAMP_NTZ (``date_trunc`` would not)."""
    return F.to_timestamp_ntz(F.to_date(as_col(ts)).cast("string"))
