"""DuckDB fragments for the oracle SQL, mirroring the library's rules."""

from __future__ import annotations

from ..functions.numbers import INF_PATTERN, INVALID_TOKENS, NUMBER_PATTERN
from .fixtures import DUCK_ORIGINAL_CTE, DUCK_POLLUTED_CTE

_RE2_NUMBER = NUMBER_PATTERN  # same grammar, RE2 accepts the Java form used here
_TS_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$"


def num(x: str) -> str:
    """H1 in DuckDB."""
    v = f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE)"
    return (f"(CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{_RE2_NUMBER}') AND "
            f"(regexp_matches(CAST({x} AS VARCHAR), '{INF_PATTERN}') OR isfinite({v})) THEN {v} END)")


def ts(x: str) -> str:
    """H4 in DuckDB (DuckDB accepts padded text, so the shape is checked)."""
    return f"(CASE WHEN regexp_matches({x}, '{_TS_SHAPE}') THEN try_strptime({x}, '%m/%d/%Y %H:%M') END)"


def tokens_list() -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in INVALID_TOKENS)


def with_polluted(body: str, extra: str = "") -> str:
    """``WITH p AS (polluted view)[, extra] body``."""
    ctes = DUCK_POLLUTED_CTE + (", " + extra if extra else "")
    return f"WITH {ctes} {body}"


# coerced polluted view: c(event_id, user_id, event_type, raw_ts, ts, value, k, mixed_type_col)
COERCED_CTE = (
    f"c AS (SELECT event_id, user_id, event_type, raw_ts, {ts('raw_ts')} AS ts, "
    f"{num('raw_value')} AS value, {num('raw_k')} AS k, mixed_type_col FROM p)"
)
ORIGINAL_CTE = DUCK_ORIGINAL_CTE


def with_coerced(body: str, extra: str = "") -> str:
    return with_polluted(body, COERCED_CTE + (", " + extra if extra else ""))
