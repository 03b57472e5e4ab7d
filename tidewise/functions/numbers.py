"""Text -> number coercion (H1-H3, H8) and the NaN rule.

Semantics follow ``pandas.to_numeric(errors="coerce")`` on text cells:
surrounding blanks are allowed, ``1e3`` parses, ``inf``/``infinity`` keep
their sign, every spelling of ``nan`` becomes NULL, and everything else
(``1d``, ``1_0``, ``0x10``, ``1,5``, ``TRUE``, ``''``) becomes NULL.
Spark's own cast accepts ``1d``/``1f`` and so is guarded by a regex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col

# Fixed value: grammar of a number that pandas' coercion accepts (blanks may
# pad digits, but not the spellings of infinity).
NUMBER_PATTERN = r"^(\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*|[+-]?(?i:inf|infinity))$"
INF_PATTERN = r"^[+-]?(?i:inf|infinity)$"

# The spellings the cleaning notebook maps to missing before coercion.
INVALID_TOKENS = [
    "error", "invalid", "?", "NAN", "n/a", "null", "INVALID",
    "ERROR", " NAN ", " ? ", " ERROR ", " INVALID ", " n/a ", " null ",
]

# Cells pandas' CSV reader turns into missing by default.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def nan_to_null(c) -> Column:
    """NaN -> NULL for a double column; other values unchanged."""
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def to_number(c) -> Column:
    """H1: coerce text (or a number) to DOUBLE with pandas' coercion rules.

    Like pandas, a finite literal that overflows (``1e400``) is not a
    number, while the spellings of infinity keep their sign."""
    c = as_col(c)
    txt = c.cast("string")
    val = F.trim(txt).try_cast("double")
    keep = txt.rlike(NUMBER_PATTERN) & (txt.rlike(INF_PATTERN) | (F.abs(val) < F.lit(float("inf"))))
    return F.when(keep, val)


def null_tokens(c, tokens=None) -> Column:
    """H2: exact-match invalid spellings -> NULL (text stays text)."""
    c = as_col(c)
    toks = list(INVALID_TOKENS if tokens is None else tokens)
    return F.when(~c.isin(toks), c)


def decimal_comma(c) -> Column:
    """H3: ``,`` -> ``.`` on text, then H1."""
    return to_number(F.replace(as_col(c).cast("string"), F.lit(","), F.lit(".")))


def csv_nulls(c, tokens=None) -> Column:
    """A1 helper: pandas' default CSV null cells -> NULL."""
    c = as_col(c)
    toks = list(CSV_NULL_TOKENS if tokens is None else tokens)
    return F.when(~c.isin(toks), c)


def is_finite(c) -> Column:
    """TRUE for a finite, non-null double."""
    c = as_col(c)
    return c.isNotNull() & (F.abs(c) < F.lit(float("inf")))
