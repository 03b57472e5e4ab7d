"""Small internal helpers shared by the modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def qident(name: str) -> str:
    """Back-quote a column name for SQL / ``F.expr`` use."""
    return "`" + name.replace("`", "``") + "`"


def qtext(value: str) -> str:
    """A SQL string literal for generated expressions."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
