"""Query registry: ``key -> (spark builder, DuckDB oracle SQL or None)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``.

    ``sql`` is the DuckDB oracle over the driver's views; ``None`` marks an
    operator with no SQL form (rows-only check plus a pytest).
    """
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so the registry is filled."""
    from . import (  # noqa: F401
        q_clean,
        q_features,
        q_missing,
        q_models,
        q_ordered,
        q_outliers,
        q_profile,
        q_scalar,
        q_timeseries,
    )
