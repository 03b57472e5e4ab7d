"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.numbers import to_number
from ..functions.times import to_ts
from .fixtures import original_events, polluted_events, table

__all__ = ["table", "polluted_events", "original_events", "coerced", "events", "LINEITEM_NUM"]

# numeric columns of lineitem used by the wide profiles
LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polluted view after H4 on the time text and H1 on the value texts."""
    p = polluted_events(spark, sf_dir)
    return p.select(
        "event_id", "user_id", "event_type", "raw_ts",
        to_ts("raw_ts").alias("ts"),
        to_number("raw_value").alias("value"),
        to_number("raw_k").alias("k"),
        "mixed_type_col",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
