"""Stand-in inputs built from the driver tables.

The reference works on one polluted 10-minute measurement table.  The
driver tables have no such table, so ``polluted_events`` derives rows of
that *shape* from ``events``: a text time column, a text target, a text
feature and a mixed-type column.  It only supplies input rows; every
cleaning / profiling step runs afterwards through the library.

The same view is given as DuckDB SQL so oracle queries start from the
identical rows (checked row by row at all three scales).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_POLLUTED = """
SELECT event_id, user_id, event_type,
 CASE WHEN event_id % 127 = 5 THEN NULL WHEN event_id % 131 = 7 THEN 'bad-date'
      WHEN event_id % 137 = 9 THEN '13/45/2024 99:00' ELSE {fmt} END AS raw_ts,
 CASE WHEN event_id % 83 = 1 THEN NULL WHEN event_id % 97 = 2 THEN 'error'
      WHEN event_id % 89 = 3 THEN ' ? ' WHEN event_id % 79 = 4 THEN 'n/a'
      WHEN event_id % 101 = 6 THEN CAST(value * 16 AS {st}) ELSE CAST(value AS {st}) END AS raw_value,
 CASE WHEN event_id % 61 = 8 THEN 'INVALID' WHEN event_id % 67 = 10 THEN '1d' ELSE {js} END AS raw_k,
 CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 AS {st}) WHEN 1 THEN 'mixed'
      WHEN 2 THEN NULL ELSE 'x y' END AS mixed_type_col
FROM {src}
"""

POLLUTED_SPARK = _POLLUTED.format(
    st="STRING", fmt="date_format(ts,'M/d/yyyy H:mm')", js="get_json_object(props,'$.k')", src="{src}"
)
POLLUTED_DUCK = _POLLUTED.format(
    st="VARCHAR",
    fmt="strftime(ts,'%-m/%-d/%Y %-H:%M')",
    js="regexp_extract(props,'\"k\": ([0-9]+)',1)",
    src="events",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A2 scan of one driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def polluted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polluted text view of ``events`` (stand-in for the raw CSV)."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        "event_id", "user_id", "event_type",
        "CASE WHEN event_id % 127 = 5 THEN NULL WHEN event_id % 131 = 7 THEN 'bad-date' "
        "WHEN event_id % 137 = 9 THEN '13/45/2024 99:00' ELSE date_format(ts,'M/d/yyyy H:mm') END AS raw_ts",
        "CASE WHEN event_id % 83 = 1 THEN NULL WHEN event_id % 97 = 2 THEN 'error' "
        "WHEN event_id % 89 = 3 THEN ' ? ' WHEN event_id % 79 = 4 THEN 'n/a' "
        "WHEN event_id % 101 = 6 THEN CAST(value * 16 AS STRING) ELSE CAST(value AS STRING) END AS raw_value",
        "CASE WHEN event_id % 61 = 8 THEN 'INVALID' WHEN event_id % 67 = 10 THEN '1d' "
        "ELSE get_json_object(props,'$.k') END AS raw_k",
        "CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 AS STRING) WHEN 1 THEN 'mixed' "
        "WHEN 2 THEN NULL ELSE 'x y' END AS mixed_type_col",
    )


def original_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean counterpart ("original" table): ``ts, value, k`` by event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "value", "CAST(get_json_object(props,'$.k') AS DOUBLE) AS k"
    )


# DuckDB CTE prefixes for the oracle SQL.
DUCK_POLLUTED_CTE = "p AS (" + POLLUTED_DUCK + ")"
DUCK_ORIGINAL_CTE = (
    "o AS (SELECT event_id, ts, value, "
    "CAST(regexp_extract(props,'\"k\": ([0-9]+)',1) AS DOUBLE) AS k FROM events)"
)
