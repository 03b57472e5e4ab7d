"""Database source (A5, A6 push-down) through Spark's JDBC reader.

No database driver ships with this repository; these helpers build the
reader options.  A full-table load is split into ``numPartitions`` range
reads on ``partitionColumn``; a page is pushed to the database as a
subquery so only that page crosses the wire.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The reference's table and its columns.
TABLE = "power_consumption"
COLUMNS = ["datetime", "zone1", "zone2", "zone3", "total_power", "temperature", "humidity"]


def options_from_env(prefix: str = "DB_", driver: str = "com.mysql.cj.jdbc.Driver") -> dict:
    """Connection options from ``{prefix}USER/PASSWORD/HOST/PORT/NAME``."""
    g = lambda k, d=None: os.environ.get(prefix + k, d)
    return {
        "url": f"jdbc:mysql://{g('HOST', 'localhost')}:{g('PORT', '3306')}/{g('NAME', '')}",
        "user": g("USER", ""),
        "password": g("PASSWORD", ""),
        "driver": driver,
    }


def table_options(base: dict, table: str = TABLE, partition_column: str | None = None, lower: int | None = None,
                  upper: int | None = None, num_partitions: int | None = None, fetch_size: int = 10000) -> dict:
    """A5: options for a full (optionally range-partitioned) table read."""
    opts = dict(base, dbtable=table, fetchsize=str(fetch_size))
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned reads need lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return opts


def page_options(base: dict, page: int = 1, size: int = 1000, table: str = TABLE, order_by: str = "datetime") -> dict:
    """One page as a database-side subquery (LIMIT / OFFSET pushed down)."""
    if page < 1 or size < 1:
        raise ValueError("page and size must be >= 1")
    cols = ", ".join(COLUMNS)
    sub = f"(SELECT {cols} FROM {table} ORDER BY {order_by} ASC LIMIT {int(size)} OFFSET {(page - 1) * int(size)}) AS page"
    return dict(base, dbtable=sub)


def count_options(base: dict, table: str = TABLE) -> dict:
    """The page's total as a database-side ``COUNT(*)``."""
    return dict(base, dbtable=f"(SELECT COUNT(*) AS total FROM {table}) AS total")


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    """A5: ``spark.read.format('jdbc')`` with the given options."""
    if "url" not in options or "dbtable" not in options:
        raise ValueError("jdbc options need 'url' and 'dbtable'")
    return spark.read.format("jdbc").options(**options).load()
