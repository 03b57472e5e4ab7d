"""Quantiles (D12 and everything built on them).

``exact`` (the only exact path, any size): the rows are reduced to a frequency
table (column, value, count; combined map-side, so a value that fills the table
costs one row per task), the distinct values are range-sorted, and the counts
per range partition (one number per partition and column) tell in which
partition each wanted rank lies.  Only those partitions take a running sum.
No task ever holds a column's values or the rows of one value.  The result is
the linear interpolation at ``p * (n - 1)``, unrounded unless asked.

``approx``: ``percentile_approx`` (an observed value, not interpolated).
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage, shuffle_partitions_for
from .stats import nan_safe


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns by number (``_0``, ``_1``, ...), as doubles, NaN as NULL."""
    return nan_safe(df.select(*[F.col(qident(c)).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]))


def frequency_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(key, x, n)``: how often each non-null value of column number ``key`` occurs."""
    cells = F.array(*[F.struct(F.lit(i).alias("key"), F.col(f"_{i}").alias("x")) for i in range(len(cols))])
    long = _as_double(df, cols).select(F.explode(cells).alias("t")).select("t.*").where("x IS NOT NULL")
    return long.groupBy("key", "x").agg(F.count(F.lit(1)).alias("n"))


def _interpolate(lo: float, hi: float, frac: float) -> float:
    return lo if lo == hi else (1 - frac) * lo + frac * hi


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact", accuracy: int = 10000) -> dict:
    """``{(column, p): q}``, NULL for a column without values; for use as literals."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    if method == "approx":
        aggs = [F.percentile_approx(f"_{i}", probs, accuracy).alias(f"a{i}") for i in range(len(cols))]
        row = _as_double(df, cols).agg(*aggs).first()
        return {(c, p): (row[i][j] if row[i] is not None else None) for i, c in enumerate(cols) for j, p in enumerate(probs)}
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    parts = shuffle_partitions_for(df.select(*[F.col(qident(c)) for c in cols]))
    ranged = frequency_table(df, cols).repartitionByRange(parts, "key", "x").withColumn("pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    # one number per partition and column: where each partition begins in its column
    held: dict[int, list] = {}
    for r in ranged.groupBy("key", "pid").agg(F.sum("n").alias("n")).collect():
        held.setdefault(r["key"], []).append((r["pid"], r["n"]))
    wanted, base = [], {}
    for key, own in held.items():
        own.sort()
        ends = list(accumulate(n for _, n in own))
        base.update({(key, pid): end - n for (pid, n), end in zip(own, ends)})
        for p in probs:
            at = p * (ends[-1] - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                pid = own[bisect_right(ends, rank)][0]
                wanted.append((key, pid, rank, rank - base[key, pid]))
    found = {}
    if wanted:
        # at most two ranks per column and probability
        ranks = df.sparkSession.createDataFrame(wanted, "key int, pid int, rank long, local long")
        run = Window.partitionBy("key", "pid").orderBy("x")
        near = ranged.join(F.broadcast(ranks.select("key", "pid").distinct()), ["key", "pid"]).withColumn("upto", F.sum("n").over(run))
        hit = near.join(F.broadcast(ranks), ["key", "pid"]).where("local < upto AND local >= upto - n")
        found = {(r["key"], r["rank"]): r["x"] for r in hit.select("key", "rank", "x").collect()}
    out = {}
    for i, c in enumerate(cols):
        n = sum(k for _, k in held.get(i, []))
        for p in probs:
            at = p * (n - 1)
            lo = math.floor(at)
            out[c, p] = _interpolate(found[i, lo], found[i, math.ceil(at)], at - lo) if n else None
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact",
              accuracy: int = 10000, digits: int | None = 6) -> DataFrame:
    """``(col_name, p, q)`` for every column and probability."""
    got = quantile_values(df, cols, probs, method, accuracy)
    rows = [(c, p, None if q is None else float(q)) for (c, p), q in got.items()]
    out = df.sparkSession.createDataFrame(rows, "col_name string, p double, q double")
    return out if digits is None else out.withColumn("q", F.round("q", digits))
