"""D20 for many columns: Pearson correlation by masked block products.

One expression for each pair is no plan for hundreds of columns (125,000 pairs
at 500).  Here the columns are cut into blocks.  For two blocks every task
multiplies its rows' values and presence masks as matrices and keeps six
numbers a pair (rows with both, both sums, both sums of squares, the products);
the tasks' numbers are added cell by cell by Spark.  A worker holds the
products of one pair of blocks and a few thousand rows, whatever the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._col import qident
from .stats import nan_safe

#: Columns in a block: six matrices of this size in a worker (2 MB each).
BLOCK = 512
#: Rows multiplied at once.
SLICE = 4096
#: Share of a pair's mean square, about the columns' means, below which a spread is rounding.
ROUNDING = 1e-12

SUMS = ("n", "sa", "sb", "qa", "qb", "xy", "inf")
PARTIAL = "i int, j0 int, " + ", ".join(f"{s} array<double>" for s in SUMS)


def _matrix(cells: pa.Array, width: int) -> np.ndarray:
    return cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def _sides(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Values with 0 for missing and infinite cells, who is present, and who is infinite."""
    here = ~np.isnan(values)
    endless = np.isinf(values)
    some = bool(endless.any())
    return np.where(here & ~endless, values, 0.0), here.astype(np.float64), endless.astype(np.float64) if some else None


def _products(first: int, left: int, second: int, right: int):
    """A ``mapInArrow`` function: the sums of one pair of blocks over a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), left, right))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                a, in_a, no_a = _sides(_matrix(part.column(0), left))
                b, in_b, no_b = (a, in_a, no_a) if first == second else _sides(_matrix(part.column(1), right))
                total += np.stack([in_a.T @ in_b, a.T @ in_b, in_a.T @ b, (a * a).T @ in_b, in_a.T @ (b * b), a.T @ b,
                                   (0 if no_a is None else no_a.T @ in_b) + (0 if no_b is None else in_a.T @ no_b) + np.zeros((left, right))])
        if not total[0].any():
            return
        for i in range(left):
            skip = i if first == second else 0  # the lower triangle mirrors the upper one
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + i], pa.int32()), pa.array([second + skip], pa.int32()),
                 *[pa.array([total[s, i, skip:]], pa.list_(pa.float64())) for s in range(len(SUMS))]],
                names=["i", "j0", *SUMS])
    return run


def corr_wide(df: DataFrame, cols: Sequence[str], digits: int = 6, block: int = BLOCK) -> DataFrame:
    """``(col_a, col_b, corr)`` for every ordered pair, over the rows that have both.

    NaN is missing.  NULL where a pair has an infinite value, no rows, or a
    column that is constant over the pair's rows: its spread there is under a
    millionth of its distance from the column's mean.  The diagonal is 1.
    """
    cols = list(cols)
    spark = df.sparkSession
    wide = nan_safe(df.select(*[F.col(qident(c)).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]))
    # values about their means (one number a column), so that sums of squares keep their digits
    means = wide.agg(*[F.avg(F.when(F.abs(f"_{i}") < float("inf"), F.col(f"_{i}"))).alias(f"_{i}") for i in range(len(cols))]).first()
    centred = [F.col(f"_{i}") - F.lit(means[i] or 0.0) for i in range(len(cols))]
    starts = range(0, len(cols), block)
    parts = None
    for p in starts:
        for q in (s for s in starts if s >= p):
            a, b = centred[p:p + block], centred[q:q + block]
            rows = wide.select(F.array(*a).alias("a"), *([] if p == q else [F.array(*b).alias("b")]))
            got = rows.mapInArrow(_products(p, len(a), q, len(b)), PARTIAL)
            parts = got if parts is None else parts.unionByName(got)
    cells = parts.select("i", "j0", F.posexplode(F.arrays_zip(*SUMS)).alias("at", "c")).select(
        "i", (F.col("j0") + F.col("at")).alias("j"), "c.*")
    sums = cells.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])
    n = F.nullif(F.col("n"), F.lit(0.0))
    va, vb = F.col("qa") - F.col("sa") * F.col("sa") / n, F.col("qb") - F.col("sb") * F.col("sb") / n
    spread = (F.col("inf") == 0) & (va > F.col("qa") * ROUNDING) & (vb > F.col("qb") * ROUNDING)
    r = F.when(F.col("i") == F.col("j"), 1.0).otherwise(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("xy") - F.col("sa") * F.col("sb") / n) / (F.sqrt(va) * F.sqrt(vb)))))
    upper = sums.select("i", "j", F.when(spread, r).alias("corr"))
    both = upper.select(F.explode(F.expr(
        "CASE WHEN i = j THEN array(struct(i, j)) ELSE array(struct(i, j), struct(j AS i, i AS j)) END")).alias("p"), "corr").select(
        F.col("p.i").alias("i"), F.col("p.j").alias("j"), "corr")
    # every pair is listed, also those of a table without rows: one row for each of the columns, squared
    k = len(cols)
    pairs = spark.range(k * k).select((F.col("id") / k).cast("int").alias("i"), (F.col("id") % k).cast("int").alias("j"))
    names = spark.createDataFrame(list(enumerate(cols)), "_at int, _name string")  # one row a column
    left, right = (F.broadcast(names.toDF(at, name)) for at, name in (("i", "col_a"), ("j", "col_b")))
    return pairs.join(both, ["i", "j"], "left").join(left, "i").join(right, "j").select(
        "col_a", "col_b", F.round("corr", digits).alias("corr"))
