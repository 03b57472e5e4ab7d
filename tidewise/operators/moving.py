"""Sums over long row windows, two look-ups a row.

Rows are cut into blocks of consecutive ordinals.  A window that reaches over
blocks is the end of its first block, whole blocks, and the beginning of its
last block.  Every row therefore gets two running sums inside its block, from
its start and from its end; the whole blocks between are a window over the
small table of block totals.  Nothing is ever subtracted, so a large value
leaves no rounding behind it, and no block is longer than ``block_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage
from .ordered import ORD, halo_blocks

SPAN = 1024  # blocks whose totals one window group holds, more if a window needs it


def running_sums(base: DataFrame, target: str, by: Sequence[str], block: int, partitions: int) -> DataFrame:
    """One narrow row a table row: sums and counts from its block's start to
    it (``_pre``) and from it to its block's end (``_suf``); checkpointed once."""
    rows = base.select(
        ORD, F.expr(f"{ORD} div {block}").alias("_b"), F.col(qident(target)).cast("double").alias("_x"),
        *[F.col(qident(b)).alias(f"_by{i}") for i, b in enumerate(by)]).repartition(partitions, "_b")
    own = Window.partitionBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up, down = own.orderBy(F.asc(ORD)), own.orderBy(F.desc(ORD))
    total = lambda w: F.coalesce(F.sum("_x").over(w), F.lit(0.0))
    return cut_lineage(rows.select(
        "*", total(up).alias("_pre"), F.count("_x").over(up).alias("_pre_n"), total(down).alias("_suf"), F.count("_x").over(down).alias("_suf_n")))


def _blocks_between(sums: DataFrame, q: int) -> DataFrame:
    """For each block the totals of the ``q - 1`` and of the ``q`` blocks before it."""
    totals = sums.groupBy("_b").agg(F.coalesce(F.sum("_x"), F.lit(0.0)).alias("_t"), F.count("_x").alias("_c"))
    near = halo_blocks(totals, "_b", q, block_rows=SPAN)
    w = Window.partitionBy("_blk").orderBy("_b")

    def before(c: str, k: int) -> Column:
        return F.coalesce(F.sum(c).over(w.rowsBetween(-k, -1)), F.lit(0)) if k else F.lit(0)

    return near.select(F.col("_b").alias("_eb"), before("_t", q - 1).alias("_t0"), before("_c", q - 1).alias("_c0"),
                       before("_t", q).alias("_t1"), before("_c", q).alias("_c1"), "_core").where("_core").drop("_core")


def long_window(rows: DataFrame, base: DataFrame, target: str, first: int, last: int, by: Sequence[str], block_rows: int,
                partitions: int, value, name: str) -> DataFrame:
    """``rows`` (``base`` with more columns) with ``name``: ``value(sum, count, head, tail)``
    of the rows ``t + first`` to ``t + last`` of ``target``, NULL where they are not all in the series.

    ``base`` has the ordinal ``ORD`` of the global ``(by, order)`` sort, so
    the rows between two rows of one series are that series.
    """
    d = last - first
    if d < 1:
        raise ValueError("a window of at least two rows is needed")
    block = min(int(block_rows), d)
    sums = running_sums(base, target, by, block, partitions)
    n_by = range(len(by))
    heads = sums.select((F.col(ORD) + d).alias("_e"), F.col("_b").alias("_sb"), "_suf", "_suf_n", F.col("_x").alias("_head"),
                        *[F.col(f"_by{i}").alias(f"_sby{i}") for i in n_by])
    tails = sums.select(F.col(ORD).alias("_e"), F.col("_b").alias("_eb"), "_pre", "_pre_n", F.col("_x").alias("_tail"),
                        *[f"_by{i}" for i in n_by])
    both = tails.join(heads, "_e").join(_blocks_between(sums, d // block), "_eb")
    for i in n_by:
        both = both.where(F.col(f"_by{i}").eqNullSafe(F.col(f"_sby{i}")))
    far = F.col("_eb") - F.col("_sb") > d // block
    whole, held = F.when(far, F.col("_t1")).otherwise(F.col("_t0")), F.when(far, F.col("_c1")).otherwise(F.col("_c0"))
    got = both.select((F.col("_e") - last).alias("_t"), *[F.col(f"_by{i}").alias(f"_wby{i}") for i in n_by],
                      value(F.col("_suf") + whole + F.col("_pre"), F.col("_suf_n") + held + F.col("_pre_n"),
                            F.col("_head"), F.col("_tail")).alias(name))
    same = F.col(ORD) == F.col("_t")
    for i, b in enumerate(by):
        same = same & F.col(qident(b)).eqNullSafe(F.col(f"_wby{i}"))
    return rows.join(got, same, "left").drop("_t", *[f"_wby{i}" for i in n_by])


def trailing_mean(n: int):
    """The mean, unless one of the ``n`` values is missing."""
    return lambda total, count, head, tail: F.when(count == n, total / n)


def centred_mean(period: int):
    """The mean; the end points of an even period's window weigh half."""
    if period % 2:
        return trailing_mean(period)
    return lambda total, count, head, tail: F.when(count == period + 1, (total - 0.5 * head - 0.5 * tail) / period)
