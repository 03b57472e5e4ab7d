"""Ordered operators (2.E, 2.F) without single-task windows.

``Window.orderBy`` with no ``partitionBy`` moves every row to one task, and
``partitionBy(series)`` puts a hot series (a third of the table) in one
task.  Both are avoided:

* **Ordinal** (E5): a range-partitioned sort on ``(by..., order...)`` (range
  bounds are sampled, so a hot series is spread over many partitions), a
  per-partition position from ``monotonically_increasing_id``, and the
  running sum of per-partition counts (one row per partition, broadcast).
  The sorted, tagged rows are checkpointed once so the ordinal is stable
  under executor loss.
* **Row windows** (E1-E4): rows are cut into blocks of ``block_rows``
  consecutive ordinals; the last ``before`` rows of each block are copied
  into the next block (and the first ``after`` rows into the previous), and
  windows run over ``partitionBy(by..., block)``.  Only core rows are kept,
  so results equal the global window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage, shuffle_partitions_for

ORD = "_ord"
DEFAULT_BLOCK_ROWS = 8192  # halo of 168 rows costs ~2 % extra rows
LONG_ROWS = 512  # longer moving means take two look-ups a row, not a frame
TOP_ROWS = 100_000  # pages that end by this row are a top-k; later ones go by position (same rows)


def _keys(by: Sequence[str], order: Sequence[str]) -> list[Column]:
    return [F.col(qident(b)).asc() for b in by] + [F.col(qident(o)).asc_nulls_last() for o in order]


def with_ordinal(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "ordinal",
    per_series: bool = True,
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """E5: 0-based row position after sorting by ``order`` (NULLs last).

    With ``by`` the position restarts for each series when ``per_series``;
    otherwise it is the position in the global ``(by, order)`` sort.
    ``total`` names an optional column holding the row count (of the series,
    or of the table; known from the per-partition counts).  ``order`` should
    end with a unique tiebreak (an id): tied rows have no defined order.
    ``partitions``: of the sort; by default from the size of ``df``, which the
    optimizer no longer knows after an earlier ordinal.
    """
    by, order = list(by), list(order)
    # partition count sized from the input estimate, not a fixed setting
    srt = df.repartitionByRange(partitions or shuffle_partitions_for(df), *_keys(by, order)).sortWithinPartitions(*_keys(by, order))
    tagged = srt.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_loc", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    )
    tagged = cut_lineage(tagged)
    # one number per partition (metadata): collected once, offsets broadcast
    counts = sorted((r[0], r[1]) for r in tagged.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    offs_rows, run = [], 0
    for pid, n in counts:
        offs_rows.append((pid, run))
        run += n
    offs = df.sparkSession.createDataFrame(offs_rows or [(0, 0)], "_pid int, _off long")
    out = tagged.join(F.broadcast(offs), "_pid").withColumn(name, F.col("_off") + F.col("_loc")).drop("_loc", "_off")
    if not (by and per_series):
        out = out.drop("_pid")
        return out.withColumn(total, F.lit(run).cast("bigint")) if total else out
    # one row per series and partition: a series that fills many partitions is
    # joined in each of them on its own; a NULL series is a series
    own = out.groupBy("_pid", *[F.col(qident(b)) for b in by]).agg(F.min(name).alias("_m"), F.count(F.lit(1)).alias("_c"))
    series = Window.partitionBy(*[F.col(qident(b)) for b in by])
    starts = own.select(
        F.col("_pid").alias("_spid"), *[F.col(qident(b)).alias(f"_by{k}") for k, b in enumerate(by)],
        F.min("_m").over(series).alias("_first"), F.sum("_c").over(series).alias("_size"),
    )
    same = F.col("_pid") == F.col("_spid")
    for k, b in enumerate(by):
        same = same & F.col(qident(b)).eqNullSafe(F.col(f"_by{k}"))
    out = out.join(starts, same).withColumn(name, F.col(name) - F.col("_first"))
    if total:
        out = out.withColumn(total, F.col("_size"))
    return out.drop("_pid", "_spid", "_first", "_size", *[f"_by{k}" for k in range(len(by))])


def halo_blocks(df: DataFrame, ord_col: str, before: int, after: int = 0, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Adds ``_blk`` and ``_core``; neighbour rows are duplicated as halo.

    One pass: every row yields itself and, when it lies within ``before``
    rows of its block's end (or ``after`` rows of its start), a halo copy
    for the next (previous) block.
    """
    block = max(int(block_rows), int(before), int(after), 1)
    o = F.col(qident(ord_col))
    blk = F.expr(f"{qident(ord_col)} div {block}")  # integral division (ordinals are >= 0)
    pos = o - blk * block
    tags = [F.struct(blk.alias("b"), F.lit(True).alias("c"))]
    if before > 0:
        tags.append(F.when(pos >= block - before, F.struct((blk + 1).alias("b"), F.lit(False).alias("c"))))
    if after > 0:
        tags.append(F.when(pos < after, F.struct((blk - 1).alias("b"), F.lit(False).alias("c"))))
    if len(tags) == 1:
        return df.withColumn("_blk", blk).withColumn("_core", F.lit(True))
    ex = df.withColumn("_tag", F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())))
    return ex.withColumn("_blk", F.col("_tag.b")).withColumn("_core", F.col("_tag.c")).drop("_tag")


def windowed(
    df: DataFrame,
    exprs: dict,
    order: Sequence[str],
    by: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    keep_ordinal: str | None = None,
    partitions: int | None = None,
    keep_block: str | None = None,
) -> DataFrame:
    """Evaluate row-window expressions exactly, block by block.

    ``exprs`` maps output names to functions ``Window -> Column``; the
    window given is ``partitionBy(by..., block).orderBy(ordinal)``.
    ``keep_ordinal`` and ``keep_block`` name columns for the ordinal and the
    block of a row (``renumbered`` needs both).
    """
    by = list(by)
    nparts = partitions or shuffle_partitions_for(df)
    base = with_ordinal(df, order, by, name=ORD, per_series=False, partitions=nparts)
    out = over_blocks(base, exprs, by, before, after, block_rows, nparts)
    out = out.withColumnRenamed("_blk", keep_block) if keep_block else out.drop("_blk")
    if keep_ordinal:
        return out.withColumnRenamed(ORD, keep_ordinal)
    return out.drop(ORD)


def over_blocks(base: DataFrame, exprs: dict, by: Sequence[str], before: int, after: int, block_rows: int, partitions: int) -> DataFrame:
    """``windowed`` on rows that have their ordinal ``ORD``; keeps it, and the block ``_blk``."""
    keys = [*[F.col(qident(b)) for b in by], F.col("_blk")]
    # the window's shuffle, sized from the input's estimate like the range sort
    hb = halo_blocks(base, ORD, before, after, block_rows).repartition(partitions, *keys)
    w = Window.partitionBy(*keys).orderBy(ORD)
    return hb.withColumns({k: f(w) for k, f in exprs.items()}).where("_core").drop("_core")


SPAN = 1024  # blocks whose counts one task sums


def renumbered(df: DataFrame, at: str, block: str, name: str = "ordinal", total: str | None = None) -> DataFrame:
    """E5 for rows that are left of an ordered table: positions without gaps,
    from the ordinal ``at`` and the block of consecutive ordinals ``block``
    that ``windowed`` gave them; no second sort of the table.

    A row's position is its place in its block plus the rows left in the
    blocks before: sums inside spans of ``SPAN`` blocks, and one number a span
    (about 8 million table rows) that the driver adds up.  The rows are
    checkpointed once.  ``total`` names a column for the number of rows.
    """
    place = F.row_number().over(Window.partitionBy(F.col(qident(block))).orderBy(F.col(qident(at)))).cast("bigint") - 1
    rows = cut_lineage(df.withColumn("_place", place))
    counts = rows.groupBy(F.col(qident(block)).alias("_rb")).agg(F.count(F.lit(1)).alias("_rc")).withColumn("_span", F.expr(f"_rb div {SPAN}"))
    spans, run = [], 0
    for s, c in sorted((r[0], r[1]) for r in counts.groupBy("_span").agg(F.sum("_rc")).collect()):
        spans.append((s, run))
        run += c
    before = df.sparkSession.createDataFrame(spans, "_span long, _before long")
    own = Window.partitionBy("_span").orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("_start", F.coalesce(F.sum("_rc").over(own), F.lit(0))).join(F.broadcast(before), "_span").select(
        "_rb", (F.col("_start") + F.col("_before")).alias("_start"))
    out = rows.join(start, F.col(qident(block)) == F.col("_rb")).withColumn(name, F.col("_start") + F.col("_place"))
    if total:
        out = out.withColumn(total, F.lit(run).cast("bigint"))
    return out.drop("_place", "_rb", "_start")


def lag_exprs(target: str, lags: Sequence[int], names: Sequence[str] | None = None) -> dict:
    names = list(names) if names else [f"{target}_lag{L}" for L in lags]
    return {n: (lambda w, L=L: F.lag(F.col(qident(target)), L).over(w)) for n, L in zip(names, lags)}


def add_lags(df: DataFrame, target: str, lags: Sequence[int], order: Sequence[str], by: Sequence[str] = (),
             names: Sequence[str] | None = None, block_rows: int = DEFAULT_BLOCK_ROWS, partitions: int | None = None) -> DataFrame:
    """``target.shift(L)`` by rows within each series."""
    return windowed(df, lag_exprs(target, lags, names), order, by, before=max(lags), block_rows=block_rows, partitions=partitions)


def trailing_mean_expr(target: str, n: int):
    """Mean of rows t-n..t-1; NULL unless all n exist and are non-null."""
    def f(w):
        fr = w.rowsBetween(-n, -1)
        c = F.col(qident(target))
        return F.when(F.count(c).over(fr) == n, F.avg(c).over(fr))
    return f


def rolling_mean(df: DataFrame, target: str, windows: dict[str, int], order: Sequence[str], by: Sequence[str] = (),
                 block_rows: int = DEFAULT_BLOCK_ROWS, long_rows: int = LONG_ROWS) -> DataFrame:
    """Trailing means.  Windows of more than ``long_rows`` rows take two
    look-ups a row (``moving``) in place of a frame that is read again for each row."""
    by = list(by)
    short = {k: n for k, n in windows.items() if n <= long_rows}
    if len(short) == len(windows):
        return windowed(df, {k: trailing_mean_expr(target, n) for k, n in windows.items()}, order, by,
                        before=max(windows.values()), block_rows=block_rows)
    from .moving import long_window, trailing_mean

    nparts = shuffle_partitions_for(df)
    out = base = with_ordinal(df, order, by, name=ORD, per_series=False, partitions=nparts)
    if short:
        out = over_blocks(base, {k: trailing_mean_expr(target, n) for k, n in short.items()}, by, max(short.values()), 0, block_rows, nparts).drop("_blk")
    for k, n in windows.items():
        if k not in short:
            out = long_window(out, base, target, -n, -1, by, block_rows, nparts, trailing_mean(n), k)
    return out.select(*[qident(c) for c in df.columns], *[qident(k) for k in windows])


def centered_mean_expr(target: str, period: int):
    """Centred moving average; even periods give the end points half
    weight (2 x MA); NULL where the full window does not exist."""
    c = F.col(qident(target))
    if period % 2 == 1:
        h = period // 2

        def f(w):
            fr = w.rowsBetween(-h, h)
            return F.when(F.count(c).over(fr) == period, F.avg(c).over(fr))
        return f
    h = period // 2

    def g(w):
        fr = w.rowsBetween(-h, h)
        full = F.count(c).over(fr) == period + 1
        s = F.sum(c).over(fr) - 0.5 * F.lag(c, h).over(w) - 0.5 * F.lead(c, h).over(w)
        return F.when(full, s / period)
    return g


def centered_mean(df: DataFrame, target: str, period: int, order: Sequence[str], by: Sequence[str] = (),
                  name: str = "trend", block_rows: int = DEFAULT_BLOCK_ROWS, long_rows: int = LONG_ROWS) -> DataFrame:
    """E4; periods of more than ``long_rows`` rows as in ``rolling_mean``."""
    h = period // 2
    if period <= long_rows:
        return windowed(df, {name: centered_mean_expr(target, period)}, order, by, before=h, after=h, block_rows=block_rows)
    from .moving import centred_mean, long_window

    nparts = shuffle_partitions_for(df)
    base = with_ordinal(df, order, list(by), name=ORD, per_series=False, partitions=nparts)
    return long_window(base, base, target, -h, h, list(by), block_rows, nparts, centred_mean(period), name).drop(ORD)


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``; an aggregate (map-side combined),
    so a hot key is reduced in every task before the shuffle."""
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*[F.col(qident(k)) for k in key]).agg(
        F.min_by(F.struct(*[F.col(qident(c)) for c in rest]), F.struct(*[F.col(qident(o)) for o in order])).alias("_r")
    )
    return picked.select(*[F.col(qident(k)) for k in key], *[F.col("_r." + qident(c)).alias(c) for c in rest]).select(
        *[qident(c) for c in df.columns]
    )


def time_split(df: DataFrame, test_size: float, order: Sequence[str], by: Sequence[str] = (),
               ordinal: str = "ordinal", flag: str = "split", partitions: int | None = None) -> DataFrame:
    """Chronological split: the last ``ceil(n*test_size)`` rows are test."""
    return split_by_position(with_ordinal(df, order, list(by), name=ordinal, total="_n", partitions=partitions), test_size, ordinal, flag)


def split_by_position(od: DataFrame, test_size: float, ordinal: str = "ordinal", flag: str = "split") -> DataFrame:
    """E7 on rows that have their position and, in ``_n`` (dropped), their number."""
    n_test = F.ceil(F.col("_n") * F.lit(float(test_size)))
    return od.withColumn(flag, F.when(F.col(ordinal) >= F.col("_n") - n_test, "test").otherwise("train")).drop("_n")


def fold_bounds(n: Column, k: int) -> Column:
    """E8 helper: array of (fold, train_end, test_end) structs; ``n`` rows."""
    t = F.floor(n / (k + 1))
    return F.array(*[
        F.struct(F.lit(i).alias("fold"), (n - (k - i) * t).alias("test_start"), (n - (k - i - 1) * t).alias("test_end"))
        for i in range(k)
    ])


def time_series_folds(df: DataFrame, k: int, order: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """Expanding-window folds; each row appears once per fold it is in,
    tagged ``train`` (before the test block) or ``test``."""
    od = with_ordinal(df, order, name=ordinal, total="_n")
    # only the folds a row is in, in the scan
    inside = F.filter(fold_bounds(F.col("_n"), k), lambda f: F.col(qident(ordinal)) < f["test_end"])
    j = od.withColumn("_f", F.explode(inside)).withColumn("fold", F.col("_f.fold"))
    role = F.when(F.col(qident(ordinal)) < F.col("_f.test_start"), "train").otherwise("test")
    return j.withColumn("role", role).drop("_f", "_n")


def last_n(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows (per series with ``by``).

    Without ``by`` this is a top-k (partial top-k per task); with ``by`` the
    ``row_number() <= n`` filter is planned with a partial group limit.
    """
    desc = [F.col(qident(o)).desc_nulls_first() for o in order]
    if not by:
        return df.orderBy(*desc).limit(n)
    w = Window.partitionBy(*[F.col(qident(b)) for b in by]).orderBy(*desc)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """the first ``n`` rows in order."""
    return df.orderBy(*[F.col(qident(o)).asc_nulls_last() for o in order]).limit(n)


def sort_time(df: DataFrame, ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """ascending time, NULL time last, explicit tiebreak."""
    return df.orderBy(F.col(qident(ts)).asc_nulls_last(), *[F.col(qident(t)).asc() for t in tiebreak])


def page(df: DataFrame, order: Sequence[str], page_no: int = 1, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """1-based page of ``size`` rows and the total row count."""
    if page_no < 1 or size < 1:
        raise ValueError("page and size must be >= 1")
    first = (page_no - 1) * size
    if first + size <= TOP_ROWS:
        items = df.orderBy(*[F.col(qident(o)).asc_nulls_last() for o in order]).offset(first).limit(size)
    else:  # a deep page: rows by their position, none but the page's reach one task
        at = with_ordinal(df, order, name="_at")
        items = at.where(F.col("_at").between(first, first + size - 1)).orderBy("_at").drop("_at")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return items, total
