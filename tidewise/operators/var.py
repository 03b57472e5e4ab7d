"""Vector autoregression.

OLS equation by equation with a shared design ``X = [1, y(t-1), ...,
y(t-p)]``.  Blocks of rows are reduced to triangular factors
(``leastsq``), which merge in a tree; only factors reach the driver, or the
task that solves one of many sets of series.  The order search takes all
orders and folds from the same factors and scores chunks of the test rows on
their own.  ``gram`` gives the matrices of the normal equations as a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage
from .leastsq import factor, leading, merge_tree, merged, solved
from .ordered import DEFAULT_BLOCK_ROWS, halo_blocks, lag_exprs, last_n, windowed, with_ordinal


MAX_SERIES = 500


def bucket_means(df: DataFrame, ts: str, key: str, value: str, every: str, max_series: int = MAX_SERIES) -> tuple[DataFrame, list[str]]:
    """Mean of ``value`` per (time bucket, key), pivoted to one column per
    key.  The keys are the K series of one VAR, whose design has 1 + p*K
    columns; more than ``max_series`` of them is an error."""
    found = df.select(key).where(F.col(qident(key)).isNotNull()).distinct().limit(max_series + 1).collect()
    if len(found) > max_series:
        raise ValueError(f"more than {max_series} series in {key!r}; a VAR of that width cannot be solved in one place")
    keys = sorted(r[0] for r in found)
    b = df.groupBy(F.window(F.col(qident(ts)), every).start.alias("bucket"), F.col(qident(key)).alias("_k")).agg(
        F.avg(F.col(qident(value))).alias("_m"))
    wide = b.groupBy("bucket").pivot("_k", keys).agg(F.first("_m"))
    return wide, [str(k) for k in keys]


def regressor_names(cols: Sequence[str], p: int) -> list[str]:
    return ["const"] + [f"L{lag}.{c}" for lag in range(1, p + 1) for c in cols]


def lagged_design(df: DataFrame, cols: Sequence[str], p: int, order: Sequence[str],
                  block_rows: int = DEFAULT_BLOCK_ROWS, min_t: int | None = None) -> DataFrame:
    """Rows ``t >= min_t`` (default ``p``) with ``L{l}.{c}`` columns (E1 for
    every column) and the ordinal ``t``."""
    exprs = {}
    for c in cols:
        exprs.update(lag_exprs(c, list(range(1, p + 1)), [f"L{lag}.{c}" for lag in range(1, p + 1)]))
    out = windowed(df, exprs, order, before=p, block_rows=block_rows, keep_ordinal="t")
    return out.where(F.col("t") >= (p if min_t is None else min_t))


def _block_of(t, bounds: Sequence[int]):
    """Index of the fold block a row falls in: rows before ``bounds[0]`` are
    block 0, rows in ``[bounds[i-1], bounds[i])`` block ``i``."""
    b = F.lit(0)
    for e in bounds:
        b = b + (t >= e).cast("int")
    return b


def gram(design: DataFrame, cols: Sequence[str], p: int, fold_ends: Sequence[int] | None = None) -> DataFrame:
    """``X'X`` and ``X'Y`` as a long table ``(fold, mat, row, col, value)``.

    Each task multiplies its own rows with NumPy (``mapInPandas``) and emits
    one partial matrix per fold block; Spark sums the partials element-wise
    (group-by on the cell index).  With ``fold_ends`` the training prefix
    ``t < end`` of every fold is the sum of the blocks before it (fold -1 =
    all rows).  Only complete rows enter the design.
    """
    xs = regressor_names(cols, p)
    ys = list(cols)
    ends = sorted(fold_ends or [])
    m, k = len(xs), len(ys)
    xcols = xs[1:]
    d = design.select(_block_of(F.col("t"), ends).alias("_b"), *[F.col(qident(c)).cast("double").alias(f"x{i}") for i, c in enumerate(xcols)],
                      *[F.col(qident(c)).cast("double").alias(f"y{i}") for i, c in enumerate(ys)])
    xn = [f"x{i}" for i in range(len(xcols))]
    yn = [f"y{i}" for i in range(k)]

    def partial(it):
        acc: dict[int, np.ndarray] = {}
        for pdf in it:
            # complete rows only; filtered here, not as a wide Filter node
            # (a NOT NULL test on every lag column inflates plan constraints)
            for b, g in pdf.dropna().groupby("_b"):
                X = np.column_stack([np.ones(len(g)), g[xn].to_numpy(dtype=float)])
                Y = g[yn].to_numpy(dtype=float)
                cell = np.concatenate([(X.T @ X).ravel(), (X.T @ Y).ravel()])
                acc[int(b)] = acc.get(int(b), 0) + cell
        if acc:
            yield pd.DataFrame({"_b": list(acc), "v": [a.tolist() for a in acc.values()]})

    parts = d.mapInPandas(partial, "_b int, v array<double>")
    cells = parts.select("_b", F.posexplode("v").alias("i", "v")).groupBy("_b", "i").agg(F.sum("v").alias("v"))
    nb = len(ends) + 1
    # (blocks x cells) numbers: prefix sums per fold on top of the block sums
    folds = [(-1, list(range(nb)))] + [(fi, list(range(fi + 1))) for fi in range(len(ends))]
    spark = design.sparkSession
    fmap = spark.createDataFrame([(f, b) for f, bl in folds for b in bl], "fold int, _b int")
    summed = cells.join(F.broadcast(fmap), "_b").groupBy("fold", "i").agg(F.sum("v").alias("value"))
    names = [("XtX", xs[a], xs[b]) for a in range(m) for b in range(m)] + [("XtY", xs[a], ys[b]) for a in range(m) for b in range(k)]
    lab = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "i int, mat string, row string, col string")
    return summed.join(F.broadcast(lab), "i").select("fold", "mat", "row", "col", "value")


def _lag_factors(cols: int, top: int, ends: Sequence[int]):
    """Aggregate over one block of rows (ordinal, core flag, values; halo rows
    included): ``[fold block, q, factor...]`` for every fold block and every
    class q.  A row's class is the largest order whose lags it has in full, so
    order p uses the classes q >= p, of which the leading columns are its own:
    one decomposition serves all orders."""
    ends = sorted(ends)

    @F.pandas_udf("array<array<double>>")
    def reduce(t: pd.Series, core: pd.Series, values: pd.Series) -> list:
        at = np.argsort(t.to_numpy())
        y = np.stack(values.to_numpy())[at].astype(float)
        z = np.full((len(y), cols * (top + 1)), np.nan)
        z[:, :cols] = y
        for lag in range(1, top + 1):
            z[lag:, cols * lag : cols * (lag + 1)] = y[:-lag]
        full = np.isfinite(z).reshape(len(z), top + 1, cols).all(axis=2)
        kind = np.cumprod(full, axis=1).sum(axis=1) - 1
        kind[~core.to_numpy()[at].astype(bool)] = -1
        block = np.searchsorted(ends, t.to_numpy()[at], side="right")
        out = []
        for b, q in sorted({(b, q) for b, q in zip(block.tolist(), kind.tolist()) if q >= 1}):
            rows = z[(block == b) & (kind == q), : cols * (q + 1)]
            out.append([float(b), float(q), *factor(rows).tolist()])
        return out

    return reduce


def factors(numbered: DataFrame, cols: Sequence[str], top: int, ordinal: str, by: Sequence[str] = (), fold_ends: Sequence[int] = (),
            block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``(by..., block, q, f)``: triangular factors of the lagged rows of
    every series set (``by``), fold block and class of rows, from one pass.

    ``numbered`` has an ordinal without gaps inside a set.  A block of rows
    with its halo is one task's group, whatever the length of a series; what
    leaves it is a few small factors, merged in a tree.
    """
    keys = [F.col(qident(b)).alias(f"_g{i}") for i, b in enumerate(by)]
    names = [f"_g{i}" for i in range(len(by))]
    slim = numbered.select(*keys, F.col(qident(ordinal)).alias("_t"), F.array(*[F.col(qident(c)).cast("double") for c in cols]).alias("_y"))
    blocks = halo_blocks(slim, "_t", top, 0, block_rows)
    found = blocks.groupBy(*names, "_blk").agg(_lag_factors(len(cols), top, fold_ends)("_t", "_core", "_y").alias("_f"))
    one = found.select(*names, "_blk", F.explode("_f").alias("_f")).select(
        *names, "_blk", F.col("_f")[0].cast("int").alias("block"), F.col("_f")[1].cast("int").alias("q"), F.expr("slice(_f, 3, size(_f) - 2)").alias("f"))
    out = merge_tree(one, [*names, "block", "q"], "_blk", "f")
    return out.select(*[F.col(n).alias(b) for n, b in zip(names, by)], "block", "q", "f")


def solve_order(found: Sequence[tuple[int, int, Sequence[float]]], k: int, p: int, blocks: int | None = None) -> tuple[np.ndarray, int, int]:
    """Coefficients ``B`` ((1+pK) x K), rows and rank of order ``p`` from
    factors ``(block, q, f)``, of the first ``blocks`` fold blocks (default all)."""
    mine = [leading(f, k * (p + 1)) for b, q, f in found if q >= p and (blocks is None or b < blocks)]
    if not mine:
        return np.full((1 + p * k, k), np.nan), 0, 0
    f = merged(mine)
    B, rank = solved(f, range(k, k * (p + 1)), range(k))
    return B, int(f[0]), rank


def fit(df: DataFrame, cols: Sequence[str], p: int, order: Sequence[str], block_rows: int = DEFAULT_BLOCK_ROWS) -> np.ndarray:
    """VAR(p) coefficients."""
    numbered = with_ordinal(df.select(*[qident(c) for c in dict.fromkeys([*order, *cols])]), order, name="_t")
    found = factors(numbered, cols, p, "_t", block_rows=block_rows).select("block", "q", "f").collect()
    return solve_order([tuple(r) for r in found], len(cols), p)[0]


def _fitted_by(df: DataFrame, cols: Sequence[str], p: int, order: Sequence[str], by: Sequence[str], block_rows: int) -> DataFrame:
    """``(by..., _n, _rank, _B)``: solved in tasks, one row for each set of series with a complete row."""
    k = len(cols)

    @F.pandas_udf("array<double>")
    def solve(block: pd.Series, q: pd.Series, f: pd.Series) -> list:
        B, n, rank = solve_order(list(zip(block, q, f)), k, p)
        return [float(n), float(rank), *B.ravel().tolist()]

    slim = df.select(*[qident(c) for c in dict.fromkeys([*by, *order, *cols])])
    numbered = with_ordinal(slim, order, by, name="_t", per_series=False)
    found = factors(numbered, cols, p, "_t", by, block_rows=block_rows).where(F.col("q") >= p)
    made = found.groupBy(*[F.col(qident(b)) for b in by]).agg(solve("block", "q", "f").alias("_s"))
    return made.select(*[F.col(qident(b)) for b in by], F.col("_s")[0].cast("long").alias("_n"), F.col("_s")[1].cast("int").alias("_rank"),
                       F.expr("slice(_s, 3, size(_s) - 2)").alias("_B"))


def fit_by(df: DataFrame, cols: Sequence[str], p: int, order: Sequence[str], by: Sequence[str], block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """J12 for many sets of series: one VAR(p) of the columns ``cols`` for each value of ``by``.

    ``(by..., regressor, equation, coef, n_rows, rank)``.  A NULL in ``by`` is
    a set of its own; a row with a NULL or non-finite value in it or its lags
    is left out; a set without any complete row has no result; a regressor
    without variation has 0.  No set meets one task whole.
    """
    xs, k = regressor_names(cols, p), len(cols)
    made = _fitted_by(df, cols, p, order, by, block_rows)
    cell = made.select(*[F.col(qident(b)) for b in by], "_n", "_rank", F.posexplode("_B").alias("_i", "coef"))
    name = F.array(*[F.lit(x) for x in xs])[F.expr(f"_i div {k}").cast("int")]
    equation = F.array(*[F.lit(c) for c in cols])[F.expr(f"_i % {k}").cast("int")]
    return cell.select(*[F.col(qident(b)) for b in by], name.alias("regressor"), equation.alias("equation"), "coef",
                       F.col("_n").alias("n_rows"), F.col("_rank").alias("rank"))


def forecast_by(df: DataFrame, cols: Sequence[str], p: int, order: Sequence[str], by: Sequence[str], steps: int,
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """J14 for many sets of series: ``(by..., step, <cols>)``, ``steps`` rows
    after the last row of every set that ``fit_by`` fits; NULL where one of
    the last ``p`` rows is incomplete."""
    k, keys = len(cols), [F.col(qident(b)) for b in by]
    made = _fitted_by(df, cols, p, order, by, block_rows).select(*[F.col(qident(b)).alias(f"_g{i}") for i, b in enumerate(by)], "_B")
    at = [f(qident(o)) for o in order for f in (F.isnull, F.col)]  # NULL times last, as in the ordinal
    item = F.struct(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(at)]).alias("k"), F.array(*[F.col(qident(c)).cast("double") for c in cols]).alias("y"))
    past = last_n(df, p, order, by).groupBy(*keys).agg(F.flatten(F.array_sort(F.collect_list(item))["y"]).alias("_past"))
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(qident(b)).eqNullSafe(F.col(f"_g{i}"))

    @F.pandas_udf("array<array<double>>")
    def run(coef: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([recurse(np.reshape(b, (1 + p * k, k)), np.reshape(np.asarray(y, float), (-1, k)), steps).tolist() for b, y in zip(coef, last)])

    rows = past.join(made, same).select(*keys, F.posexplode(run("_B", "_past")).alias("_s", "_v"))
    return rows.select(*keys, (F.col("_s") + 1).alias("step"), *[F.nanvl(F.col("_v")[j], F.lit(None)).alias(c) for j, c in enumerate(cols)])


def coefficients_frame(spark, B: np.ndarray, cols: Sequence[str], p: int) -> DataFrame:
    xs = regressor_names(cols, p)
    rows = [(xs[i], cols[j], float(B[i, j])) for i in range(len(xs)) for j in range(len(cols))]
    return spark.createDataFrame(rows, "regressor string, equation string, coef double")


def recurse(B: np.ndarray, last_rows: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` forecasts from the last ``p`` rows (oldest first)."""
    k = B.shape[1]
    p = (B.shape[0] - 1) // k
    hist = [np.asarray(r, dtype=float) for r in last_rows[-p:]] if p else []
    out = np.zeros((steps, k))
    for s in range(steps):
        x = [1.0]
        for lag in range(1, p + 1):
            x.extend(hist[-lag])
        y = np.asarray(x) @ B
        out[s] = y
        hist.append(y)
    return out


def forecast(df: DataFrame, B: np.ndarray, cols: Sequence[str], order: Sequence[str], steps: int) -> np.ndarray:
    """Forecast from the last p rows of ``df`` (p x K numbers collected)."""
    k = len(cols)
    p = (B.shape[0] - 1) // k
    desc = [F.col(qident(o)).desc() for o in order]
    last = df.orderBy(*desc).limit(max(p, 1)).collect()[::-1]
    rows = np.array([[r[c] for c in cols] for r in last], dtype=float)
    return recurse(B, rows, steps)


@dataclass
class OrderSearch:
    """``scores`` is ``[(p, mean_mse or None)]``; the best order (None if
    none has a score; the smaller of ties) and its coefficients on all rows."""

    scores: list[tuple[int, float | None]]
    best: int | None
    coef: np.ndarray | None


def _companion(B: np.ndarray) -> np.ndarray:
    """Matrix that takes the state ``[1, y(t-1), ..., y(t-p)]`` one row on."""
    m, k = B.shape
    M = np.zeros((m, m))
    M[0, 0] = 1.0
    M[1 : 1 + k] = B.T
    for i in range(1 + k, m):
        M[i, i - k] = 1.0
    return M


def _jump(B: np.ndarray, state: np.ndarray, rows: int) -> np.ndarray:
    """The state ``rows`` rows on, by squaring the companion matrix."""
    M = _companion(B)
    while rows:
        if rows & 1:
            state = M @ state
        rows >>= 1
        if rows:
            M = M @ M
    return state


def _chunk_errors(specs: list[tuple[int, int, int, np.ndarray, np.ndarray]], chunk_rows: int, k: int):
    """Aggregate over one chunk of a test block: for every order that is
    fitted on this fold, ``[p, squared error, rows]``.  ``specs``: p, fold,
    first test row, B, state there."""
    @F.pandas_udf("array<array<double>>")
    def score(fold: pd.Series, chunk: pd.Series, t: pd.Series, values: pd.Series) -> list:
        actual = np.stack(values.to_numpy()).astype(float)
        out = []
        for p, i, start, B, state in specs:
            if i != int(fold.iloc[0]):
                continue
            first = int(chunk.iloc[0]) * chunk_rows
            with np.errstate(all="ignore"):
                last = _jump(B, state, first)[1:].reshape(p, k)[::-1]
                ahead = recurse(B, last, int(t.max()) - start - first + 1)
                e = ((actual - ahead[t.to_numpy() - start - first]) ** 2).sum(axis=1)
            known = ~np.isnan(actual).any(axis=1)
            out.append([float(p), float(e[known].sum()), float(known.sum())])
        return out

    return score


def search_orders(df: DataFrame, cols: Sequence[str], order: Sequence[str], max_lag: int = 10, k: int = 5,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> OrderSearch:
    """Orders 1..max_lag-1 scored by expanding-window CV: each fold's
    model forecasts its whole test block from the last p training rows;
    score = mean over folds of the mean squared error (all series).

    An order that cannot be fitted on all ``k`` folds (too few training rows
    in the first), or whose forecast is not finite (an unstable fit, a missing
    value among the last p training rows), has no score, so that all scores
    are means over the same folds.  One pass gives the factors of every order
    and fold; a second scores the test rows in chunks of ``block_rows``: the
    state at a chunk's start is a power of the companion matrix times the
    state at the block's start, so no task follows a whole block.
    """
    K, top = len(cols), max_lag - 1
    base = cut_lineage(with_ordinal(df.select(*[qident(c) for c in dict.fromkeys([*order, *cols])]), order, name="_t"))
    n = base.count()
    size = n // (k + 1)
    bounds = [(n - (k - i) * size, n - (k - i - 1) * size) for i in range(k)]
    values = F.array(*[F.col(qident(c)).cast("double") for c in cols])
    found = [tuple(r) for r in factors(base, cols, top, "_t", (), [s for s, _ in bounds], block_rows).select("block", "q", "f").collect()]
    near = [F.col("_t").between(s - top, s - 1) for s, _ in bounds]
    # at most (orders x folds) rows
    past = {r[0]: np.array(r[1], float) for r in base.where(reduce(or_, near, F.lit(False))).select("_t", values).collect()}
    specs = []
    for p in range(1, max_lag):
        for i, (s, _) in enumerate(bounds):
            if s <= p + K * p:
                continue  # too few training rows for this order
            B, rows, _ = solve_order(found, K, p, i + 1)
            if rows:
                specs.append((p, i, s, B, np.concatenate([[1.0], *[past[s - lag] for lag in range(1, p + 1)]])))
    fold = F.coalesce(*[F.when((F.col("_t") >= s) & (F.col("_t") < e), F.lit(i)) for i, (s, e) in enumerate(bounds)])
    test = base.select(fold.alias("_fold"), F.col("_t"), values.alias("_y")).where(F.col("_fold").isNotNull())
    start = F.array(*[F.lit(s).cast("long") for s, _ in bounds])[F.col("_fold")]
    test = test.withColumn("_start", start).withColumn("_chunk", F.expr(f"(_t - _start) div {int(block_rows)}"))
    parts = test.groupBy("_fold", "_chunk").agg(_chunk_errors(specs, int(block_rows), K)("_fold", "_chunk", "_t", "_y").alias("_e"))
    cell = parts.select("_fold", F.explode("_e").alias("_e")).groupBy("_fold", F.col("_e")[0].cast("int").alias("p")).agg(
        F.sum(F.col("_e")[1]).alias("se"), F.sum(F.col("_e")[2]).alias("m"))
    mse: dict[int, dict[int, float]] = {}
    for r in cell.collect():
        if r["m"]:
            # an error that is not a number arrives as NULL
            mse.setdefault(r["p"], {})[r["_fold"]] = float("nan") if r["se"] is None else r["se"] / r["m"] / K
    scores = []
    for p in range(1, max_lag):
        own = [v for _, v in sorted(mse.get(p, {}).items())]
        mean = sum(own) / k if len(own) == k else None
        scores.append((p, mean if mean is not None and np.isfinite(mean) else None))
    best = min(((m, p) for p, m in scores if m is not None), default=(None, None))[1]
    return OrderSearch(scores, best, solve_order(found, K, best)[0] if best else None)


def select_order(df: DataFrame, cols: Sequence[str], order: Sequence[str], max_lag: int = 10, k: int = 5,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``(p, mean_mse, rmse)`` of every order; see ``search_orders``."""
    got = search_orders(df, cols, order, max_lag, k, block_rows)
    rows = [(p, m, None if m is None else m**0.5) for p, m in got.scores]
    return df.sparkSession.createDataFrame(rows, "p int, mean_mse double, rmse double")
