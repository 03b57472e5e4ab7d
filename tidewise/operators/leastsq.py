"""Least squares by triangular factors.

Rows ``[1, z]`` are reduced, piece by piece, to the triangular factor of
their QR decomposition.  Factors of pieces merge into the factor of all rows
(stack, decompose again), so a sum over any number of rows is a tree of small
merges, and the condition number is never squared as in normal equations.
Each piece is centred on its medians; merging moves both sides to a common
centre, which only adds multiples of the constant column.  Large offsets
therefore cost no digits, and a column without variation is exactly zero.

A factor travels as a flat array: number of rows, centre (one number a
column), the square factor row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .._col import qident

FAN_IN = 512  # factors that one task merges in the first level
NUMBERS = ArrayType(DoubleType())
KEPT_ROWS = 4096  # rows a task holds before it reduces them


def _pack(n: float, centre: np.ndarray, r: np.ndarray) -> np.ndarray:
    q = len(centre) + 1
    square = np.zeros((q, q))
    square[: len(r)] = r
    return np.concatenate([[n], centre, square.ravel()])


def _unpack(flat: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    flat = np.asarray(flat, float)
    q = int(len(flat) ** 0.5)  # of 1 + (q - 1) + q * q numbers
    return flat[0], flat[1:q], flat[q:].reshape(q, q)


def factor(z: np.ndarray) -> np.ndarray:
    """The factor of complete rows ``z`` (at least one), a constant column put in front."""
    centre = np.median(z, axis=0)
    r = np.linalg.qr(np.column_stack([np.ones(len(z)), z - centre]), mode="r")
    return _pack(len(z), centre, r)


def leading(flat: np.ndarray, columns: int) -> np.ndarray:
    """The factor of the same rows over the first ``columns`` columns of ``z``."""
    n, centre, r = _unpack(flat)
    return _pack(n, centre[:columns], r[: columns + 1, : columns + 1])


def merged(flats: Iterable[np.ndarray]) -> np.ndarray:
    """The factor of all rows of several factors; any order gives the same bits."""
    flats = sorted((np.asarray(f, float) for f in flats), key=lambda a: a.tobytes())
    if len(flats) == 1:
        return flats[0]
    parts = [_unpack(f) for f in flats]
    centre = np.median([c for _, c, _ in parts], axis=0)
    moved = []
    for _, c, r in parts:
        r = r.copy()
        r[:, 1:] += np.outer(r[:, 0], c - centre)
        moved.append(r)
    return _pack(sum(n for n, _, _ in parts), centre, np.linalg.qr(np.vstack(moved), mode="r"))


def solved(flat: np.ndarray, x: Sequence[int], y: Sequence[int]) -> tuple[np.ndarray, int]:
    """Coefficients ((1 + len(x)) x len(y), constant first) of the columns ``y`` on ``x``, and the rank.

    Columns are scaled to length one before the rank is judged.  With too
    little information the solution is the shortest in these units, with the
    constant at the centre: a column without variation gets 0.
    """
    n, centre, r = _unpack(flat)
    x, y = list(x), list(y)
    r = np.linalg.qr(r[:, [0, *(i + 1 for i in x), *(i + 1 for i in y)]], mode="r")
    m = 1 + len(x)
    a, b = r[:m, :m], r[:m, m:]
    size = np.linalg.norm(a, axis=0)
    size[size == 0] = 1.0
    # the constant is taken out first, so that it does not share in a shortest solution
    coef = np.zeros((m, len(y)))
    rank = 1
    if len(x):
        coef[1:], _, inner, _ = np.linalg.lstsq(a[1:, 1:] / size[1:], b[1:], rcond=max(n, m) * np.finfo(float).eps)
        coef[1:] /= size[1:, None]
        rank += int(inner)
    if a[0, 0]:
        coef[0] = (b[0] - a[0, 1:] @ coef[1:]) / a[0, 0]
    coef[0] += centre[y] - centre[x] @ coef[1:]
    return coef, rank


def merge_tree(parts: DataFrame, by: Sequence[str], piece: str, factor_col: str) -> DataFrame:
    """One factor a group: first of ``FAN_IN`` consecutive pieces each, then of those."""
    @F.pandas_udf(NUMBERS)
    def merge_factors(f: pd.Series) -> list:
        return merged(f).tolist()

    keys = [F.col(qident(b)) for b in by]
    near = parts.groupBy(*keys, F.expr(f"{qident(piece)} div {FAN_IN}").alias("_near")).agg(merge_factors(factor_col).alias(factor_col))
    return near.groupBy(*keys).agg(merge_factors(factor_col).alias(factor_col))


def row_factor(df: DataFrame, cols: Sequence[str]) -> np.ndarray | None:
    """The factor of the complete rows of ``cols`` (None without one): one pass, one factor a task."""
    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, held = None, []
        for batch in batches:
            z = batch.to_numpy(float)[:, :-1]
            held.append(z[np.isfinite(z).all(axis=1)])
            if sum(map(len, held)) >= KEPT_ROWS:
                done, held = joined(done, held), []
            piece = int(batch["_piece"].iloc[-1]) if len(batch) else 0
        if held:
            done = joined(done, held)
        if done is not None:
            yield pd.DataFrame({"_piece": [piece], "f": [done.tolist()]})

    def joined(done, held):
        z = np.concatenate(held)
        new = [factor(z[i : i + KEPT_ROWS]) for i in range(0, len(z), KEPT_ROWS)]
        return merged([*([] if done is None else [done]), *new]) if new else done

    rows = df.select(*[F.col(qident(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)], F.spark_partition_id().alias("_piece"))
    found = merge_tree(rows.mapInPandas(reduce, "_piece int, f array<double>"), [], "_piece", "f").collect()
    return np.array(found[0][0]) if found and found[0][0] else None


def linear(df: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, int, int]:
    """J8 with any number of features: coefficients (constant first), rows used, rank."""
    f = row_factor(df, [*features, label])
    if f is None:
        return np.full(1 + len(features), np.nan), 0, 0
    coef, rank = solved(f, range(len(features)), [len(features)])
    return coef[:, 0], int(f[0]), rank
