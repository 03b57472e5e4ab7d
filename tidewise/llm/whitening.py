"""Whitening of embeddings with eigenvectors refined in mixed precision (operator 11).

Every entry c becomes the whole number ``floor(1024 c) + 100000``, so sums and
products are exact.  Two passes over the vectors give the sums and then the
products of the entries less their rounded means; the covariance follows
from these whole numbers without rounding, whatever the partitioning.  Its
eigenvectors start as float32 ones and are corrected by Ogita-Aishima steps:
matrix products in extended precision, quadratic convergence, and within a
cluster of eigenvalues too close for the step a sub-solve of the shifted small
matrix.  Only the d x d covariance (d: entries of a vector) is on the driver.
A third pass projects the vectors.

Defined results: a vector that is null, or holds null, NaN, an infinity or an
entry of 2**30 or more in size, is dropped; of vectors of several lengths the
most frequent length stays (of equally frequent ones the longest), empty
vectors never; a direction without variance (below 1e-15 of the trace) has no
whitened values, so its component is left out; an empty table, and one vector
alone, give an empty result; repeated rows count each; a null id stays a null
id; a ``deviation`` beyond 64 bits is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
#: Entries of this size or more have no exact products in 38 digits.
LARGEST = float(1 << 30)
_EXACT = 1 << 53  # whole numbers below this are exact in float64


def vectors_of(column) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Usable rows of an Arrow list column by length: ``{length: (row numbers, whole-number vectors)}``, and the rows' lengths."""
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    sizes = np.diff(_offsets(column))
    bad = ~(np.abs(values) < LARGEST)
    before = np.concatenate([[0], np.cumsum(bad)])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    good = (sizes > 0) & (before[ends] == before[starts])
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    found = {}
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        held = values[starts[rows][:, None] + np.arange(size)]
        found[int(size)] = rows, np.floor(SCALE * held).astype(np.int64) + SHIFT
    return sizes, found


def _offsets(column) -> np.ndarray:
    """Offsets of the rows in ``column.flatten()``, where null rows are empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)])


def _few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in a few tasks a core, without a shuffle: each sends one partial matrix, so their count doesn't grow with the table."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def entry_sums(df: DataFrame) -> DataFrame:
    """``size, dim, n, total``: by vector length and entry the number of vectors and the exact sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, (rows, x) in vectors_of(batch.column(0))[1].items():
                n, total = held.get(size, (0, np.zeros(size, np.int64)))
                held[size] = [n + len(rows), total + x.sum(axis=0)]
        for size, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(np.arange(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(total)],
                ["size", "dim", "n", "total"],
            )

    parts = _few_tasks(df).mapInArrow(run, "size int, dim int, n long, total long")
    return parts.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def entry_products(df: DataFrame, middle: np.ndarray) -> DataFrame:
    """``cell, total``: sums over the vectors of (x - middle)(x - middle)', exact, by cell of the upper triangle."""
    size = len(middle)
    upper = np.triu_indices(size)

    def exact(y: np.ndarray) -> Iterator[np.ndarray]:
        """Products of rows ``y``: in float64 as far as every sum in it is exact, else in whole numbers of any size."""
        most = int(np.abs(y).max(initial=1))
        if most >= 1 << 26:
            yield sum(np.outer(r, r)[upper] for r in y.astype(object))
            return
        step = (_EXACT - 1) // (most * most)
        for at in range(0, len(y), step):
            part = y[at : at + step].astype(float)
            yield (part.T @ part)[upper].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = np.zeros(len(upper[0]), np.int64), 1 << 62
        for batch in batches:
            rows, x = vectors_of(batch.column(0))[1].get(size, (None, None))
            for part in exact(x - middle) if rows is not None else ():
                room -= int(np.abs(part).max()) + 1
                total = (total if room > 0 else total.astype(object)) + part
        cells = pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), cells], ["cell", "total"])

    parts = _few_tasks(df).mapInArrow(run, "cell int, total decimal(38,0)")
    return parts.groupBy("cell").agg(F.sum("total").alias("total"))


def refined(matrix: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix in extended precision.

    From the float32 eigenvectors X: with R = I - X'X and S = X'AX, the eigenvalues are S_ii / (1 - R_ii), and X goes
    on as X + XE with E_ij = (S_ij + l_j R_ij) / (l_j - l_i), or R_ij / 2 where two eigenvalues are closer than the errors
    of S and R.  Groups of such close ones are separated by a float64 solve of X_k'(A - m I)X_k, which loses no digits
    to their common size m.
    """
    wide = np.longdouble
    a = np.asarray(matrix, wide)
    size = len(a)
    scale = np.abs(a).max(initial=0)
    if size == 0 or scale == 0:
        return np.zeros(size, wide), np.eye(size, dtype=wide)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    eye = np.eye(size, dtype=wide)
    tiny, last, solved = np.finfo(wide).eps, np.inf, False
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[order][:, order], s[order][:, order]
        apart = values[None, :] - values[:, None]
        close = 2 * (np.linalg.norm((s - np.diag(values)).astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
        far = np.abs(apart) > close
        step = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
        x = x + x @ step
        moved = float(np.abs(step).max())
        # eigenvalues in an unbroken chain of close ones are one cluster
        split = np.flatnonzero(np.concatenate([[True], np.abs(np.diff(values)) > close, [True]]))
        for first, end in zip(split[:-1], split[1:]):
            if end - first > 1:
                part = x[:, first:end]
                part = _orthonormal(part)
                small = part.T @ (a @ part) - values[first:end].mean() * (part.T @ part)
                x[:, first:end] = _orthonormal(part @ np.linalg.eigh(small.astype(float))[1][:, ::-1].astype(wide))
        if moved < 8 * size * float(tiny):
            if solved:
                break
            solved = True  # one more round after the sub-solves
        elif solved and moved >= last:
            break
        last = moved
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.einsum("ij,ij->j", x[:, order], x[:, order]))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(size)] < 0, wide(-1), wide(1))
    return values[order] * scale, x


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, corrected by one Newton step."""
    return x @ (1.5 * np.eye(x.shape[1], dtype=x.dtype) - 0.5 * (x.T @ x))


class Model:
    """What the projection needs: count, sums, mean rounded to whole numbers, unit eigenvectors, eigenvalues, trace."""

    def __init__(self, n: int, total: list[int], covariance: np.ndarray, components: int):
        self.n, self.total = n, total
        values, vectors = refined(covariance)
        trace = np.trace(covariance)
        keep = min(components, int((values > np.longdouble(1e-15) * trace).sum()) if trace > 0 else 0)
        self.values, self.vectors, self.trace = values[:keep].astype(float), vectors[:, :keep].astype(float), float(trace)


def fit(df: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Covariance and its leading eigenvectors of the column ``embedding``; None without a usable vector."""
    sums = stored(entry_sums(df), "entry_sums")
    best = sums.orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return None
    size, n = best["size"], best["n"]
    total = [int(r["total"]) for r in sums.filter(F.col("size") == size).orderBy("dim").collect()]
    middle = np.array([(2 * t + n) // (2 * n) for t in total], np.int64)
    rest = [t - n * int(m) for t, m in zip(total, middle)]  # sums of x - middle
    row, col = np.triu_indices(size)
    covariance = np.zeros((size, size), np.longdouble)
    for r in entry_products(df, middle).collect():
        i, j = int(row[r["cell"]]), int(col[r["cell"]])
        exact = n * int(r["total"]) - rest[i] * rest[j]
        covariance[i, j] = covariance[j, i] = _wide(Fraction(exact, n * n))
    return Model(n, total, covariance, components)


def _wide(x: Fraction) -> np.longdouble:
    """The nearest extended-precision number but for the last digits."""
    high = float(x)
    return np.longdouble(high) + np.longdouble(float(x - Fraction(high)))


def project(df: DataFrame, model: Model) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array, one entry a component)."""
    kind = dict(df.dtypes)["vec_id"]
    n, total, size = model.n, np.array(model.total, object), len(model.total)
    narrow = max(map(abs, model.total), default=0) < 1 << 62 and n < 1 << 31
    total64 = total.astype(np.int64) if narrow else None
    turn = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = vectors_of(batch.column(1))[1].get(size, (np.zeros(0, np.int64), np.zeros((0, size), np.int64)))
            apart = n * x - total64 if narrow and np.abs(x).max(initial=0) < 1 << 31 else n * x.astype(object) - total
            most = int(np.abs(apart).max(initial=0))
            if size * most * most < 1 << 63:
                deviation = pa.array((apart.astype(np.int64) ** 2).sum(axis=1), pa.int64())
            else:
                sums = [sum(int(v) ** 2 for v in r) for r in apart]
                deviation = pa.array([v if v < 1 << 63 else None for v in sums], pa.int64())
            white = (apart.astype(float) / n) @ turn
            ends = np.arange(0, white.size + 1, max(1, white.shape[1]), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), deviation, pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))],
                ["vec_id", "deviation", "whitened"],
            )

    return df.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    model = fit(rows.select("embedding"), components)
    kept = 0 if model is None else len(model.values)
    if not kept:
        return rows.limit(0).select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
        )
    wide = stored(project(rows, model), "whitened")
    at = [F.get("whitened", F.lit(k)) for k in range(kept)]
    # covar_pop centres each part on its own mean and merges the parts
    spread = wide.agg(*[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i in range(kept) for j in range(i, kept)]).first()
    error = max(abs(spread[f"c{i}_{j}"] - (i == j)) for i in range(kept) for j in range(i, kept))
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values])
    return wide.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
