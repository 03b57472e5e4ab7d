"""Duplicates by digest.

Every row is reduced to a 128-bit digest of its key columns.  Digests and
their counts are all that is shuffled at first, however wide the rows are, and
a digest that occurs once belongs to no duplicate.  The rows of the other
digests are compared by value, so two keys that share a digest stay two keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .._col import qident
from ..session import cut_lineage

#: Repeated digests (16 bytes each) that are broadcast; with more of them the keys are grouped whole.
FEW = 1_000_000


def row_digest(cols: Sequence[Column]) -> Column:
    """Two 64-bit hashes; NULL cells are marked, because a hash skips them."""
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "n").otherwise("v") for c in cols])
    return F.struct(F.xxhash64(nulls, *cols).alias("a"), F.xxhash64(F.lit("second"), *cols, nulls).alias("b"))


def repeated(df: DataFrame, keys: Sequence[str], digest: Callable[[Sequence[Column]], Column] = row_digest) -> tuple[DataFrame, bool]:
    """The keys of more than one row with their counts ``_n``, and whether
    they are at most ``FEW``.  NULLs compare equal; NaN equals NaN."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(qident(k)) for k in keys]
    if not cols:
        raise ValueError("no columns to compare")
    plain = [F.array_sort(F.map_entries(c)) if isinstance(kinds[k], MapType) else c for k, c in zip(keys, cols)]
    keyed = df.select(*cols, digest(plain).alias("_digest"))
    again = cut_lineage(keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest"))
    few = again.count() <= FEW
    if few:
        keyed = keyed.join(F.broadcast(again), "_digest", "left_semi")
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), few


def duplicate_rows(df: DataFrame, digest: Callable[[Sequence[Column]], Column] = row_digest) -> DataFrame:
    """Rows minus distinct rows (NULLs compare equal), one row."""
    if not df.columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).cast("bigint").alias("n_duplicates"))
    found, _ = repeated(df, df.columns, digest)
    return found.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def duplicates(df: DataFrame, keys: Sequence[str], digest: Callable[[Sequence[Column]], Column] = row_digest) -> DataFrame:
    """Every row whose key occurs more than once (``keep=False``).

    The rows are picked by a semi join with the repeated keys, which are
    broadcast when their digests were few; AQE splits it when one key is hot.
    NULL keys are a value.
    """
    found, few = repeated(df, list(keys), digest)
    found = found.select(*[F.col(qident(k)).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(qident(k)).eqNullSafe(F.col(f"_key{i}"))
    return df.join(F.broadcast(found) if few else found, same, "left_semi")
