"""Exact de-duplication with a heavy-hitter split (operator 5).

Every text is reduced to its SHA-256 digest in the scan.  A Misra-Gries
summary of the digests (``DataFrame.freqItems``: mergeable counters, at most
``1 / support`` of them, no digest with more than ``support * N`` rows missed)
names the candidates for very large groups.  Their sizes and winners are then
verified by an exact aggregate, and this table of at most ``1 / support`` rows
is broadcast: rows of those groups are decided where they are read and never
shuffled.  What remains is shuffled by digest; none of its groups can hold
more than ``support * N`` rows, so no task is hot.

Defined results: a null text counts as empty; the row with the largest
``doc_id`` stays; a null ``doc_id`` loses to any other, and a group of null ids
only keeps all its rows (``keep_id`` is null: there is nothing to tell them
apart by); rows that repeat both id and text are one document and get the same
answer; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, maybe_among, stored, text_of

#: Bound on the broadcast: at most 1 / SUPPORT digests, about 100 bytes each.
SUPPORT = 1e-3


def digest_column(text_col: str = "text"):
    """Lowercase hex SHA-256 of the UTF-8 text, null as empty."""
    return F.sha2(text_of(text_col), 256)


def frequent_digests(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified heavy digests: ``text_sha256, hot_keep_id, hot_size``.

    ``digests`` has ``doc_id, text_sha256``.  The Misra-Gries candidates may
    hold false ones; the exact aggregate drops those that have a single row.
    """
    candidates = digests.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    return (
        digests.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("hot_keep_id"), F.count(F.lit(1)).alias("hot_size"))
        .filter("hot_size > 1")
    )


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = stored(df.select(F.col(id_col).alias("doc_id"), digest_column(text_col).alias("text_sha256")), "digests")
    heavy = stored(frequent_digests(digests, support), "heavy")
    split = digests.join(F.broadcast(heavy), "text_sha256", "left")
    hot = split.filter("hot_size IS NOT NULL").select(
        "doc_id", F.col("hot_keep_id").alias("keep_id"), F.col("hot_size").alias("group_size"), "text_sha256"
    )
    same = Window.partitionBy("text_sha256")
    rest = split.filter("hot_size IS NULL").select(
        "doc_id", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"), "text_sha256"
    )
    return hot.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged: one of each text.

    Rows that ``copy_groups`` cannot tell apart (the winning id repeated, or null
    ids only) are reduced to one of them by an aggregate, in every task first;
    which one depends on the rows alone.  Texts of any length stay where they are
    unless a copy of them may exist.
    Only ids and digests of the dropped rows meet the documents again (an anti
    join that Spark broadcasts when it finds that side small).
    """
    digest, key, own = free_name(df, "_sha256"), free_name(df, "_dropped_id"), free_name(df, "_own_sha256")
    groups = stored(copy_groups(df, id_col, text_col, support).filter("group_size > 1").select("doc_id", "text_sha256", "kept"), "groups")
    dropped = groups.filter("NOT kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(digest)).distinct()
    ties = stored(groups.filter("kept").groupBy(F.col("text_sha256").alias(digest)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "ties")
    # only texts whose digest may be one with copies take part in joins
    maybe = free_name(df, "_maybe")
    copied = groups.select(F.xxhash64("text_sha256").alias("h"))
    rows = df.withColumn(own, digest_column(text_col))
    rows = maybe_among(rows, F.xxhash64(own), copied, maybe)
    single, rows = rows.filter(~F.col(maybe)).drop(own, maybe), rows.filter(maybe).drop(maybe)
    match = (F.col(own) == F.col(digest)) & F.col(id_col).eqNullSafe(F.col(key))
    left = rows.join(dropped, match, "left_anti")
    if ties.isEmpty():
        return single.unionByName(left.drop(own))
    tied = F.col(own) == F.col(digest)
    # of rows that all compare alike the smallest in all columns' hash: a task that runs again picks the same
    one = left.join(ties, tied, "left_semi")
    one = one.groupBy(own).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])).alias("row"))
    return single.unionByName(left.join(ties, tied, "left_anti").drop(own)).unionByName(one.select("row.*"))
