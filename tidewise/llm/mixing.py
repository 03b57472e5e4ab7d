"""Mixing sources to target weights with hash-threshold histograms (operator 7).

Every document gets a fixed 60-bit hash.  Sizes are summed by source and hash
bucket (the top 12 bits); the running sum over a source's 4,096 buckets gives
the bucket in which its budget ends.  Only the documents of that one bucket are
summed again by the next 12 bits, and so on: the threshold narrows without any
sort of documents, and the final choice is a comparison ``hash < threshold`` in
the scan.  Thresholds of growing budgets are nested: a larger budget keeps all
that a smaller one took.

Targets.  Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
and share ``share`` of all sizes.  No target passes ``cap`` times its source's
size; the excess goes to the others by weight until none is above, which is
``target = min(cap * size, level * weight)`` with the one level at which the
targets add up.  A source whose target is above its size repeats: every
document is taken ``floor(target / size)`` times, and once more if its hash is
below the threshold for what is left.  The bucket that cannot be split further
(documents with one hash) is taken when that brings the sum nearer.

Defined results: null text has size 0; a null ``doc_id`` is hashed by its text;
rows that repeat an id have one hash and are taken alike; a source of size 0
has target 0; an empty table gives an empty result; a column named like one of
ours is not read unless it is ``id_col``, ``text_col`` or ``source_col``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, stored, text_of

WEIGHTS = (1, 2, 3)
HASH_BITS, STEP = 60, 12
#: Sources up to which the table of thresholds (about 100 bytes a row) is broadcast; more are joined by shuffling.
BROADCAST_SOURCES = 50_000


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint")


def hash_of(id_col: str, text_col: str, seed: int) -> Column:
    """The first 60 bits of an MD5 over id and seed."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.md5(text_of(text_col))), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, share: float = 1.0, cap: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``src_null, src, source_size, weight, target``, one row per source.

    ``sizes`` has a row per source; the two windows run over these few rows.
    """
    order = Window.orderBy("src_null", "src")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1)).withColumn(
        "most", F.col("source_size") * cap
    )
    # fill in the order in which sources reach their cap
    fill = Window.orderBy(F.col("most") / F.col("weight"), "src_null", "src").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = ranked.withColumn("full", F.coalesce(F.sum("most").over(fill), F.lit(0))).withColumn(
        "open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0))
    ).withColumn("level", (F.sum("source_size").over(everything) * F.lit(share) - F.col("full")) / F.col("open"))
    level = F.min(F.when(F.col("most") >= F.col("level") * F.col("weight"), F.struct("full", "level"))).over(everything)
    return filled.withColumn("level", level["level"]).select(
        "src_null", "src", "source_size", "weight",
        F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double"))).alias("target"),
    )


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """``src_null, src, below``: a document counts towards the budget if its hash is below.

    ``docs`` has ``src_null, src, hash, size``; ``budgets`` has ``src_null, src, budget``
    with a budget below the source's size.  One aggregate per step of 12 bits,
    after the first only over the boundary buckets.
    """
    source = ["src_null", "src"]
    at, done, shift = budgets.select(*source, F.lit(0).cast("bigint").alias("prefix"), "budget"), [], HASH_BITS
    while shift:
        inside = docs.withColumn("prefix", F.shiftright("hash", shift)).join(F.broadcast(at) if _few(at) else at, [*source, "prefix"])
        shift -= STEP
        bucket = F.shiftright("hash", shift)
        sums = inside.groupBy(*source, bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.first("budget").alias("budget"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
        )
        run = Window.partitionBy(*source).orderBy("bucket")
        past = sums.withColumn("upto", F.sum("size").over(run)).filter("upto > budget")
        first = stored(
            past.groupBy(*source).agg(F.min_by(F.struct("bucket", "size", "upto", "budget", "lo", "hi"), "bucket").alias("b")).select(*source, "b.*"),
            "boundary",
        )
        left = F.col("budget") - (F.col("upto") - F.col("size"))
        whole = first.filter("lo = hi")  # one hash: taken if that is nearer to the budget
        done.append(whole.select(*source, F.when(left * 2 > F.col("size"), F.col("hi") + 1).otherwise(F.col("hi")).alias("below")))
        at = first.filter("lo < hi").select(*source, F.col("bucket").alias("prefix"), left.alias("budget"))
        if at.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _few(sources: DataFrame) -> bool:
    return sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def _plan(df: DataFrame, id_col: str, text_col: str, source_col: str, share: float, cap: int, weights: tuple[int, ...], seed: int):
    """The compact rows and, per source, its size, target, full repeats and threshold."""
    docs = stored(
        df.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("src_null"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
            hash_of(id_col, text_col, seed).alias("hash"), word_count(text_col).alias("size"),
        ),
        "sizes",
    )
    sizes = stored(docs.groupBy("src_null", "src").agg(F.sum("size").alias("source_size")), "sources")
    targets = source_targets(sizes, share, cap, weights).withColumn(
        "times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    )
    budget = F.col("target") - F.col("times") * F.col("source_size")
    targets = stored(targets.withColumn("budget", budget), "targets")
    below = thresholds(docs, targets.filter("budget > 0").select("src_null", "src", "budget"))
    plan = stored(targets.join(below, ["src_null", "src"], "left").withColumn("below", F.coalesce("below", F.lit(0).cast("bigint"))), "plan")
    return docs, plan


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.0,
    cap: int = 3, weights: tuple[int, ...] = WEIGHTS, seed: int = 7,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, times, taken``; ``taken = size * times``."""
    docs, plan = _plan(df, id_col, text_col, source_col, share, cap, weights, seed)
    times = F.col("times") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return docs.join(F.broadcast(plan) if _few(plan) else plan, ["src_null", "src"]).select(
        "doc_id", "size", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken")
    )


def mixed_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.0,
    cap: int = 3, weights: tuple[int, ...] = WEIGHTS, seed: int = 7,
) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it is taken, all columns unchanged."""
    _, plan = _plan(df, id_col, text_col, source_col, share, cap, weights, seed)
    names = {c: free_name(df, f"_mix_{c}") for c in ("src_null", "src", "times", "below", "hash", "n")}
    plan = plan.select(*[F.col(c).alias(names[c]) for c in ("src_null", "src", "times", "below")])
    rows = df.withColumn(names["hash"], hash_of(id_col, text_col, seed))
    same = (F.col(names["src_null"]) == F.col(source_col).isNull()) & (F.col(names["src"]) == F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    times = F.col(names["times"]) + F.when(F.col(names["hash"]) < F.col(names["below"]), 1).otherwise(0)
    rows = rows.join(F.broadcast(plan) if _few(plan) else plan, same).withColumn(names["n"], times.cast("int")).filter(F.col(names["n"]) > 0)
    rows = rows.withColumn(names["n"], F.explode(F.array_repeat(F.lit(0), F.col(names["n"]))))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])
