"""Document fingerprints: threshold-scaled sketches (operator 6).

The sketch of a text is the sorted set of its shingle hashes that lie in the
lowest ``1 / SCALE`` of the hash range.  Which hashes are kept depends on the
hash alone, never on the text's length or on what else is in the sketch.  So
sketches merge by union (the sketch of two texts is the union of theirs), and the
share of one sketch found in another estimates containment without bias,
also between a page and a book.  Sketches grow with their texts.

Shingles are five consecutive words; a shorter text is one shingle.  The
hash chains Spark's 64-bit hash over the words, in the JVM.

Neighbours in descending id order come from one range partitioning on literal
bounds: the first document of each range is also sent to the range before,
so every document finds the next one in its own task and no window holds more
than one range.

A fingerprint is the hash of the whole text followed by the sketch, so short texts whose few
shingles all lie above the limit (about one document in a hundred) still differ.

Defined results: a null text counts as empty and has an empty sketch; two empty
sketches are alike (1.0) if the whole texts' hashes are equal and unlike (0.0) otherwise; an
empty table gives an empty result; rows that repeat an id follow one another,
ordered by text; null ids come last; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions_for
from .common import SPACE, stored, text_of

SHINGLE, SCALE = 5, 4
#: Hashes below this are kept: the lowest 1 / SCALE of the signed 64-bit range.
LIMIT = -(1 << 63) + (1 << 64) // SCALE
#: Ids are cut into ranges at this many quantiles per value returned by the sketch of ids.
ACCURACY = 100


def sketch(text: Column) -> Column:
    """Sorted array of the kept hashes of a text column."""
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def chain(a: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.size(a) - (SHINGLE - 1)),
            lambda i: F.xxhash64(*[F.element_at(a, (i + k).cast("int")) for k in range(SHINGLE)]),
        )
        whole = F.when(F.size(a) > 0, F.array(F.xxhash64(a))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(a) >= SHINGLE, runs).otherwise(whole)

    # let-binding: the word hashes are computed once and used under one name
    kept = F.transform(F.array(hashes), lambda a: F.filter(chain(a), lambda h: h < F.lit(LIMIT)))
    return F.array_sort(F.array_distinct(F.element_at(kept, 1)))


def merge(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles."""
    return F.array_sort(F.array_union(a, b))


def whole(text: Column) -> Column:
    """A hash of the whole text: the fingerprint's first field, so texts whose shingles are all above the limit differ."""
    return F.xxhash64(text)


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets; ``equal``: whether the whole hashes are, for empty sketches."""
    common = F.size(F.array_intersect(a, b))
    all_ = F.size(a) + F.size(b) - common
    return F.when(all_ > 0, common / all_).otherwise(equal.cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; null for an empty sketch."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(first: Column, a: Column) -> Column:
    """The whole text's hash and the sketch as hex digits, 16 for each hash."""
    return F.concat_ws("", F.transform(F.concat(F.array(first), a), lambda h: F.lpad(F.hex(h), 16, "0")))


def with_next(df: DataFrame, id_col: str, carried: list[str], text_col: str) -> DataFrame:
    """Adds ``next_<column>`` of the following row in descending id order; after the last comes the first."""
    n = shuffle_partitions_for(df)
    ids = df.select(F.col(id_col).alias("i"))
    cuts = ids.select(F.percentile_approx("i", [k / n for k in range(1, n)] or [0.5], n * ACCURACY)).first()[0] or []
    bounds = sorted({int(c) for c in cuts}) if n > 1 else []
    # range 0 holds the largest ids; null ids come after all others
    edge = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    own = F.when(F.col(id_col).isNull(), F.lit(len(bounds))).otherwise(F.size(F.filter(edge, lambda b: b > F.col(id_col))))
    firsts = [r[0] for r in ids.withColumnRenamed("i", id_col).groupBy(own.alias("r")).agg(F.count(F.lit(1))).orderBy("r").collect()]
    if not firsts:
        return df.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    before = {r: firsts[k - 1] for k, r in enumerate(firsts)}  # the range of the row in front; the first follows the last
    order = [F.col(id_col).desc_nulls_last(), F.col(text_col)]
    previous = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    # the leading row of each range, by id: one id per range
    tops = {r["r"]: r["top"] for r in ids.withColumnRenamed("i", id_col).groupBy(own.alias("r")).agg(F.max(id_col).alias("top")).collect()}
    top = F.create_map(*[F.lit(x) for r, t in tops.items() for x in (r, t)])
    rows = df.withColumn("_range", own)
    leading = rows.filter(F.col(id_col).eqNullSafe(F.element_at(top, F.col("_range"))))
    one = leading.groupBy("_range").agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), text_col).alias("row"))
    halo = one.select("row.*", F.element_at(previous, F.col("_range")).alias("_range"), F.lit(True).alias("_halo"))
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo)
    placed = both.repartitionById(len(bounds) + 1, F.col("_range"))
    ahead = Window.partitionBy("_range").orderBy("_halo", *order)
    return placed.select("*", *[F.lead(c).over(ahead).alias(f"next_{c}") for c in carried]).filter("NOT _halo").drop("_range", "_halo")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, and how they hold up under an edit that replaces its second half.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("sketch", sketch(F.col("text")))
    docs = docs.withColumn("whole", whole(F.col("text")))
    rows = with_next(docs, "doc_id", ["text", "sketch", "whole"], "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch", "whole", (F.col("whole") == F.col("next_whole")).alias("same_next"),
        edited.alias("edited"), whole(edited).alias("edited_whole"),
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_sketch", sketch(F.col("edited"))).drop("edited")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("whole"), F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_whole"), F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("whole") == F.col("edited_whole")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), F.col("same_next")).alias("near_next"),
    )
