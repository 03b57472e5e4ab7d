"""Near-duplicate documents by min-max hashing (operator 9).

Signature.  A document's set holds its distinct shingles of five lower-cased
words as 64-bit hashes.  Under each of ``PERMUTATIONS`` multiplicative
permutations both the smallest and the largest value are kept, so half as many
hash evaluations give a signature of twice as many unbiased components.  Six
of them (three permutations) form a band; documents with an equal band are candidates.

Whole results.  A pair at the threshold of 0.75 shares one given band with
probability 0.18, and none of the 72 with probability 1e-6.  Documents with the
same set are one class and only its smallest id goes on.  Within a bucket each member
is compared with the smallest one, its hub, on the full sets, and from then on
stands for its difference D from the hub's set: two members' sets differ in
as many shingles as their D, and are similar enough exactly if those are at most
a seventh of both sizes together.  Two members that the hub doesn't link
must share elements of D, and the rarer ones first: in the order of how many
members have an element, one of the first few of each (more of the longer D) is the same.  So the other
candidates come from an equi-join on those elements, first with one partner for each element
and then, between what is still apart, with all; a parity sketch of D (its
distance is never above the sets') goes before the exact test.  Elements that all
members have come last, so a large group of near copies makes no pairs but
its links.  Nothing is capped.

Defined results: a null, empty or blank text has an empty set and links with
nothing; fewer than five words are one shingle; a row without an id links with
nothing, its ``component_id`` is null and it is kept; rows that share an id are
one document: the classes of their sets are linked through the id, rows with an
empty set follow the others, and all are kept or none; an empty table gives an empty
result; texts of any length are cut into slices inside the task; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, free_name, maybe_among, small_batches, stored, text_of
from .components import components
from .wordhash import SHINGLE, mix, shingles, stream, tidied, word_hashes, worker_cache

PERMUTATIONS, BAND = 216, 3
#: Numerator and denominator of the least similarity.
LEAST = (75, 100)

#: 64-bit words of a parity sketch.
SKETCH = 8

_SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def min_max_bands(hashes: np.ndarray, permutations: int = PERMUTATIONS, per_band: int = BAND) -> np.ndarray:
    """Of a set the band keys, each mixing the minima and maxima of ``per_band`` permutations."""
    factors = worker_cache(("factors", permutations), lambda: stream(23, permutations) | np.uint64(1))
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(hashes), 2048):
        values = factors[:, None] * hashes[None, at : at + 2048]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    key = np.arange(1, permutations // per_band + 1, dtype=np.uint64)
    for k in range(per_band):
        key = mix(mix(key + low[k::per_band]) + high[k::per_band])
    return key


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, sizes, a, b, bands = [], [], [], [], []
            for row, words in word_hashes(texts):
                found = shingles(words, SHINGLE)
                rows.append(row)
                sizes.append(len(found))
                a.append(mix(found).sum(dtype=np.uint64))
                b.append(mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64))
                bands.append(min_max_bands(found) if len(found) else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(np.array(a, np.uint64).view(np.int64)),
                    pa.array(np.array(b, np.uint64).view(np.int64)), _lists(bands),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text): id, the set's first digest, and the set; a few rows at a time."""
    with np.errstate(over="ignore"):
        for batch in batches:
            ids, rows, sets = batch.column(0), [], []

            def held():
                digest = np.array([mix(x).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
                return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(digest), _lists(sets)], ["doc_id", "set_a", "items"])

            for row, words in word_hashes(batch.column(1)):
                rows.append(row)
                sets.append(shingles(words))
                if len(rows) == 256 or len(sets[-1]) > 1 << 16:
                    yield held()
                    rows, sets = [], []
            yield held()


def _similar(differ: Column, sizes: Column) -> Column:
    """Whether two sets of ``sizes`` shingles together that differ in ``differ`` are similar enough."""
    return (LEAST[0] + LEAST[1]) * differ <= (LEAST[1] - LEAST[0]) * sizes


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component ``c`` of their ``doc_id``: itself if nothing is linked to it."""
    known = found.select(F.col("node").alias("doc_id"), F.col("component").alias("c"))
    return rows.join(known, "doc_id", "left").withColumn("c", F.coalesce("c", "doc_id"))


def _joined_on(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further ``links`` (u, v): only links between components go on."""
    ends = _with_component(_with_component(links.withColumnRenamed("u", "doc_id"), found).select(F.col("c").alias("u"), F.col("v").alias("doc_id")), found)
    up = stored(components(ends.select("u", F.col("c").alias("v"))), "joined").select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = found.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    roots = up.select(F.col("component").alias("node"), F.col("top").alias("component"))
    return stored(moved.unionByName(roots), "components")


def _maybe(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``column`` may be among the values of ``key``; the others need not be shuffled."""
    return maybe_among(rows, F.xxhash64(column), keys.select(F.xxhash64(key).alias("h")), "_likely").filter("_likely").drop("_likely")


def hub_differences(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """``u, hub, n, hub_n, d``: members of buckets, the first member, set sizes, and the shingles that only one of both has.

    Buckets hold the first digest of a set only; a class is that digest and the smallest id.
    """
    # one shuffle serves both the hubs and the rows that join them; the filter, true of all, is on both sides of that join
    bands = classes.filter("set_a IS NOT NULL").select(F.col("set_a").alias("a"), F.explode("bands").alias("key")).repartition("key")
    hubs = bands.groupBy("key").agg(F.min("a").alias("hub"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    pairs = stored(bands.join(hubs, "key").filter("a <> hub").select("a", "hub").distinct(), "pairs")
    ends = pairs.select("a").unionByName(pairs.select(F.col("hub").alias("a"))).distinct()
    nodes = stored(classes.select("rep", F.col("set_a").alias("a")).join(ends, "a"), "nodes")
    needed = nodes.select(F.col("rep").alias("doc_id")).distinct()
    likely = maybe_among(documents, F.xxhash64("doc_id"), needed.select(F.xxhash64("doc_id").alias("h")), "_likely").filter("_likely")
    sets = likely.select("doc_id", "text").mapInArrow(tidied(_sets), "doc_id long, set_a long, items array<long>")
    sets = sets.join(nodes.select(F.col("rep").alias("doc_id"), F.col("a").alias("set_a")), ["doc_id", "set_a"], "left_semi")
    sets = sets.groupBy("set_a", "doc_id").agg(F.first("items").alias("items"))  # an id with equal rows: equal sets
    with small_batches(sets.sparkSession):
        sets = stored(sets.select("set_a", F.struct("doc_id", "set_a").alias("node"), "items"), "sets")
    theirs = _maybe(sets, "set_a", pairs, "hub").select(F.col("set_a").alias("hub"), F.col("node").alias("hub_node"), F.col("items").alias("theirs"))
    rows = pairs.join(_maybe(sets, "set_a", pairs, "a").withColumnRenamed("set_a", "a"), "a").join(theirs, "hub")
    only = F.concat(F.array_except("items", "theirs"), F.array_except("theirs", "items"))
    found = stored(rows.select(F.col("node").alias("u"), F.col("hub_node").alias("hub"), F.size("items").cast("long").alias("n"),
                               F.size("theirs").cast("long").alias("hub_n"), only.alias("d")), "differences")
    forget(sets)
    return found


def _early(place: Column, sizes: Column) -> Column:
    """Whether an element comes early enough in D to be the first common one of the shorter D."""
    return 2 * LEAST[0] * place <= (LEAST[1] - LEAST[0]) * F.shiftright(sizes, 32)


def rare_elements(members: DataFrame) -> DataFrame:
    """``h, e, m, place, sizes``: of each member's D the elements that others of its hub have too, as far as they can be
    the first common one; ``place`` is the element's, the rarest first; ``sizes`` holds n and, in its lower 32 bits, that of D.

    ``members``: h and m (numbers of the hub and of the member), n, d.
    """
    sizes = F.shiftleft(F.col("n"), 32).bitwiseOR(F.size("d").cast("long")).alias("sizes")
    items = members.select("h", "m", sizes, F.explode("d").alias("e"))
    counts = items.groupBy("h", "e").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    n, nd = F.shiftright("sizes", 32), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1))
    own = Window.partitionBy("m")
    place = nd - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("rows", "e")) - 1
    rows = items.join(counts, ["h", "e"]).withColumn("place", place)
    rows = stored(rows.filter(LEAST[0] * F.col("place") <= (LEAST[1] - LEAST[0]) * n).select("h", "e", "m", "place", "sizes"), "common")
    # an element serves if a member has it early enough to be the shorter D, and another one at all
    early = F.max(_early(F.col("place"), F.col("sizes"))).alias("early")
    serves = rows.groupBy("h", "e").agg(F.count(F.lit(1)).alias("rows"), early).filter("rows > 1 AND early")
    return rows.join(serves.select("h", "e"), ["h", "e"], "left_semi")


def sketches(members: DataFrame) -> DataFrame:
    """``m, doc_id, n, sketch``: of each member its id, its set's size and the parity sketch of its D."""
    bit = F.expr("shiftleft(1L, cast(e & 63 AS int))")
    word = F.expr(f"(e >> 6) & {SKETCH - 1}")
    words = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SKETCH)]
    found = members.select("m", F.explode("d").alias("e")).groupBy("m").agg(*words)
    return members.select("m", F.col("u").alias("doc_id"), "n").join(found, "m").select("m", "doc_id", "n", F.array(*[f"s{k}" for k in range(SKETCH)]).alias("sketch"))


def _in_reach(sizes: Column, place: Column, others: Column, other_place: Column) -> Column:
    """Whether two members' sizes allow the similarity, and an element of both comes early enough in them to be the first common one."""
    total, part = LEAST[0] + LEAST[1], LEAST[1] - LEAST[0]
    n, nv, low = F.shiftright(sizes, 32), F.shiftright(others, 32), F.lit((1 << 32) - 1)
    longer = total * (sizes.bitwiseAND(low) - others.bitwiseAND(low))
    both = part * (n + nv)
    return (2 * total * place <= longer + both) & (2 * total * other_place <= both - longer) & (LEAST[1] * F.least(n, nv) >= LEAST[0] * F.greatest(n, nv))


def _unlinked(n: Column, other_n: Column) -> Column:
    """Whether members (c, sketch; cv, sketchv) of given set sizes are in two components and their sketches allow the similarity."""
    apart = F.lit(0)
    for k in range(SKETCH):
        apart = apart + F.bit_count(F.get("sketch", F.lit(k)).bitwiseXOR(F.get("sketchv", F.lit(k))))
    return (F.col("c") != F.col("cv")) & _similar(apart, n + other_n)


def _star_pairs(rows: DataFrame) -> DataFrame:
    """``last, m, mv``: each member of an element with the first, and (``last``) with the last that has it early.

    As many pairs as rows, twice, at most; the rows hold numbers only, as what tells of a member follows per pair.
    """
    one = F.struct("m", "place", "sizes")
    stars = rows.filter(_early(F.col("place"), F.col("sizes"))).groupBy("h", "e").agg(F.min(one).alias("low"), F.max(one).alias("high"))
    sides = F.array(F.struct(F.lit(False).alias("last"), F.col("low").alias("x")), F.struct(F.lit(True).alias("last"), F.col("high").alias("x")))
    pairs = rows.join(stars, ["h", "e"]).select("m", "place", "sizes", F.explode(sides).alias("s"))
    near = _in_reach(F.col("sizes"), F.col("place"), F.col("s.x.sizes"), F.col("s.x.place"))
    return pairs.filter((F.col("m") != F.col("s.x.m")) & near).select("s.last", "m", F.col("s.x.m").alias("mv")).distinct()


def _candidates(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are not linked yet and whose sketches allow the similarity."""
    other = about.select(*[F.col(k).alias(f"{k}v") for k in about.columns])
    return pairs.join(about, "m").join(other, "mv").filter(_unlinked(F.col("n"), F.col("nv"))).select("m", "mv")


def _apart_pairs(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs ``m, mv`` that share an element early enough, are in two components (c), and whose sizes allow the similarity."""
    other = others.select("h", "e", *[F.col(k).alias(f"{k}v") for k in ("m", "sizes", "place", "c")])
    near = (F.col("c") != F.col("cv")) & _in_reach(F.col("sizes"), F.col("place"), F.col("sizesv"), F.col("placev"))
    return rows.join(other, ["h", "e"]).filter(near).select("m", "mv").distinct()


def _links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``u, v`` of the ``pairs`` (m, mv) that are similar by their D; only a D that a pair may need is shuffled."""
    ends = pairs.select("m").unionByName(pairs.select(F.col("mv").alias("m")))
    d = maybe_among(members.select("m", "u", "n", "d"), F.xxhash64("m"), ends.select(F.xxhash64("m").alias("h")), "_needed").filter("_needed").drop("_needed")
    tested = pairs.join(d, "m").join(d.select(F.col("m").alias("mv"), F.col("u").alias("v"), F.col("n").alias("nv"), F.col("d").alias("dv")), "mv")
    differ = F.size("d") + F.size("dv") - 2 * F.size(F.array_intersect("d", "dv"))
    return tested.filter(_similar(differ, F.col("n") + F.col("nv"))).select("u", "v").distinct()


def near_links(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """``node, component`` over the ids of the class representatives.

    ``classes``: a row per class (rep: smallest id; set_a: digest of the set; bands); ``documents``: doc_id, text.
    """
    members = hub_differences(classes, documents)
    linked = members.filter(_similar(F.size("d"), F.col("n") + F.col("hub_n")))
    found = components(stored(linked.select(F.col("u.doc_id").alias("u"), F.col("hub.doc_id").alias("v")).distinct(), "links"))
    # hubs with members in another component than their own; a linked member is in its hub's
    ends = members.filter(~_similar(F.size("d"), F.col("n") + F.col("hub_n"))).select("hub", F.col("u.doc_id").alias("doc_id"))
    ends = _with_component(ends, found).select("hub", F.col("c").alias("member_c"), F.col("hub.doc_id").alias("doc_id"))
    open_hubs = stored(_with_component(ends, found).filter("c <> member_c").select("hub").distinct(), "open_hubs")
    if open_hubs.isEmpty():
        return found
    # numbers for hubs and members, fixed by being written
    open_hubs = stored(open_hubs.withColumn("h", F.monotonically_increasing_id()), "hub_numbers")
    differences, members = members, members.join(open_hubs, "hub").select("h", F.col("u.doc_id").alias("u"), "n", "d")
    members = stored(members.withColumn("m", F.monotonically_increasing_id()), "members")
    forget(differences)
    rows = stored(rare_elements(members), "rare_elements")
    about = stored(sketches(members), "sketches")
    stars = stored(_star_pairs(rows), "star_pairs")
    for last in (False, True, None):
        now = _with_component(about, found).select("m", "n", "sketch", "c")
        if last is None:  # what is still apart
            known = rows.join(now.select("m", "c"), "m")
            pairs = stored(_apart_pairs(known, known.filter(_early(F.col("place"), F.col("sizes")))), "apart_pairs")
        else:  # one partner for each element: what it links goes on as one component
            pairs = stars.filter(F.col("last") == last).drop("last")
        links = stored(_links(stored(_candidates(pairs, now), "candidates"), members), "links")
        if not links.isEmpty():
            found = _joined_on(found, links)
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id, kept``."""
    documents = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    with small_batches(df.sparkSession):
        signatures = stored(documents.mapInArrow(tidied(_signatures), _SIGNATURES), "signatures")
    sets = ["n_shingles", "set_a", "set_b"]
    linked = signatures.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(linked.groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")), "classes")
    # the rows without their bands, which would lie there beside the texts' sets
    rows = stored(signatures.drop("bands"), "rows")
    forget(signatures)
    linked = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    found = near_links(classes.select("rep", "set_a", "bands"), documents.filter("doc_id IS NOT NULL"))
    # an id in several classes links them
    several = linked.groupBy("doc_id").agg(F.min(F.struct(*sets)).alias("a"), F.max(F.struct(*sets)).alias("b")).filter("a <> b").select("doc_id")
    several = stored(linked.select("doc_id", *sets).join(several, "doc_id", "left_semi").distinct(), "several")
    if not several.isEmpty():
        shared = several.join(classes.select(*sets, "rep"), sets).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
        found = _joined_on(found, stored(shared, "shared"))
    answer = stored(
        classes.select(*sets, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*sets, F.coalesce("component", "rep").alias("c")),
        "answer",
    )
    own = rows.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(answer, sets).select("doc_id", "n_shingles", F.col("c").alias("component_id"))
    empty = stored(own.filter("doc_id IS NOT NULL").select("doc_id").distinct(), "empty")
    if not empty.isEmpty():
        theirs = out.join(empty, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("c"))
        own = own.join(theirs, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("c", "component_id").alias("component_id"))
    return out.unionByName(own).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, all columns unchanged: one document of each group."""
    key = free_name(df, "_dropped_id")
    dropped = stored(near_duplicates(df, id_col, text_col).filter("NOT kept").select("doc_id").distinct(), "dropped")
    dropped = dropped.withColumnRenamed("doc_id", key)
    maybe = free_name(df, "_maybe")
    rows = maybe_among(df, F.xxhash64(id_col), dropped.select(F.xxhash64(key).alias("h")), maybe)
    stay = rows.filter(~F.col(maybe)).unionByName(rows.filter(maybe).join(dropped, F.col(id_col) == F.col(key), "left_anti"))
    return stay.drop(maybe)
