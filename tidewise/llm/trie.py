"""Prefix trie of conversations from sorted neighbours (operator 12).

A turn is a 128-bit digest of role and text, a conversation the string of its
turns' digests; texts are read once and not shuffled.  The strings are sorted
over all tasks by range.  Within a task (a *block* of the sorted
conversations) the common prefix lengths of neighbours (LCPs) go into a sparse
table of range minima, and every candidate prefix binary-searches how far left
and right the LCPs stay at its depth: that interval holds its members, so
counts, smallest ids, leaves and savings are differences of running sums and
range minima.  No stack and no tree is built.

Prefixes that reach an end of their block may go on in the next one.  Only these
(two paths a block) are *open*: their parts are merged by the digest of the prefix, and
their subtree sums are ranges of one running sum over the open prefixes in
tree order.  A conversation, first turn or prefix that a third of all rows
share spreads over many blocks; its ids are joined to long strings in the
blocks, so the one task that hashes them reads a few rows.

Defined results: rows without a conversation id are left out; turns go by
``turn`` (null first), ties by role, then by digest of the text; null role or text
is empty; repeated rows are turns of their own; a conversation left without
turns is a member of the root only; an empty table gives an empty result; a
text of any length is one turn; other columns are not read.  A conversation's
digests (16 bytes a turn) are one value of one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Heads are taken from the conversation at the start of each run of this many ids.
RUN = 100
#: A head has fewer turns than this.
HEAD = 6
DIGEST = 16
#: Characters of joined ids in one row.
JOINED = 1 << 20

_NODE = "key binary, parent binary, depth long, chars long, n_convs long, first_id long, n_children long, n_leaves long, saved long, ends_sha256 string, parent_id long, open boolean, block int, side int, last_side int, ends array<string>"
_NODE_ARROW = pa.schema([
    ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("chars", pa.int64()), ("n_convs", pa.int64()), ("first_id", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends_sha256", pa.string()), ("parent_id", pa.int64()),
    ("open", pa.bool_()), ("block", pa.int32()), ("side", pa.int32()), ("last_side", pa.int32()), ("ends", pa.list_(pa.string())),
])


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, chars``: turns in order, with texts replaced by digests."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.md5(role), F.md5(text)))
    turns = rows.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return turns.withColumn("pos", F.row_number().over(order) - 1).select("conv_id", "pos", "digest", "chars")


def rebuilt_paths(turns: DataFrame, run: int = RUN, head: int = HEAD) -> DataFrame:
    """``conv_id, path, chars``: each conversation's first turns replaced by those of its run's first conversation.

    ``path``: the digests one after the other; ``chars``: code points of the turns' texts.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % head).cast("int")
    ids = turns.select("conv_id").distinct().withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % run)
    # at most ``head`` turns of each base, and at most 2 * run - 1 conversations to one base
    firsts = turns.filter(F.col("pos") < head - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    heads = ids.join(firsts, "base").filter("pos < h").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "chars")
    own = turns.filter(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars")
    none = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("chars"))
    parts = heads.unionByName(own).unionByName(none).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "pos", "digest", "chars"))).alias("t"))
    path = F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), ""))
    return parts.select("conv_id", path.alias("path"), F.transform(F.slice("t", 2, F.size("t")), lambda x: x["chars"]).alias("chars"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many leading digests two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    differ = np.frombuffer(a, np.uint64, n // 8) != np.frombuffer(b, np.uint64, n // 8)
    return int(differ.argmax()) // (DIGEST // 8)


class RangeMinima:
    """A sparse table: level k holds the minima of all runs of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            low, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[: len(low) - step], low[step:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first..last, both included."""
        k = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.levels[level][first[at]], self.levels[level][last[at] + 1 - (1 << level)])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place such that all values after ``at`` up to it are ``depth`` at least."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            table = self.levels[k]
            can = at + 1 < len(table)
            can[can] = table[at[can] + 1] >= depth[can]
            at[can] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place such that all values after it up to ``at`` are ``depth`` at least."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            table, low = self.levels[k], at + 1 - (1 << k)
            can = low >= 0
            can[can] = table[low[can]] >= depth[can]
            at[can] -= 1 << k
        return at


def _ids(values: np.ndarray) -> str:
    return ",".join(map(str, values.tolist()))


def block_nodes(block: int, ids: np.ndarray, paths: list[bytes], chars: list) -> Iterator[pa.RecordBatch]:
    """The prefixes of one block of sorted conversations (rows of ``_NODE``).

    A prefix that may go on in another block is open: its sums leave out what
    is open below it, and ``side`` tells the end that it was found at (0 the
    first conversation, 1 the last), ``last_side`` how far it reaches.
    """
    n = len(ids)
    sizes = np.array([len(p) // DIGEST for p in paths])
    lcp = np.array([-1] + [common_turns(paths[k - 1], paths[k]) for k in range(1, n)])
    table, lowest = RangeMinima(lcp), RangeMinima(ids)
    # a candidate for every prefix that its conversation is the first to have
    new = sizes - lcp
    at = np.repeat(np.arange(n), new)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(new) - new, new) + np.repeat(lcp, new) + 1
    first, last = table.left(at, depth), table.right(at, depth)
    # the prefix one shorter: the parent
    above = np.maximum(depth - 1, 0)
    parent_first, parent_last = table.left(at, above), table.right(at, above)
    left_open, right_open = first == 0, last == n - 1
    is_open = left_open | right_open
    parent_open = (parent_first == 0) | (parent_last == n - 1)
    weight = np.zeros(len(at), np.int64)
    for k, (i, d) in enumerate(zip(at.tolist(), depth.tolist())):
        if d:
            weight[k] = chars[i][d - 1]
    members = last - first + 1
    # candidates stand in tree order, so a subtree is the run up to the last conversation's last candidate
    end = np.cumsum(new)[last]
    here = np.arange(len(at))
    own = np.where(is_open, 0, (members - 1) * weight)
    saved = np.concatenate([[0], np.cumsum(own)])
    # children by parent: a node's parent is the last earlier candidate at its parent's place
    start = np.cumsum(new) - new
    parent_at = start[parent_first] + above - (lcp[parent_first] + 1)
    below = (depth > 0) & ~is_open
    children = np.bincount(parent_at[below], minlength=len(at))
    leaf = (children == 0) & ~is_open
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    smallest = lowest.least(first, last)
    keys = []
    for i, d, p in zip(at.tolist(), depth.tolist(), parent_at.tolist()):
        keys.append(hashlib.md5(keys[p] + paths[i][(d - 1) * DIGEST : d * DIGEST]).digest() if d else b"")
    # members that end here are equal and stand first
    equal = np.cumsum(np.concatenate([[True], (lcp[1:] < sizes[1:]) | (lcp[1:] < sizes[:-1])]))
    same = np.where(sizes[first] == depth, np.searchsorted(equal, equal, "right")[first] - first, 0)
    rows = []
    for k in range(len(at)):
        mine = ids[first[k] : first[k] + same[k]]
        if is_open[k]:
            pieces = [_ids(mine[x : x + JOINED // 20]) for x in range(0, len(mine), JOINED // 20)]
            digest, parent_id = None, None
        else:
            pieces, digest = [], hashlib.sha256(_ids(mine).encode()).hexdigest()
            parent_id = None if parent_open[k] else int(smallest[parent_at[k]])
        rows.append((
            keys[k], keys[parent_at[k]] if depth[k] and parent_open[k] else None, int(depth[k]), int(weight[k]), int(members[k]), int(smallest[k]), int(children[k]),
            int(leaves[end[k]] - leaves[here[k]]), int(saved[end[k]] - saved[here[k]]), digest, parent_id, bool(is_open[k]), block,
            0 if left_open[k] else 1, 1 if right_open[k] else 0, pieces,
        ))
        if len(rows) == 10000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _NODE_ARROW.types)], schema=_NODE_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _NODE_ARROW.types)], schema=_NODE_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, paths, chars = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        paths += batch.column(1).to_pylist()
        chars += [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
    if ids:
        yield from block_nodes(TaskContext.get().partitionId(), np.array(ids, np.int64), paths, chars)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, string of ids) in order: one digest for each key."""
    key, held = None, None
    for batch in batches:
        done = []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is not None and k == key:
                held.update(b",")
            else:
                if held is not None:
                    done.append((key, held.hexdigest()))
                key, held = k, hashlib.sha256()
            held.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["key", "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([held.hexdigest()], pa.string())], ["key", "ends_sha256"])


def prefix_trie(rows: DataFrame, run: int = RUN, head: int = HEAD) -> DataFrame:
    """One row per prefix: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    turns = stored(numbered_turns(rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")), "turns")
    return trie(rebuilt_paths(turns, run, head))


def trie(paths: DataFrame) -> DataFrame:
    """The prefixes of given paths (conv_id, path, chars), see ``prefix_trie``."""
    order = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = stored(order.mapInArrow(_blocks, _NODE), "parts")
    inner, edge = parts.filter("NOT open"), parts.filter("open")
    # open prefixes: the parts of all blocks together
    reach = F.struct("block", "last_side")
    merged = edge.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("chars").alias("chars"), F.sum("n_convs").alias("n_convs"),
        F.min("first_id").alias("first_id"), F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved").alias("inner_saved"), F.min(F.struct("block", "side")).alias("start"), F.max(reach).alias("stop"),
    )
    under = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    merged = stored(
        merged.join(under, "key", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("open_children", F.lit(0)))
        .withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")), "open",
    )
    # in tree order, with a row at the end of each path of each block
    marks = edge.select("block").distinct().select("block", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    line = merged.select(F.col("start.block").alias("block"), F.col("start.side").alias("side"), "depth", "key", "weight", (F.col("n_children") == 0).cast("long").alias("leaf"))
    none = F.lit(0).cast("long")
    line = line.unionByName(marks.select("block", "side", F.lit((1 << 62)).alias("depth"), F.lit(None).cast("binary").alias("key"), none.alias("weight"), none.alias("leaf")))
    upto = Window.orderBy("block", "side", "depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = stored(line.withColumn("w", F.sum("weight").over(upto)).withColumn("l", F.sum("leaf").over(upto)), "line")
    begin = line.filter("key IS NOT NULL").select("key", (F.col("w") - F.col("weight")).alias("w0"), (F.col("l") - F.col("leaf")).alias("l0"))
    end = line.filter("key IS NULL").select(F.struct("block", F.col("side").alias("last_side")).alias("stop"), F.col("w").alias("w1"), F.col("l").alias("l1"))
    joined = edge.select("key", "block", F.posexplode("ends").alias("piece", "text")).repartition("key").sortWithinPartitions("key", "block", "piece")
    digests = joined.select("key", "text").mapInArrow(_hashed, "key binary, ends_sha256 string")
    ids = merged.select(F.col("key").alias("parent"), F.col("first_id").alias("open_parent_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    whole = (
        merged.join(begin, "key").join(end, "stop").join(digests, "key", "left").join(ids, "parent", "left")
        .select(
            F.col("first_id").alias("conv_id"), "depth", F.col("open_parent_id").alias("parent_conv_id"), "n_convs", "n_children",
            (F.col("inner_leaves") + F.col("l1") - F.col("l0")).alias("n_leaves"), (F.col("inner_saved") + F.col("w1") - F.col("w0")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
    # the parent of an inner prefix is known, or open
    for part, above in ((inner.filter("parent IS NULL"), "parent_id"), (inner.filter("parent IS NOT NULL").join(ids, "parent"), "open_parent_id")):
        whole = whole.unionByName(part.select(
            F.col("first_id").alias("conv_id"), "depth", F.col(above).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            F.col("saved").alias("saved_tokens"), "ends_sha256",
        ))
    return whole
