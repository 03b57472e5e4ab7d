"""Resharding by minimum-cost flow (operator 8).

Old shards (their sizes in bytes) are to become new shards of given capacities.
Each new shard adopts one old shard (the largest take the largest, which keeps
the most bytes); bytes that stay in their adopted shard cost nothing and
every other byte costs one.  A minimum-cost flow over old shards, a hub and new
shards gives how many bytes go from where to where.

The flow is turned into block transfers.  A block holds the documents of one old
shard with one value of an id hash, about ``block_bytes`` of them; only block
sizes reach the driver, and the units (documents, or rows that stay together) that
are larger than a block.  These are placed before the flow, the largest first, and
a shard that one of them fills past its capacity gets nothing else: the others
share the rest evenly.  Blocks that lie within one arc of the flow move (or
stay) whole.  A block that an arc's end cuts is split by documents, largest first,
in a task of its own.  What is still unequal is evened out by moving and cutting
further blocks, then by single documents from the fullest to the emptiest shards,
round after round until the shards are even or no move helps.  Shards that
keep exactly their old file are not rewritten; all others are written anew, with
one shuffle of the texts.

Defined results: a null text has no bytes; rows without an id are told apart by
their text; rows that share an id stay together; an empty table gives an
empty result; other columns are written along with the text, but for those
that have one of our own names (``OWN``), which are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, text_of

SHARDS, EXTRA = 24, 8
BLOCK_BYTES, BLOCKS_PER_SHARD = 64 << 20, 64
#: Blocks (some 40 bytes each) up to which their table is broadcast; a larger one is joined by shuffling.
BROADCAST_BLOCKS = 200_000
#: Names of the result and of working columns.
OWN = ("shard", "slot", "_name", "_unit", "_old", "_block", "_blocks", "_single", "_to", "_start", "_n")
#: Documents of a shard offered in one round of evening out: so many of each power-of-two size.
OFFERED = 8
#: Shards are even when none is further from its target than this share of a mean shard.
EVEN = 1e-3


class FlowNetwork:
    """Minimum-cost flow by shortest paths, all of one length pushed at once."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, source: int) -> list[float]:
        far, waiting, queue = [float("inf")] * len(self.out), {source}, deque([source])
        far[source] = 0
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in self.out[x]:
                if self.room[e] and far[x] + self.cost[e] < far[self.to[e]]:
                    far[self.to[e]] = far[x] + self.cost[e]
                    if self.to[e] not in waiting:
                        waiting.add(self.to[e])
                        queue.append(self.to[e])
        return far

    def solve(self, source: int, sink: int) -> int:
        """Send as much as possible at least cost; returns the cost."""
        total = 0
        while (far := self._distances(source))[sink] < float("inf"):
            at, path, used, on_path = [0] * len(self.out), [], source, {source}
            while True:  # depth first along shortest paths
                if used == sink:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    total += push * int(far[sink])
                    cut = next(k for k, e in enumerate(path) if not self.room[e])
                    for e in path[cut:]:
                        on_path.discard(self.to[e])
                    used = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while at[used] < len(self.out[used]):
                    e = self.out[used][at[used]]
                    if self.room[e] and far[used] + self.cost[e] == far[self.to[e]] and self.to[e] not in on_path:
                        break
                    at[used] += 1
                if at[used] < len(self.out[used]):
                    path.append(e)
                    used = self.to[e]
                    on_path.add(used)
                elif path:
                    on_path.discard(used)
                    used = self.to[path.pop() ^ 1]
                    at[used] += 1
                else:
                    break
        return total


def adoption(old: list[int], new: list[int]) -> dict[int, int]:
    """New -> old: the largest new shards take the largest old ones."""
    by_size = sorted(range(len(old)), key=lambda i: (-old[i], i))
    return dict(zip(sorted(range(len(new)), key=lambda j: (-new[j], j)), by_size))


def levelled(loads: list[int], shares: list[float], rest: int) -> list[int]:
    """Sizes of the shards when ``rest`` bytes are poured over ``loads``: all at one level for their share, or above it already."""
    order = sorted((j for j in range(len(loads)) if shares[j] > 0), key=lambda j: loads[j] / shares[j])
    under, poured, share = [], rest, 0.0
    for j in order:
        if under and loads[j] * share >= poured * shares[j]:
            break
        under.append(j)
        poured += loads[j]
        share += shares[j]
    targets, done, at = list(loads), 0, 0.0
    for k, j in enumerate(sorted(under), 1):
        at += shares[j]
        upto = poured if k == len(under) else round(poured * at / share)
        targets[j] = upto - done
        done = upto
    # rounding may leave a target a byte below its load
    for j in under:
        while targets[j] < loads[j]:
            k = max(under, key=lambda k: targets[k] - loads[k])
            part = min(loads[j] - targets[j], max(1, (targets[k] - loads[k]) // 2))
            targets[j] += part
            targets[k] -= part
    return targets


def place_large(units: list[tuple[int, int]], olds: list[int], adopted: dict[int, int], shares: list[float], total: int) -> tuple[list[int], list[int], list[int]]:
    """Shards for the ``units`` (bytes, old) larger than a block; the bytes so placed and the target of each shard.

    ``olds``: the bytes of each old shard, ``total`` their sum.  A unit that no
    target can hold gets the emptiest shard for itself, and the targets of the
    others are levelled again.  The rest stay where they fit, or fill the
    largest gap.
    """
    loads, free = [0] * len(shares), total
    targets, home = levelled(loads, shares, total), {i: j for j, i in adopted.items()}
    to, small = [-1] * len(units), list(olds)
    for size, i in units:
        small[i] -= size
    homeless = []

    def put(k: int, j: int) -> None:
        nonlocal free
        to[k] = j
        loads[j] += units[k][0]
        free -= units[k][0]

    for k in sorted(range(len(units)), key=lambda k: (-units[k][0], k)):
        size, i = units[k]
        j, room = home.get(i), [t - n for t, n in zip(targets, loads)]
        if j is not None and size <= room[j]:
            put(k, j)
        elif size <= max((t for t, n in zip(targets, loads) if t > n), default=0):
            homeless.append(k)
        else:
            most = max(room)
            put(k, j if j is not None and room[j] + 1 >= most else room.index(most))
            targets = levelled(loads, shares, free)
    for k in homeless:
        size = units[k][0]
        room = [t - n for t, n in zip(targets, loads)]
        spare = [r - (small[adopted[j]] if j in adopted else 0) for j, r in enumerate(room)]
        most = max(spare)
        if size <= most:
            put(k, spare.index(most))
        else:
            fits = size <= max(room)
            put(k, room.index(max(room)))
            if not fits:
                targets = levelled(loads, shares, free)
    return to, loads, levelled(loads, shares, free)


def transfers(old: list[int], new: list[int], adopted: dict[int, int] | None = None) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
    """Old sizes and new capacities (of the same sum) to ``adopted`` (new -> old, if not given) and arcs (old, new, bytes).

    The arcs move the fewest bytes; an old shard's first arc is what stays.
    """
    adopted = adoption(old, new) if adopted is None else adopted
    net, source, hub = FlowNetwork(len(old) + len(new) + 3), len(old) + len(new), len(old) + len(new) + 1
    sink = hub + 1
    for i, size in enumerate(old):
        net.edge(source, i, size, 0)
    stay = {(i, j): net.edge(i, len(old) + j, old[i], 0) for j, i in adopted.items()}
    leave = [net.edge(i, hub, old[i], 1) for i in range(len(old))]
    enter = [net.edge(hub, len(old) + j, new[j], 0) for j in range(len(new))]
    for j, size in enumerate(new):
        net.edge(len(old) + j, sink, size, 0)
    net.solve(source, sink)
    arcs = [(i, j, net.room[e ^ 1]) for (i, j), e in sorted(stay.items()) if net.room[e ^ 1]]
    gives = [[i, net.room[e ^ 1]] for i, e in enumerate(leave) if net.room[e ^ 1]]
    for j, e in enumerate(enter):
        wants = net.room[e ^ 1]
        while wants:
            part = min(wants, gives[0][1])
            arcs.append((gives[0][0], j, part))
            wants -= part
            gives[0][1] -= part
            if not gives[0][1]:
                gives.pop(0)
    return adopted, arcs


def blocks_to_shards(blocks: list[tuple[int, int, int]], arcs: list[tuple[int, int, int]]) -> tuple[list, list]:
    """Lay the blocks (old, block, bytes) of each old shard along its arcs.

    Returns whole blocks (old, block, new) and cut ones (old, block, [(new, bytes), ...]).
    """
    along: dict[int, deque] = {}
    for i, j, size in arcs:
        along.setdefault(i, deque()).append([j, size])
    whole, cut = [], []
    for i, block, size in sorted(blocks):
        parts, way = [], along.get(i) or deque([[0, 0]])
        while size > way[0][1] and len(way) > 1:
            j, room = way.popleft()
            size -= room
            if room:
                parts.append((j, room))
        way[0][1] -= size
        parts.append((way[0][0], size))
        parts = [p for p in parts if p[1]] or parts
        if len(parts) == 1:
            whole.append((i, block, parts[0][0]))
        else:
            cut.append((i, block, parts))
    return whole, cut


def recut(over: list[int], whole: dict[tuple[int, int], int], sizes: dict[tuple[int, int], int], least: float) -> tuple[dict, dict]:
    """Whole blocks (old, block) that go from shards over their targets to those under: moved ones, and cut ones with their parts."""
    over, free = list(over), {}
    for block, j in sorted(whole.items(), key=lambda b: (sizes[b[0]], b[0])):
        free.setdefault(j, []).append((sizes[block], block))
    moved, cut, tried = {}, {}, set()
    while True:
        high = max((j for j in range(len(over)) if j not in tried), key=lambda j: over[j], default=None)
        low = min(range(len(over)), key=lambda j: over[j])
        if high is None or min(over[high], -over[low]) <= least:
            return moved, cut
        if not free.get(high):
            tried.add(high)
            continue
        give = min(over[high], -over[low])
        k = bisect_right(free[high], give, key=lambda b: b[0])
        size, block = free[high].pop(max(0, k - 1))
        if size <= give:
            moved[block], give = low, size
        else:
            cut[block] = [(low, give), (high, size - give)]
        over[high] -= give
        over[low] += give


def even_out(totals: list[int], offered: dict[int, list[tuple[int, object]]], targets: list[int]) -> list[tuple[object, int, int]]:
    """Moves (key, from, to) of offered documents (size, key) that bring the totals closer to the targets."""
    over = [a - b for a, b in zip(totals, targets)]
    offered = {j: sorted(docs, key=lambda d: d[0]) for j, docs in offered.items()}
    moves, tried = [], set()
    while True:
        high = max((j for j in range(len(over)) if j not in tried), key=lambda j: over[j], default=None)
        low = min(range(len(over)), key=lambda j: over[j], default=None)
        if high is None:
            return moves
        gap = over[high] - over[low]
        fits = [d for d in offered.get(high, []) if d[0] < gap]
        if not fits:
            tried.add(high)
            continue
        best = min(fits, key=lambda d: abs(2 * d[0] - gap))  # halves the gap at best
        offered[high].remove(best)
        over[high] -= best[0]
        over[low] += best[0]
        tried.discard(low)
        moves.append((best[1], high, low))


@dataclass
class Layout:
    """The old files, and which new shards take which old file over whole."""

    folder: str
    moved_bytes: int
    kept: dict[int, int]


def _unit(id_col: str, text_col: str) -> Column:
    """What stays together: the id, or without one the text."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("#"), F.md5(text_of(text_col))))


def _splitter(parts: dict[tuple[int, int], list[tuple[int, int]]]):
    """For one cut block: the largest documents first, each into the first part that still has room, the rest into the last."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        room = [list(p) for p in parts[int(rows["_old"].iloc[0]), int(rows["_block"].iloc[0])]]
        rows = rows.sort_values(["bytes", "_unit"], ascending=[False, True])
        target = []
        for size in rows["bytes"]:
            k = next((k for k, (_, left) in enumerate(room) if size <= left), len(room) - 1)
            room[k][1] -= size
            target.append(room[k][0])
        return rows.assign(shard=target)[["_unit", "_old", "_block", "bytes", "shard"]]

    return split


def reshard(
    df: DataFrame, folder: str, capacities: list[float] | int = SHARDS, old: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> Layout:
    """Write ``df`` below ``folder`` as ``shard=N`` folders of Parquet files with a ``slot`` column.

    ``capacities``: the number of equal shards, or each one's share.  ``old``:
    what names a row's present shard; the file it is read from if not given.
    """
    spark: SparkSession = df.sparkSession
    named = df.withColumn("__name", F.coalesce(old.cast("string") if old is not None else F.input_file_name(), F.lit("")))
    named = named.drop(*[c for c in df.columns if c.lower() in OWN]).withColumnRenamed("__name", "_name")
    df = named.drop("_name")
    shares = [1.0] * capacities if isinstance(capacities, int) else list(capacities)
    size = (F.octet_length(text_of(text_col)) + EXTRA).cast("bigint")
    small = stored(named.select("_name", _unit(id_col, text_col).alias("_unit"), size.alias("bytes")), "units")
    sizes = {r["_name"]: r["bytes"] for r in small.groupBy("_name").agg(F.sum("bytes").alias("bytes")).collect()}  # one row per old shard
    names = sorted(sizes)
    total = sum(sizes.values())
    adopted = adoption([sizes[n] for n in names], levelled([0] * len(shares), shares, total))
    step = max(1, min(block_bytes, total // (len(shares) * BLOCKS_PER_SHARD) + 1))
    olds = spark.createDataFrame([(n, i, max(1, sizes[n] // step)) for i, n in enumerate(names)], "_name string, _old int, _blocks long")
    block = F.pmod(F.xxhash64("_unit"), F.col("_blocks")).alias("_block")
    units = stored(
        small.join(F.broadcast(olds) if len(names) <= BROADCAST_BLOCKS else olds, "_name").select("_unit", "_old", block, "bytes")
        .groupBy("_unit", "_old", "_block").agg(F.sum("bytes").alias("bytes")), "blocks",
    )
    # units larger than a block: no more of them than blocks
    large = [tuple(r) for r in units.filter(F.col("bytes") > step).select("_unit", "_old", "_block", "bytes").collect()]
    large.sort(key=lambda r: (-r[3], r[:3]))
    to, loads, targets = place_large([(r[3], r[1]) for r in large], [sizes[n] for n in names], adopted, shares, total)
    large = [(*r, j) for r, j in zip(large, to)]
    small_units = units.filter(F.col("bytes") <= step)
    rest = [sizes[n] for n in names]
    for _, i, _, size, _ in large:
        rest[i] -= size
    _, arcs = transfers(rest, [t - n for t, n in zip(targets, loads)], adopted)
    held = {(r[0], r[1]): r[2] for r in small_units.groupBy("_old", "_block").agg(F.sum("bytes")).collect()}  # one row per block
    laid, cut = blocks_to_shards([(*b, size) for b, size in held.items()], arcs)
    whole = {(i, b): j for i, b, j in laid}

    def little(d: DataFrame) -> DataFrame:
        return F.broadcast(d) if len(held) <= BROADCAST_BLOCKS else d

    single_schema = "_unit string, _old int, _block long, bytes long, shard int"

    def documents_of(parts: dict) -> DataFrame:
        cut_df = spark.createDataFrame(list(parts), "_old int, _block long")
        return small_units.join(little(cut_df), ["_old", "_block"], "left_semi").groupBy("_old", "_block").applyInPandas(_splitter(parts), single_schema)

    split = stored(documents_of({(i, b): p for i, b, p in cut}).unionByName(spark.createDataFrame(large, single_schema)), "split")
    # even out with further blocks: the totals of whole ones are known here
    least, before = EVEN * total / max(1, len(shares)), None
    while True:
        totals = [0] * len(shares)
        for b, j in whole.items():
            totals[j] += held[b]
        for r in split.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
            totals[r["shard"]] += r["bytes"]
        over = [a - b for a, b in zip(totals, targets)]
        uneven = sum(abs(x) for x in over)
        if before is not None and uneven >= before:
            break
        before = uneven
        moved_blocks, cut_blocks = recut(over, whole, held, least)
        if not moved_blocks and not cut_blocks:
            break
        whole = {b: moved_blocks.get(b, j) for b, j in whole.items() if b not in cut_blocks}
        if cut_blocks:
            split = stored(split.unionByName(documents_of(cut_blocks)), "split")
    whole_df = spark.createDataFrame([(i, b, j) for (i, b), j in whole.items()], "_old int, _block long, shard int")
    placed = small_units.join(little(whole_df), ["_old", "_block"]).select("_unit", "_old", "_block", "bytes", "shard").unionByName(split)
    # even out with single documents
    power = F.floor(F.log2("bytes"))
    pick = Window.partitionBy("shard", power).orderBy(F.xxhash64("_unit"), "_unit", "_old")
    final: dict[tuple, int] = {}

    def moved_documents() -> DataFrame:
        return spark.createDataFrame([(*key, to) for key, to in final.items()], "_unit string, _old int, _block long, _to int")

    while True:
        now = placed
        if final:
            now = placed.join(F.broadcast(moved_documents()), ["_unit", "_old", "_block"], "left").withColumn("shard", F.coalesce("_to", "shard"))
        offered: dict[int, list] = {}
        for r in now.withColumn("_n", F.row_number().over(pick)).filter(F.col("_n") <= OFFERED).collect():
            offered.setdefault(r["shard"], []).append((r["bytes"], (r["_unit"], r["_old"], r["_block"])))
        bytes_of = {key: size for docs in offered.values() for size, key in docs}
        moves = even_out(totals, offered, targets)
        for key, a, b in moves:
            final[key] = b
            totals[a] -= bytes_of[key]
            totals[b] += bytes_of[key]
        if not moves or max(abs(a - b) for a, b in zip(totals, targets)) <= least:
            break
    moved_df = moved_documents()
    # where single documents go; everything else follows its block
    single = split.select("_unit", "_old", "_block", F.col("shard").alias("_single")).join(
        F.broadcast(moved_df), ["_unit", "_old", "_block"], "full"
    ).select("_unit", "_old", "_block", F.coalesce("_to", "_single").alias("_single"))
    single = stored(single, "single")
    full = named.withColumn("_unit", _unit(id_col, text_col)).join(F.broadcast(olds) if len(names) <= BROADCAST_BLOCKS else olds, "_name")
    full = full.select(*[F.col(f"`{c}`") for c in df.columns], "_unit", "_old", block)
    few = single.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    full = full.join(F.broadcast(single) if few else single, ["_unit", "_old", "_block"], "left").join(little(whole_df), ["_old", "_block"], "left")
    full = full.withColumn("shard", F.coalesce("_single", "shard"))
    # slots: rows before the (old, block) part of a shard, then by unit
    at_single = placed.join(F.broadcast(moved_df), ["_unit", "_old", "_block"], "left").withColumn("shard", F.coalesce("_to", "shard"))
    flows = at_single.groupBy("_old", "shard").agg(F.sum("bytes").alias("bytes")).collect()
    stays = {j: i for j, i in adopted.items()}
    moved = sum(r["bytes"] for r in flows if stays.get(r["shard"]) != r["_old"])
    into: dict[int, set] = {}
    outof: dict[int, set] = {}
    for r in flows:
        into.setdefault(r["shard"], set()).add(r["_old"])
        outof.setdefault(r["_old"], set()).add(r["shard"])
    kept = {j: i for j, i in adopted.items() if into.get(j) == {i} and outof.get(i) == {j}}
    changed = full.filter(~F.col("shard").isin(sorted(kept))) if kept else full
    inside = Window.partitionBy("shard", "_old", "_block").orderBy("_unit", text_col)
    changed = changed.withColumn("slot", F.row_number().over(inside).cast("bigint"))
    counts = small.join(F.broadcast(olds) if len(names) <= BROADCAST_BLOCKS else olds, "_name").select("_unit", "_old", block)
    counts = counts.join(F.broadcast(single) if few else single, ["_unit", "_old", "_block"], "left").join(little(whole_df), ["_old", "_block"], "left")
    counts = counts.groupBy(F.coalesce("_single", "shard").alias("shard"), "_old", "_block").agg(F.count(F.lit(1)).alias("n"))
    start = Window.partitionBy("shard").orderBy("_old", "_block")
    starts = stored(counts.select("shard", "_old", "_block", (F.sum("n").over(start) - F.col("n")).alias("_start")), "starts")
    out = changed.join(F.broadcast(starts) if len(held) <= BROADCAST_BLOCKS else starts, ["shard", "_old", "_block"])
    out = out.withColumn("slot", F.col("slot") - 1 + F.col("_start"))
    out.select(*[F.col(f"`{c}`") for c in df.columns], "slot", "shard").write.partitionBy("shard").parquet(folder)
    return Layout(folder, moved, {j: names[i] for j, i in kept.items()})


def read_layout(df: DataFrame, layout: Layout, old: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the new layout with ``shard`` and ``slot``: written files, and old files that were kept."""
    spark = df.sparkSession
    own = df.withColumn("__name", F.coalesce(old.cast("string") if old is not None else F.input_file_name(), F.lit("")))
    own = own.drop(*[c for c in df.columns if c.lower() in OWN]).withColumnRenamed("__name", "_name")
    df = own.drop("_name")
    schema = T.StructType([*df.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(layout.folder)
    if not layout.kept:
        return rows
    names = F.create_map(*[F.lit(x) for j, n in layout.kept.items() for x in (n, j)])
    own = own.withColumn("shard", F.element_at(names, F.col("_name"))).filter("shard IS NOT NULL")
    order = Window.partitionBy("shard").orderBy(_unit(id_col, text_col), text_col)
    own = own.withColumn("slot", (F.row_number().over(order) - 1).cast("bigint")).drop("_name")
    return rows.unionByName(own.select(*rows.columns))
