"""Packing documents into training sequences by minimum bin slack (operator 10).

Texts are tokenised, closed by an end id and cut into pieces of at most
``capacity`` ids (only longer documents are cut).  Pieces differ for packing
only in their length, so the table is reduced to a histogram of at most
``capacity`` rows, whatever its size.  The driver packs that histogram: each bin
starts with the longest length left, a bitset subset-sum recurrence over the
available lengths finds the fullest feasible combination, and it is removed, as
often as the counts allow (the combination stays the fullest one while they do).
Some length can no longer be taken that often after each step, so there are at
most sum(capacity / length), about 16,000 for 2,048, different combinations.

Every piece is then placed where it lies: its rank among the pieces of its
length (a count inside its task plus the counts of the tasks before) tells the
sequence and offset, without gathering any group.

Defined results: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; a null id is carried; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored, text_of
from .tokens import encoder
from .wordhash import tidied

CAPACITY = 2048


def fullest(room: int, lengths: dict[int, int]) -> dict[int, int]:
    """The multiset of ``lengths`` (length -> how many there are) with the largest sum up to ``room``."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((x for x in lengths if x <= room), reverse=True):
        left, k = min(lengths[length], room // length), 1
        while left:
            k = min(k, left)
            now = (reach | reach << k * length) & mask
            if now != reach:
                steps.append((length, k, reach))
            reach, left, k = now, left - k, 2 * k
        if reach >> room:
            break
    at, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            at -= k * length
            taken[length] = taken.get(length, 0) + k
    return taken


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations (length -> how many in one bin), each with the number of bins that hold it."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        bin_ = fullest(capacity - longest, rest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[length] // n for length, n in bin_.items())
        out.append((bin_, times))
        for length, n in bin_.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


def places(bins: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, first sequence, number in one bin, offset in the bin), by rank."""
    ranks: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for bin_, times in bins:
        offset = 0
        for length in sorted(bin_, reverse=True):
            n, rank = bin_[length], ranks.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, n, offset))
            ranks[length] = rank + n * times
            offset += n * length
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


_PIECES = "part int, doc_id {id}, piece int, start long, length long, ids_crc32 long, local long"


def _cut(tokenizer: str, end_id: int, capacity: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            held, done = np.zeros(0, np.uint32), 0  # of a very long text: ids not yet cut, pieces so far
            for first, last, ids, counts, more in encoder(tokenizer, end_id).runs(batch.column(1)):
                ends = np.cumsum(counts)
                for k in range(last - first):
                    own = ids[ends[k] - counts[k] : ends[k]]
                    if len(held):
                        own = np.concatenate([held, own])
                    whole = len(own) - len(own) % capacity if more else len(own)
                    for at in range(0, whole, capacity):
                        piece = own[at : min(at + capacity, whole)]
                        rows.append(first + k)
                        numbers.append(done)
                        starts.append(done * capacity)
                        lengths.append(len(piece))
                        sums.append(zlib.crc32(piece.astype("<u4").tobytes()))
                        done += 1
                    held = own[whole:]
                    if not more:
                        done = 0
            size = np.array(lengths, np.int64)
            order = np.argsort(size, kind="stable")
            local = np.empty(len(size), np.int64)
            local[order] = np.arange(len(size)) - np.searchsorted(size[order], size[order])
            local += seen[size]
            seen += np.bincount(size, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(size), part, np.int32)), batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(size), pa.array(sums, pa.int64()), pa.array(local),
                ],
                ["part", "doc_id", "piece", "start", "length", "ids_crc32", "local"],
            )
    return cut


def _place(table: dict[int, np.ndarray]) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(size) else []:
                rows, own = table[int(size[at[0]])], rank[at]
                hit = rows[np.searchsorted(rows[:, 0], own, "right") - 1]
                nth = own - hit[:, 0]
                sequence[at] = hit[:, 1] + nth // hit[:, 2]
                offset[at] = hit[:, 3] + nth % hit[:, 2] * size[at[0]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])
    return place


def pack(df: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer``: path of a ``tokenizers`` file that every worker can open.
    """
    id_type = df.select(id_col).schema[0].dataType.simpleString()
    rows = df.select(F.col(id_col), text_of(text_col))
    with small_batches(df.sparkSession):
        pieces = stored(rows.mapInArrow(tidied(_cut(tokenizer, end_id, capacity)), _PIECES.format(id=id_type)), "pieces")
    sizes = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = places(pack_histogram(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part")
    earlier = sizes.select("part", "length", (F.sum("n").over(before) - F.col("n")).alias("before"))
    ranked = pieces.join(earlier, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local")).drop("part", "local", "before")
    return ranked.mapInArrow(
        tidied(_place(table)), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
