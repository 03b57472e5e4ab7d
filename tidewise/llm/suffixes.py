"""Removal of repeated passages by merging front-coded suffix runs (operator 13).

A byte goes if a string of ``window`` bytes that covers it also starts
anywhere else.  Sorting a suffix for every byte would move many times the corpus, so
suffixes start at *anchors*: of each window the place whose 8 bytes have the
smallest hash among its first ``spread`` places.  Equal windows have their anchor at
the same distance r from their start, and are equal exactly if the texts agree
for ``window - r`` bytes from the anchor on and for r bytes before it.

1. Anchors whose first ``window - spread + 1`` bytes are unique in the corpus cannot
   lie in a repeated window.  Their 64-bit hashes are exchanged as plain
   arrays, and only anchors with a repeated hash go on (a clash adds work, no result).
2. Each chunk of texts sorts its suffixes (the ``window`` bytes from the
   anchor, then the bytes before it backwards), keeps one of equal ones, and
   sends each task the run that belongs to it, front-coded: the length of the
   prefix shared with the suffix before, and the rest.
3. A task merges its runs with a loser tree that knows the prefix length each
   contender shares with the last winner: the longer one wins unseen, and only
   equal ones are compared, from that byte on.  The merged prefix lengths, and those of
   the order of the backward bytes, number for every r the classes of
   suffixes that agree far enough on either side: a window is repeated if its pair of classes
   occurs twice.
4. The verdicts go back to the chunks, which cut the texts.

Suffixes that share their first bytes meet in one task.  Where that would be
more than ``HOT`` of them (a passage that a great part of all texts share), they are replaced
by a suffix for every window, dealt by its whole content.  Texts move as compressed chunks of
about ``CHUNK`` bytes, equal texts of a chunk once.

Defined results: null text is empty; texts below ``window`` bytes keep
everything; an empty table gives an empty result; repeated rows are texts that
repeat, so both go whole if long enough; ids may be null, repeated or of any type;
very long texts are chunks of their own and scanned in slices; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .wordhash import mix

WINDOW, SPREAD = 200, 128
#: Bytes of texts in a chunk, places scanned at a time, suffixes sorted at a time.
CHUNK, SLICE, RUN = 8 << 20, 1 << 20, 1 << 16
#: Rows in a chunk.
ROWS = 1 << 17
#: Suffixes with equal first bytes beyond which they are dealt by window.
HOT = 1 << 16
#: Bytes of texts for each task that compares hashes, and that merges runs.
BYTES_A_TASK = 64 << 20
_PAD = 0xFF  # in no UTF-8 text
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HOT_BIT = np.uint32(1 << 31)


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


# --- chunks -----------------------------------------------------------------

def pack(rows: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Texts (id, text) as ``chunk, ids, which, ends, packed, n_bytes``: distinct texts one after the other, compressed."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId() << 32, 0
        known: dict[bytes, int] = {}
        ids, which, size = [], [], 0

        def chunk():
            data = b"".join(known)
            ends = np.cumsum([len(t) for t in known], dtype=np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([task + count], pa.int64()), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
                pa.array([np.array(which, np.int32).tobytes()], pa.binary()), pa.array([ends.tobytes()], pa.binary()),
                pa.array([_zip(data)], pa.binary()), pa.array([len(data)], pa.int64()),
            ], ["chunk", "ids", "which", "ends", "packed", "n_bytes"])

        for batch in batches:
            texts, first = batch.column(1), 0
            for k in range(len(texts)):
                text = texts[k].as_buffer().to_pybytes()
                at = known.setdefault(text, len(known))
                if at == len(known) - 1:
                    size += len(text)  # a repeated last text counts again, which only ends the chunk sooner
                which.append(at)
                if size >= chunk_bytes or len(which) >= ROWS:
                    ids.append(batch.column(0).slice(first, k + 1 - first))
                    yield chunk()
                    known, ids, which, size, count, first = {}, [], [], 0, count + 1, k + 1
            if first < len(texts):
                ids.append(batch.column(0).slice(first))
        if which:
            yield chunk()

    return rows.mapInArrow(run, f"chunk long, ids array<{kind}>, which binary, ends binary, packed binary, n_bytes long")


# --- anchors ----------------------------------------------------------------

def anchors(data: np.ndarray, ends: np.ndarray, window: int, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in order, and the first and last start of the windows that each belongs to."""
    starts = np.concatenate([[0], ends[:-1]])
    stops = ends - window + 1
    long = stops > starts
    starts, stops = starts[long], stops[long]
    places, low, high = [], [], []
    for at in range(0, len(data), SLICE):
        stop = min(len(data), at + SLICE)
        a, b = np.clip(starts, at, stop) - at, np.clip(stops, at, stop) - at
        change = np.zeros(stop - at + 1, np.int32)
        np.add.at(change, a[b > a], 1)
        np.add.at(change, b[b > a], -1)
        start = np.flatnonzero(np.cumsum(change[:-1]))
        if not len(start):
            continue
        x = data[at : stop + spread + 7].astype(np.uint64)
        x = x[:-1] | x[1:] << np.uint64(8)
        x = x[:-2] | x[2:] << np.uint64(16)
        x = x[:-4] | x[4:] << np.uint64(32)
        x *= _ODD
        x &= np.uint64(0xFFFFFFFF00000000)
        x |= np.arange(len(x), dtype=np.uint64)  # equal hashes: the first place
        step = 1
        while step < spread:
            x = np.minimum(x[:-step], x[step:])
            step *= 2
        place = (x[start] & np.uint64(0xFFFFFFFF)).astype(np.int64) + at
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        places.append(place[new])
        low.append(start[new] + at)
        high.append(start[np.concatenate([new[1:], [len(start)]]) - 1] + at)
    if not places:
        return (np.zeros(0, np.int64),) * 3
    places, low, high = np.concatenate(places), np.concatenate(low), np.concatenate(high)
    new = np.concatenate([[True], places[1:] != places[:-1]])  # one anchor may go on in the next slice
    last = np.concatenate([new[1:], [True]])
    return places[new], low[new], high[last]


def _hashes(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of ``length`` bytes from each place on."""
    out = np.full(len(places), length, np.uint64)
    for at in range(0, len(places), 1 << 14):
        part = places[at : at + (1 << 14)]
        held = np.zeros((len(part), -(-length // 8) * 8), np.uint8)
        held[:, :length] = data[part[:, None] + np.arange(length)]
        for word in held.view(np.uint64).T:
            out[at : at + len(part)] = mix((out[at : at + len(part)] + word) * _ODD)
    return out


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(_unzip(row["packed"]), np.uint8), np.frombuffer(row["ends"], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _by_target(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(target[part[0]]), part


def repeated_anchors(chunks: DataFrame, window: int, spread: int, tasks: int, hot: int) -> DataFrame:
    """``chunk, repeated``: the numbers of a chunk's anchors whose first bytes have a hash that occurs more than once.

    The highest bit tells that it occurs more than ``hot`` times.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for row in _rows(batches):
                data, ends = _opened(row)
                h = _hashes(data, anchors(data, ends, window, spread)[0], window - spread + 1)
                parts = [(t, h[p].tobytes(), p.astype(np.uint32).tobytes()) for t, p in _by_target((h >> np.uint64(8)) % np.uint64(tasks))]
                yield pa.RecordBatch.from_arrays([
                    pa.array([t for t, _, _ in parts], pa.int32()), pa.array([row["chunk"]] * len(parts), pa.int64()),
                    pa.array([x for _, x, _ in parts], pa.binary()), pa.array([x for _, _, x in parts], pa.binary()),
                ], ["target", "chunk", "hashes", "numbers"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, hashes, numbers = [], [], []
        for batch in batches:
            chunk += batch.column(1).to_pylist()
            hashes += [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            numbers += [np.frombuffer(x, np.uint32) for x in batch.column(3).to_pylist()]
        if not chunk:
            return
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1], [True]]))
        count = np.empty(len(flat), np.int64)
        count[order] = np.repeat(np.diff(cuts), np.diff(cuts))
        at = 0
        found: dict[int, list] = {}
        for c, n in zip(chunk, numbers):
            own = count[at : at + len(n)]
            at += len(n)
            found.setdefault(c, []).append((n | np.where(own > hot, _HOT_BIT, np.uint32(0)))[own > 1])
        for c, parts in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([np.concatenate(parts).tobytes()], pa.binary())], ["chunk", "repeated"])

    sent = chunks.select("chunk", "packed", "ends").mapInArrow(send, "target int, chunk long, hashes binary, numbers binary")
    told = sent.repartitionById(tasks, F.col("target")).mapInArrow(compare, "chunk long, repeated binary")
    return told.groupBy("chunk").agg(F.collect_list("repeated").alias("repeated"))


# --- sorted runs ------------------------------------------------------------

def _keys(data: np.ndarray, ends: np.ndarray, places: np.ndarray, dense: np.ndarray, window: int, spread: int) -> np.ndarray:
    """One row of bytes for each suffix: kind, ``window`` bytes on, ``spread - 1`` bytes back (none for ``dense``)."""
    out = np.full((len(places), window + spread), _PAD, np.uint8)
    out[:, 0] = dense
    doc = np.searchsorted(ends, places, "right")
    stop, start = ends[doc], np.where(doc > 0, ends[doc - 1], 0)
    for at in range(0, len(places), 1 << 13):
        part = slice(at, at + (1 << 13))
        on = places[part, None] + np.arange(window)
        back = places[part, None] - 1 - np.arange(spread - 1)
        out[part, 1 : window + 1] = np.where(on < stop[part, None], data[np.minimum(on, len(data) - 1)], _PAD)
        out[part, window + 1 :] = np.where((back >= start[part, None]) & ~dense[part, None], data[np.maximum(back, 0)], _PAD)
    return out


def shared(keys: np.ndarray) -> np.ndarray:
    """The prefix length that each row of bytes shares with the row before (0 for the first)."""
    out = np.zeros(len(keys), np.int64)
    for at in range(1, len(keys), 1 << 14):
        differ = keys[at : at + (1 << 14)] != keys[at - 1 : min(len(keys), at + (1 << 14)) - 1]
        out[at : at + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
    return out


class Suffixes:
    """The suffixes that a chunk sends, in slices that are sorted one by one."""

    def __init__(self, row: dict, window: int, spread: int, tasks: int):
        self.window, self.spread, self.tasks = window, spread, tasks
        self.data, self.ends = _opened(row)
        places, low, high = anchors(self.data, self.ends, window, spread)
        told = np.sort(np.concatenate([np.frombuffer(x, np.uint32) for x in row["repeated"] or []] or [np.zeros(0, np.uint32)]))
        number = (told & ~_HOT_BIT).astype(np.int64)
        plain = number[told < _HOT_BIT]
        hot = number[told >= _HOT_BIT]
        # of a hot anchor every window's start
        size = high[hot] - low[hot] + 1
        start = np.repeat(low[hot] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.places, self.low, self.high = np.concatenate([places[plain], start]), np.concatenate([low[plain], start]), np.concatenate([high[plain], start])
        self.dense = np.arange(len(self.places)) >= len(plain)

    def runs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each slice: number of its first distinct suffix, its rows, each row's distinct suffix, and sorted by task
        the distinct suffixes' tasks, counts and bytes."""
        base = 0
        for at in range(0, len(self.places), RUN):
            part = slice(at, at + RUN)
            dense, places = self.dense[part], self.places[part]
            target = np.empty(len(places), np.uint64)
            for kind, length in ((False, self.window - self.spread + 1), (True, self.window)):
                target[dense == kind] = _hashes(self.data, places[dense == kind], length)
            target = ((target >> np.uint64(8)) % np.uint64(self.tasks)).astype(">u4")
            keys = np.concatenate([target.view(np.uint8).reshape(-1, 4), _keys(self.data, self.ends, places, dense, self.window, self.spread)], axis=1)
            order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
            keys = keys[order]
            new = shared(keys) < keys.shape[1]
            new[:1] = True
            distinct = np.empty(len(order), np.int64)
            distinct[order] = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            counts = np.diff(np.concatenate([first, [len(order)]]))
            yield base, np.arange(at, at + len(order)), distinct + base, target[order][first].astype(np.int64), counts, keys[first, 4:]
            base += len(first)


def front_coded(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted rows of bytes as shared prefix lengths, whether each stands for several, and the rest of each."""
    common = shared(keys)
    rest = keys[np.arange(keys.shape[1]) >= common[:, None]]
    return _zip(common.astype(np.uint16).tobytes() + (counts > 1).astype(np.uint8).tobytes() + rest.tobytes())


def decoded(blob: bytes, n: int, width: int) -> tuple[list[bytes], list[int], np.ndarray]:
    """Rows, shared prefix lengths and whether each stands for several."""
    raw = _unzip(blob)
    common = np.frombuffer(raw, np.uint16, n).tolist()
    rows, at, row = [], 3 * n, b""
    for c in common:
        row = row[:c] + raw[at : at + width - c]
        at += width - c
        rows.append(row)
    return rows, common, np.frombuffer(raw, np.uint8, n, 2 * n)


def merged(runs: list[tuple[list[bytes], list[int]]], width: int) -> Iterator[tuple[int, int, int]]:
    """Loser tree over sorted runs: ``run, position, prefix shared with the row before`` in order.

    ``held[r]`` is the prefix that run r's next row shares with the last winner (-1: run at its end).  Of two
    contenders the one that shares more is smaller; if both share as much, bytes are compared from there on, and
    the loser's prefix is then the one shared with its winner.
    """
    size = 1
    while size < len(runs):
        size *= 2
    held = [0 if r < len(runs) and runs[r][0] else -1 for r in range(size)]
    rows = [r for r, _ in runs] + [[]] * (size - len(runs))
    common = [c for _, c in runs] + [[]] * (size - len(runs))
    at, lens = [0] * size, [len(r) for r in rows]
    tree = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = held[a], held[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        p, q = rows[a][at[a]], rows[b][at[b]]
        if x < width and p[x] == q[x]:
            differ = int.from_bytes(p[x:], "big") ^ int.from_bytes(q[x:], "big")
            x = width - (differ.bit_length() + 7) // 8
        a, b = (b, a) if p > q else (a, b)
        held[b] = x
        return a, b

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    win = winners[1]
    while held[win] >= 0:
        k = at[win]
        yield win, k, held[win]
        k += 1
        at[win] = k
        held[win] = common[win][k] if k < lens[win] else -1
        node = (win + size) >> 1
        while node:
            other = tree[node]
            x, y = held[other], held[win]
            if x > y:
                tree[node], win = win, other
            elif x == y and x >= 0:
                win, tree[node] = play(win, other)
            node >>= 1


def repeated_windows(keys: np.ndarray, common: np.ndarray, several: np.ndarray, window: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted suffixes with the prefix lengths they share: whether the whole suffix occurs more than once, and the
    bits of the r for which the window that starts r bytes before occurs more than once."""
    width = window + spread
    new = common < width
    new[:1] = True
    group = np.cumsum(new) - 1
    whole = np.bincount(group, several + 1) > 1
    first = np.flatnonzero(new)
    bits = np.zeros((len(first), spread), bool)
    bits[whole] = True
    # those that share enough to matter with another one
    on = np.minimum(common[first] - 1, window)
    near = on >= window - spread + 1
    near[:1] = False
    use = np.flatnonzero(near | np.concatenate([near[1:], [False]]))
    if len(use) > 1:
        ahead, back = on[use], keys[first[use], window + 1 :]
        order = np.argsort(np.ascontiguousarray(back).view(f"S{spread - 1}").ravel(), kind="stable")
        behind = shared(back[order])
        side = np.empty(len(use), np.int64)
        for r in range(spread):
            side[order] = np.cumsum(behind < r)
            pair = np.cumsum(ahead < window - r) * (len(use) + 1) + side
            by = np.argsort(pair, kind="stable")
            same = pair[by][1:] == pair[by][:-1]
            twice = np.zeros(len(use), bool)
            twice[by[1:]] |= same
            twice[by[:-1]] |= same
            bits[use, r] |= twice
    return whole[group], np.packbits(bits, axis=1)[group]


def verdicts(chunks: DataFrame, window: int, spread: int, tasks: int) -> DataFrame:
    """``chunk, verdict``: the numbers of a chunk's distinct suffixes that repeat whole, and of others with their windows that do."""
    width = window + spread

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for row in _rows(batches):
                for base, _, _, target, counts, keys in Suffixes(row, window, spread, tasks).runs():
                    parts = [(t, base + int(p[0]), len(p), front_coded(keys[p], counts[p])) for t, p in _by_target(target)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p[0] for p in parts], pa.int32()), pa.array([row["chunk"]] * len(parts), pa.int64()),
                        pa.array([p[1] for p in parts], pa.int64()), pa.array([p[2] for p in parts], pa.int64()), pa.array([p[3] for p in parts], pa.binary()),
                    ], ["target", "chunk", "first", "n", "run"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for row in _rows(batches):
            found.setdefault(row["target"], []).append(row)
        for own in found.values():
            runs = [decoded(r["run"], r["n"], width) for r in own]
            order = np.array(list(merged([r[:2] for r in runs], width)), np.int64).reshape(-1, 3)
            source, at, common = order.T
            keys = np.frombuffer(b"".join(runs[s][0][k] for s, k in zip(source.tolist(), at.tolist())), np.uint8).reshape(-1, width)
            start = np.cumsum([0] + [len(r[0]) for r in runs])[:-1]
            several = np.concatenate([r[2] for r in runs])[start[source] + at].astype(np.int64)
            whole, bits = repeated_windows(keys, common, several, window, spread)
            part = ~whole & bits.any(axis=1)
            number = np.array([r["first"] for r in own])[source] + at
            for s, r in enumerate(own):
                w, p = np.flatnonzero((source == s) & whole), np.flatnonzero((source == s) & part)
                if len(w) or len(p):
                    blob = np.array([len(w)], np.int64).tobytes() + number[w].tobytes() + number[p].tobytes() + bits[p].tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([r["chunk"]], pa.int64()), pa.array([_zip(blob)], pa.binary())], ["chunk", "verdict"])

    sent = chunks.select("chunk", "packed", "ends", "repeated").mapInArrow(send, "target int, chunk long, first long, n long, run binary")
    told = sent.repartitionById(tasks, F.col("target")).mapInArrow(merge, "chunk long, verdict binary")
    return told.groupBy("chunk").agg(F.collect_list("verdict").alias("verdict"))


# --- cutting ----------------------------------------------------------------

def _covered(row: dict, window: int, spread: int, tasks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the chunk's texts, ends of the texts, and whether each byte lies in a repeated window."""
    chunk = Suffixes(row, window, spread, tasks)
    change = np.zeros(len(chunk.data) + 1, np.int32)
    whole, part, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, spread // 8), np.uint8)]
    for blob in row["verdict"] or []:
        raw = _unzip(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        m = (len(raw) - 8 - 8 * n) // (8 + spread // 8)
        whole.append(np.frombuffer(raw, np.int64, n, 8))
        part.append(np.frombuffer(raw, np.int64, m, 8 + 8 * n))
        bits.append(np.frombuffer(raw, np.uint8, m * (spread // 8), 8 + 8 * (n + m)).reshape(m, spread // 8))
    whole, part, bits = np.concatenate(whole), np.concatenate(part), np.concatenate(bits)
    order = np.argsort(part)
    part, bits = part[order], bits[order]
    if len(whole) or len(part):
        for _, rows, distinct, *_ in chunk.runs():
            full = rows[np.isin(distinct, whole)]
            np.add.at(change, chunk.low[full], 1)
            np.add.at(change, chunk.high[full] + window, -1)
            if len(part):
                at = np.minimum(np.searchsorted(part, distinct), len(part) - 1)
                some = part[at] == distinct
                which, r = np.nonzero(np.unpackbits(bits[at[some]], axis=1))
                which = rows[some][which]
                start = chunk.places[which] - r
                ok = (start >= chunk.low[which]) & (start <= chunk.high[which])
                np.add.at(change, start[ok], 1)
                np.add.at(change, start[ok] + window, -1)
    return chunk.data, chunk.ends, np.cumsum(change[:-1]) > 0


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, spread: int = SPREAD,
                    chunk_bytes: int = CHUNK, hot: int = HOT, bytes_a_task: int = BYTES_A_TASK) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, removed`` (array of start and end of the cut bytes) and ``kept`` (the bytes left).

    ``spread`` is a power of two, with ``spread + 7 <= window``; a larger one means fewer suffixes and longer ones.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = stored(pack(rows, chunk_bytes), "chunks")
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_a_task))
    repeated = stored(repeated_anchors(chunks, window, spread, tasks, hot), "repeated")
    texts = chunks.join(repeated, "chunk", "left")
    found = stored(verdicts(texts.filter("repeated IS NOT NULL"), window, spread, tasks), "verdicts")
    kind = dict(rows.dtypes)["id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        with np.errstate(over="ignore"):
            for batch in batches:
                for k in range(batch.num_rows):
                    one = batch.slice(k, 1)
                    row = one.select(["packed", "ends", "repeated", "verdict"]).to_pylist()[0]
                    ids, which = one.column("ids")[0].values, np.frombuffer(one.column("which")[0].as_py(), np.int32)
                    data, ends, gone = _covered(row, window, spread, tasks)
                    starts = np.concatenate([[0], ends[:-1]])
                    for t in np.flatnonzero((np.bincount(which, minlength=len(ends)) > 1) & (ends - starts >= window)):
                        gone[starts[t] : ends[t]] = True  # equal texts of the chunk
                    for at in range(0, len(which), 512):
                        removed, kept, sizes = [], [], []
                        for t in which[at : at + 512].tolist():
                            own = gone[starts[t] : ends[t]]
                            edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                            removed.append([{"start": a, "stop": b} for a, b in edge.reshape(-1, 2).tolist()])
                            kept.append(data[starts[t] : ends[t]][~own].tobytes())
                            sizes.append(len(own))
                        yield pa.RecordBatch.from_arrays(
                            [ids.slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())],
                            ["doc_id", "n_bytes", "removed", "kept"],
                        )

    texts = texts.join(found, "chunk", "left").select("ids", "which", "ends", "packed", "repeated", "verdict")
    return texts.mapInArrow(cut, f"doc_id {kind}, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary")
