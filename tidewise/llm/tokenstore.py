"""Token ids as raw binary shards with a minimal perfect hash index (operator 1).

Format.  A store is a folder with ``manifest.json`` and, per shard, two files:

* ``payload-NNNNN.bin``: the ids of the shard's documents in ascending key
  order, one after the other, little-endian, 2 bytes each if the vocabulary
  allows and else 4;
* ``index-NNNNN.mph``: a JSON header line and arrays: the bit levels of a minimal
  perfect hash over the shard's distinct keys with their running ranks, and in
  the order of that hash a 32-bit fingerprint, the first document and the number
  of documents of the key; then the documents' offsets in the payload.

A key is found by its shard (the manifest holds each shard's first key), one
probe per hash level (1.6 on average, whatever the number of keys), a compare of
the fingerprint and one read of the payload range.  A foreign key passes the
fingerprint with probability 2**-32.

Each task writes its shard's files under a name of its own attempt and renames
them when they are whole, so a lost executor leaves nothing half done.  Files
are opened through ``pyarrow.fs``, so the folder may be on any store it knows.

Defined results: a null or empty text is the end id alone; null keys come first
and are found under ``None``; documents that share a key lie side by side
(ordered by text) and are found together; an empty table gives a store
without shards; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions_for
from .common import text_of
from .tokens import encoder
from .wordhash import mix

GAMMA, LEVELS = 2.0, 64


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _publish(path: str, write: Callable) -> None:
    """Write a file under this attempt's own name, then rename it."""
    where, at = file_system(path)
    task = TaskContext.get()
    draft = f"{at}.{task.taskAttemptId() if task else 'driver'}.tmp"
    with where.open_output_stream(draft) as out:
        write(out)
    where.move(draft, at)


def key_hashes(keys: list) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes per key (integer, string or None)."""
    if all(isinstance(k, int) for k in keys):
        x = np.array(keys, np.int64).view(np.uint64)
        return mix(x + np.uint64(0x1234567)), mix(x ^ np.uint64(0x9E3779B97F4A7C15))
    raw = b"".join(hashlib.blake2b(repr(k).encode(), digest_size=16).digest() for k in keys)
    pairs = np.frombuffer(raw, "<u8").reshape(-1, 2)
    ints = np.array([isinstance(k, int) for k in keys], bool)
    if ints.any():
        x = np.array([k if isinstance(k, int) else 0 for k in keys], np.int64).view(np.uint64)
        own = np.stack([mix(x + np.uint64(0x1234567)), mix(x ^ np.uint64(0x9E3779B97F4A7C15))], axis=1)
        pairs = np.where(ints[:, None], own, pairs)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _probe(one: np.ndarray, two: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix(one + two * np.uint64(2 * level + 1)) % np.uint64(bits)).astype(np.int64)


def fingerprints(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (mix(one ^ (two << np.uint64(7))) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash: a key's slot is the rank of its bit in the first level where it is alone."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # arrays of 64-bit words
        self.ranks, total = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.size = total

    @classmethod
    def build(cls, one: np.ndarray, two: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(one):
            if len(levels) == LEVELS:
                raise ValueError("two different keys have the same 128-bit hash")
            bits = 64 * max(1, int(np.ceil(GAMMA * len(one) / 64)))
            at = _probe(one, two, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            again = ~alone[at]
            one, two = one[again], two[again]
        return cls(levels)

    def slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some of the keys that are not in it."""
        out, todo = np.full(len(one), -1, np.int64), np.arange(len(one))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = _probe(one[todo], two[todo], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (ranks[at >> 6] + below)[hit]
            todo = todo[~hit]
        return out


class ShardIndex:
    """Keys of one shard to their documents and payload ranges."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, first: np.ndarray, count: np.ndarray, offsets: np.ndarray):
        self.hash, self.prints, self.first, self.count, self.offsets = hash_, prints, first, count, offsets

    @classmethod
    def build(cls, keys: list, lengths: np.ndarray) -> ShardIndex:
        """``keys`` in order, equal ones side by side; ``lengths`` in ids."""
        first = np.array([k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1] or (keys[k] is None) != (keys[k - 1] is None)], np.int64)
        one, two = key_hashes([keys[k] for k in first])
        hash_ = PerfectHash.build(one, two)
        slot, n = hash_.slots(one, two), np.diff(np.append(first, len(keys)))
        prints, at, count = np.zeros(len(first), np.uint32), np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        prints[slot], at[slot], count[slot] = fingerprints(one, two), first, n
        return cls(hash_, prints, at, count, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))

    def write(self, out) -> None:
        head = {"format": "tidewise token index 1", "levels": [len(x) for x in self.hash.levels], "keys": len(self.prints), "documents": len(self.offsets) - 1}
        out.write(json.dumps(head).encode() + b"\n")
        for array, kind in [*((x, "<u8") for x in self.hash.levels), (self.prints, "<u4"), (self.first, "<i8"), (self.count, "<i8"), (self.offsets, "<i8")]:
            out.write(array.astype(kind).tobytes())

    @classmethod
    def read(cls, raw: bytes) -> ShardIndex:
        at = raw.index(b"\n") + 1
        head = json.loads(raw[:at])

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(raw, kind, n, at)
            at += got.nbytes
            return got

        levels = [take(n, "<u8").astype(np.uint64) for n in head["levels"]]
        n = head["keys"]
        return cls(PerfectHash(levels), take(n, "<u4"), take(n, "<i8"), take(n, "<i8"), take(head["documents"] + 1, "<i8"))

    def find(self, keys: list) -> np.ndarray:
        """Slots of the keys, -1 for keys the shard does not hold."""
        one, two = key_hashes(keys)
        slot = self.hash.slots(one, two)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprints(one[known], two[known])
        return np.where(known, slot, -1)


def _shard_writer(folder: str, tokenizer: str, end_id: int, width: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, lengths = TaskContext.get().partitionId(), [], []

        def payload(out) -> None:
            for batch in batches:
                open_row = 0  # ids so far of a very long text
                keys.extend(batch.column(0).to_pylist())
                for first, last, ids, counts, more in encoder(tokenizer, end_id).runs(batch.column(1)):
                    out.write(ids.astype(f"<u{width}").tobytes())
                    counts = counts.copy()
                    counts[0] += open_row
                    open_row = int(counts[-1]) if more else 0
                    if not more:
                        lengths.append(counts)

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for part in ([first], rest) for b in part)
        _publish(f"{folder}/payload-{shard:05d}.bin", payload)
        if not keys:
            return
        index = ShardIndex.build(keys, np.concatenate(lengths))
        _publish(f"{folder}/index-{shard:05d}.mph", index.write)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "documents": len(keys), "ids": int(index.offsets[-1]), "first_key": json.dumps(keys[0])}],
            schema=pa.schema([("shard", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64()), ("first_key", pa.string())]),
        )
    return write


def write_store(df: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> dict:
    """Write the store; returns its manifest.  The range sort spreads keys evenly over ``shards`` files."""
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    where, at = file_system(folder)
    where.create_dir(at, recursive=True)
    rows = df.select(F.col(id_col).alias("key"), text_of(text_col).alias("text"))
    key = F.col("key").asc_nulls_first()
    ordered = rows.repartitionByRange(shards or shuffle_partitions_for(rows), key).sortWithinPartitions(key, "text")
    done = ordered.mapInArrow(_shard_writer(folder, tokenizer, end_id, width), "shard int, documents long, ids long, first_key string").collect()
    made, start = [], 0
    for r in sorted(done, key=lambda r: r["shard"]):  # one row per shard
        made.append({"shard": r["shard"], "documents": r["documents"], "ids": r["ids"], "start": start, "first_key": json.loads(r["first_key"])})
        start += r["ids"]
    manifest = {"format": "tidewise token store 1", "width": width, "end_id": end_id, "ids": start, "shards": made}
    _publish(f"{folder}/manifest.json", lambda out: out.write(json.dumps(manifest).encode()))
    return manifest


class TokenStore:
    """Keyed access to a store."""

    def __init__(self, folder: str):
        self.folder = folder
        self.files, self.at = file_system(folder)
        with self.files.open_input_stream(f"{self.at}/manifest.json") as f:
            self.manifest = json.loads(f.read())
        self.shards = self.manifest["shards"]
        self.firsts = [self._order(s["first_key"]) for s in self.shards]
        self.held: dict[int, ShardIndex] = {}

    @staticmethod
    def _order(key):
        """Keys as Spark orders them: null first, strings by their bytes."""
        return (0, 0) if key is None else (2, key.encode()) if isinstance(key, str) else (1, key)

    def shard_of(self, key) -> int:
        """Position in the manifest of the only shard that may hold the key."""
        return max(0, bisect.bisect_right(self.firsts, self._order(key)) - 1)

    def index(self, n: int) -> ShardIndex:
        if n not in self.held:
            self.held = {}  # one shard's index at a time
            with self.files.open_input_stream(f"{self.at}/index-{self.shards[n]['shard']:05d}.mph") as f:
                self.held[n] = ShardIndex.read(f.read())
        return self.held[n]

    def documents(self, n: int, keys: list) -> Iterator[tuple[object, int, np.ndarray]]:
        """``key, start in the whole store, ids`` of the documents of ``keys`` in one shard; unknown keys give none."""
        index, width, base = self.index(n), self.manifest["width"], self.shards[n]["start"]
        with self.files.open_input_file(f"{self.at}/payload-{self.shards[n]['shard']:05d}.bin") as f:
            for key, slot in zip(keys, index.find(keys).tolist()):
                for k in range(int(index.first[slot]), int(index.first[slot] + index.count[slot])) if slot >= 0 else ():
                    a, b = int(index.offsets[k]), int(index.offsets[k + 1])
                    yield key, base + a, np.frombuffer(f.read_at((b - a) * width, a * width), f"<u{width}")

    def get(self, key) -> list[np.ndarray]:
        """The ids of every document with this key."""
        return [ids for _, _, ids in self.documents(self.shard_of(key), [key])] if self.shards else []


def read_documents(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Look up every key of the one-column frame ``keys``: ``doc_id, start, n_tokens, ids_crc32``, a row per document.

    Keys go to the task of their shard, which reads its index once and then
    the payload range of each key.
    """
    name, kind = keys.columns[0], keys.schema[0].dataType.simpleString()
    n = len(TokenStore(folder).shards)

    def route(batches):
        store = TokenStore(folder)
        for batch in batches:
            own = [store.shard_of(k) for k in batch.column(0).to_pylist()] if store.shards else [-1] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32())], ["doc_id", "shard"])

    def read(batches):
        store = TokenStore(folder)
        for batch in batches:
            shard, ids = batch.column(1).to_numpy(), batch.column(0).to_pylist()
            for at in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(shard)) + 1) if len(ids) else []:
                if shard[at[0]] < 0:
                    continue
                found = [(k, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for k, s, x in store.documents(int(shard[at[0]]), [ids[j] for j in at])]
                key, start, size, crc = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, batch.schema.field(0).type), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    routed = keys.select(F.col(name).alias("doc_id")).distinct().mapInArrow(route, f"doc_id {kind}, shard int")
    placed = routed.repartition(max(1, n), "shard").sortWithinPartitions("shard")
    return placed.mapInArrow(read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
