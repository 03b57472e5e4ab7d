"""Words of whole batches of texts as 64-bit numbers (NumPy, inside tasks).

A word's hash is a polynomial over its bytes, taken from one running sum over
the batch: with ``S[i] = sum of T[byte] * P**i`` a word from ``s`` to ``e`` has
``(S[e] - S[s]) / P**s``, then mixed.  Texts are cut into runs of about
``SLICE`` bytes at white space, so memory does not grow with a text's length.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def worker_cache(key, make: Callable):
    """An object kept for the life of the Python worker, across its tasks."""
    held = sys.modules.setdefault("_tidewise_llm_worker", types.ModuleType("_tidewise_llm_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def worker_serves(operator: str) -> None:
    """Drop what another operator's steps have left in the worker: it would lie there beside this one's."""
    held = sys.modules.setdefault("_tidewise_llm_worker", types.ModuleType("_tidewise_llm_worker")).__dict__
    if held.get("serves") != operator:
        for key in [k for k in held if not (isinstance(k, str) and k.startswith("__"))]:
            del held[key]
        held["serves"] = operator


def give_back() -> None:
    """Freed memory goes back to the system; a reused worker would hold it between its tasks."""
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):  # glibc
        library.malloc_trim(0)


def tidied(step: Callable) -> Callable:
    """``step`` (batches to batches), before which the worker drops what other operators have left and after which it gives back what it has freed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_serves(step.__module__)
        try:
            yield from step(batches)
        finally:
            give_back()
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD[0]) + np.uint64(seed * 0x1000193 + 77))


#: ASCII white space by byte.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers and inverse powers of a hash's base, for runs of up to some length."""

    def __init__(self, base: int, n: int):
        inverse = pow(base, -1, 1 << 64)
        self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (base, inverse))


class Tables:
    """Byte values of one of two independent hashes; the powers are shared by its forms."""

    def __init__(self, which: int, lower: bool):
        self.byte = stream(11 + which, 256)
        if lower:
            self.byte[65:91] = self.byte[97:123]
        self.base = (_ODD[which] | 5) % (1 << 64)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        powers = worker_cache(("powers", self.base), lambda: Powers(self.base, SLICE + 4096))
        if len(data) >= len(powers.up):
            powers = Powers(self.base, len(data))  # one very long word; not kept
        run = self.byte[data]
        run *= powers.up[: len(data)]
        np.cumsum(run, out=run)
        run = np.concatenate([np.zeros(1, np.uint64), run])
        out = (run[ends] - run[starts]) * powers.down[starts]
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_ODD[1]))


def tables(which: int = 0, lower: bool = False) -> Tables:
    return worker_cache(("tables", which, lower), lambda: Tables(which, lower))


def columns(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array without nulls."""
    wide = str(texts.type).startswith("large")
    held = texts.buffers()
    offsets = np.frombuffer(held[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(held[2], np.uint8) if held[2] is not None and held[2].size else np.zeros(0, np.uint8)
    return data, offsets


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """Runs of rows of about ``SLICE`` bytes: ``first, last, bytes, offsets, more``.

    A text longer than that comes in several runs, cut before white space;
    ``more`` says that the row goes on in the next run.
    """
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1
        if j > i:
            yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], False
            i = j
            continue
        at, end = int(offsets[i]), int(offsets[i + 1])
        while at < end:
            to = min(end, at + SLICE)
            while to < end:  # to the next place where white space follows something else
                here = SPACE[data[to - 1 : min(end, to + SLICE)]]
                found = np.flatnonzero(here[1:] & ~here[:-1])
                if len(found):
                    to += int(found[0])
                    break
                to = min(end, to + SLICE)
            yield i, i + 1, data[at:to], np.array([0, to - at]), to < end
            at = to
        i += 1


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and by row the number of words before it (one more than rows)."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word])[:-1]
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """``row, hashes of its words``, row by row; words are runs of other than ASCII white space."""
    data, offsets = columns(texts)
    table, held = tables(0, lower), []
    for first, last, part, at, more in slices(data, offsets):
        starts, ends, rows = word_bounds(part, at)
        hashes = table.hashes(part, starts, ends)
        if more or held:
            held.append(hashes)
            if not more:
                yield first, np.concatenate(held)
                held = []
            continue
        for k in range(last - first):
            yield first + k, hashes[rows[k] : rows[k + 1]]


SHINGLE = 5


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter text is one run; no words, none."""
    factors = stream(5, size)
    if len(words) == 0:
        return words
    if len(words) < size:
        return mix((words * factors[: len(words)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(words)))
    n = len(words) - size + 1
    out = words[:n] * factors[0]
    for k in range(1, size):
        out += words[k : k + n] * factors[k]
    out = mix(out)
    out.sort()
    keep = np.empty(n, bool)
    keep[0] = True
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]
