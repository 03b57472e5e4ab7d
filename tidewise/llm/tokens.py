"""Token ids of whole texts, in batches (shared by operators 1 and 10).

The ids come from the ``tokenizers`` library.  Where a tokenizer cuts before
white space and between a letter and a punctuation mark by itself, a text's ids
are those of its chunks (a word with the white space before it, or marks), so
each worker keeps the ids of the chunks it has met, found by two independent
64-bit hashes, and only new chunks go to the library.  The
table is emptied when it is full.  Texts with Unicode white space or a special
token's string, tokenizers of another make and (never seen) hash clashes take
the library's direct way.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

from .wordhash import SPACE, columns, slices, tables, worker_cache

#: Other white space than ASCII's, as bytes.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
SLOTS, MOST = 1 << 20, 600_000
DIRECT = 256
#: Between chunks that go to the library together: a word of one id for tokenizers that drop white space.
MARK, TOGETHER = "\x01", 32


def _letters() -> np.ndarray:
    """For bytes: 1 ASCII letter, 2 ASCII punctuation mark, 3 lead byte of U+00C0 to U+00FF, 4 the two of these that are no letters."""
    kind = np.zeros(256, np.uint8)
    kind[33:48], kind[58:65], kind[91:97], kind[123:127] = 2, 2, 2, 2
    kind[65:91], kind[97:123] = 1, 1
    kind[0xC3], kind[[0x97, 0xB7]] = 3, 4
    return kind


class ChunkIds:
    """Open-addressing table from a chunk's two hashes to its ids; entry 0 is the end mark."""

    def __init__(self, end_id: int):
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        self.key, self.other = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.entry = np.full(SLOTS, -1, np.int32)
        self.at, self.count, self.pool = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.pool[0], self.count[0] = self.end_id, 1
        self.entries, self.used = 1, 1

    def find(self, key: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The entry of each pair of hashes, or -1."""
        slot = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        found = self.entry[slot]
        open_ = np.flatnonzero((found >= 0) & ((self.key[slot] != key) | (self.other[slot] != other)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)
            here = self.entry[slot[open_]]
            found[open_] = here
            open_ = open_[(here >= 0) & ((self.key[slot[open_]] != key[open_]) | (self.other[slot[open_]] != other[open_]))]
        return found

    def add(self, key: np.ndarray, other: np.ndarray, ids: list[list[int]]) -> np.ndarray:
        """Entries for new, distinct chunks."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        total, n = int(counts.sum()), len(ids)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.entries + n > len(self.at):
            self.at, self.count = np.concatenate([self.at, self.at]), np.concatenate([self.count, self.count])
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        new = np.arange(self.entries, self.entries + n)
        self.at[new], self.count[new] = self.used + np.cumsum(counts) - counts, counts
        self.used += total
        self.entries += n
        slot, todo = (key & np.uint64(SLOTS - 1)).astype(np.int64), np.arange(n)
        while len(todo):
            free = todo[self.entry[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.entry[slot[put]], self.key[slot[put]], self.other[slot[put]] = new[put], key[put], other[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (SLOTS - 1)
        return new


class Encoder:
    """Ids of texts by one tokenizer file, each text closed by ``end_id``."""

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        made = json.loads(self.tokenizer.to_str())
        self.by_space, self.drops_space = self._cuts(made), False
        if self.by_space == "dropped":
            self.drops_space = True
        special = [re.escape(t["content"].encode()) for t in made.get("added_tokens") or []]
        self.special = re.compile(b"|".join(special), re.IGNORECASE) if special else None
        self.known, self.kind = ChunkIds(end_id), _letters()
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids if self.drops_space else []

    @staticmethod
    def _cuts(made: dict) -> str:
        """Whether white space surely separates: "kept" in front of a word, "dropped", or "" (not known)."""
        pre, norm, added = made.get("pre_tokenizer") or {}, made.get("normalizer"), made.get("added_tokens") or []
        if made.get("post_processor") and made["post_processor"]["type"] != "ByteLevel" or made.get("truncation") or made.get("padding"):
            return ""
        if any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added):
            return ""
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
            return "kept"
        steps = pre.get("pretokenizers", [])
        norms = {n["type"] for n in (norm or {}).get("normalizers", [])}
        if steps and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and norms <= {"NFC", "Replace", "Lowercase"}:
            return "dropped" if "Lowercase" in norms else ""
        return ""

    def _library(self, texts: list[str]) -> list[list[int]]:
        return list(
            chain.from_iterable(
                [e.ids for e in self.tokenizer.encode_batch_fast(texts[k : k + DIRECT], add_special_tokens=False)] for k in range(0, len(texts), DIRECT)
            )
        )

    def _chunks(self, texts: list[str]) -> list[list[int]]:
        """Ids of single chunks; many at a time with a mark between them where that changes nothing."""
        if len(self.mark) != 1 or any(MARK in t for t in texts):
            return self._library(texts)
        groups = [texts[k : k + TOGETHER] for k in range(0, len(texts), TOGETHER)]
        out: list[list[int]] = []
        for group, ids in zip(groups, self._library([f" {MARK} ".join(g) for g in groups])):
            at = [-1, *(k for k, i in enumerate(ids) if i == self.mark[0]), len(ids)]
            out += [ids[a + 1 : b] for a, b in zip(at, at[1:])] if len(at) == len(group) + 1 else self._library(group)
        return out

    def _direct(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        ids = self._library([raw[offsets[k] : offsets[k + 1]].decode() for k in range(len(offsets) - 1)])
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def _run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of one run, and how many each row has (no end mark)."""
        if not self.by_space or not self.drops_space and _WIDE_SPACE.search(data.data):
            return self._direct(data, offsets)
        if self.special and self.special.search(data.data):
            return self._direct(data, offsets)
        if self.known.entries > MOST:
            self.known.clear()
        one, two = tables(0, self.drops_space), tables(1, self.drops_space)
        space = SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        kind = self.kind[data]
        letter = kind == 1
        letter[1:] |= (kind[:-1] == 3) & (data[1:] >= 0x80) & (kind[1:] != 4)
        cut[1:-1] |= letter[:-1] & (kind[1:] == 2)
        cut[offsets] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.concatenate([starts[1:], [len(data)]])
        rows = np.searchsorted(starts, offsets)
        if self.drops_space:  # the chunk is the word alone
            word = np.flatnonzero(~space)
            at = np.searchsorted(word, starts)
            starts = np.minimum(np.append(word, len(data))[at], ends)
        key, other = one.hashes(data, starts, ends), two.hashes(data, starts, ends)
        entry = self.known.find(key, other)
        new = np.flatnonzero(entry < 0)
        if len(new):
            distinct, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            if (other[new] != other[new][first][back]).any():
                return self._direct(data, offsets)
            raw, at = data.tobytes(), new[first]
            ids = self._chunks([raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            entry[new] = self.known.add(distinct, other[at], ids)[back]
        counts, upto = self.known.count[entry], np.zeros(len(entry) + 1, np.int64)
        np.cumsum(counts, out=upto[1:])
        place = np.repeat(self.known.at[entry] - upto[:-1], counts) + np.arange(upto[-1])
        return self.known.pool[place], upto[rows[1:]] - upto[rows[:-1]]

    def runs(self, texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
        """``first, last, ids, counts, more`` for runs of rows; a closed row ends with the end mark.

        ``texts``: an Arrow string array without nulls.  ``more``: the (single,
        very long) row goes on in the next run.
        """
        data, offsets = columns(texts)
        if not self.by_space:  # whole texts only
            parts = ((k, k + 1, data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]), False) for k in range(len(offsets) - 1))
        else:
            parts = slices(data, offsets)
        for first, last, part, at, more in parts:
            ids, counts = self._run(part, at)
            if not more:
                n = last - first
                closed = np.full(len(ids) + n, self.end_id, np.uint32)
                closed[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
                ids, counts = closed, counts + 1
            yield first, last, ids, counts, more


def encoder(path: str, end_id: int = 0) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return worker_cache(("encoder", path, end_id), lambda: Encoder(path, end_id))
