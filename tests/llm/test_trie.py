"""Operator 12 against a plain dictionary of prefixes, with its odd rows and blocks of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidewise.llm import trie as T


def plain(rows, run=100, head=6):
    """Rows (conv_id, turn, role, text) -> {path: (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, sha)} by brute force."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))

    def digest(role, text):
        return hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode()).hexdigest()

    for c in convs:
        convs[c].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], digest(x[1], x[2])))
    built = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % head
        base = c - int(np.fmod(c, run))
        built[c] = tuple((r, t) for _, r, t in convs.get(base, [])[:h] + convs[c][h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "p", 1) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, path string, depth int")


def got(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed, n, few=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.choice([1, 2, 3, 5, 7, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bb", "é€", ""][:few])))
    return rows


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equal_to_plain_for_any_number_of_blocks(spark, parts):
    rows = conversations(4, 230)
    rows += [(1000 + c, t, "user", "same") for c in range(60) for t in range(8)]  # one conversation, very often
    rows += [(2000 + c, 0, "user", f"own {c}") for c in range(30)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(T.prefix_trie(frame(spark, rows))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (5, None, "user", "first"), (5, 3, None, None), (5, 3, "", ""), (5, 9, "user", "x" * 50000),
        (7, 1, "user", "tie"), (7, 1, "assistant", "tie"), (7, 1, "assistant", "other"), (-3, 0, "user", "below"), (0, 0, "user", "base"), (0, 1, "assistant", "b"),
        (300, 0, "user", "alone"), (101, 0, "user", "no base"), (102, 0, "user", "no base"), (5, 9, "user", "x" * 50000),
    ]
    assert got(T.prefix_trie(frame(spark, rows))) == plain(rows)
    assert got(T.prefix_trie(frame(spark, []))) == []
    turnless = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1][:4]
    rows = [(c, 0, "user", "gone") for c in turnless]
    assert got(T.prefix_trie(frame(spark, rows))) == plain(rows) and plain(rows)[0][1:6] == (0, None, 4, 0, 1)


def test_range_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64):
        v = rng.integers(-1, 5, n)
        table = T.RangeMinima(v)
        first = rng.integers(0, n, 50)
        last = np.array([rng.integers(f, n) for f in first])
        assert table.least(first, last).tolist() == [v[f : e + 1].min() for f, e in zip(first, last)]
        depth = rng.integers(0, 5, 50)
        for i, d, left, right in zip(first, depth, table.left(first, depth), table.right(first, depth)):
            e = i
            while e + 1 < n and v[e + 1] >= d:
                e += 1
            s = i
            while s >= 0 and v[s] >= d:
                s -= 1
            assert right == e and left == s
