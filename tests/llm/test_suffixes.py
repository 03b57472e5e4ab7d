"""Operator 13 against all windows, with its odd rows, small chunks and hot passages."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.conftest import SF001
from tidewise.llm import suffixes as S
from tidewise.llm.queries import QUERIES


def plain(rows, window):
    """(id, text) -> multiset of (id, n_bytes, spans, kept) by counting all windows."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + window] for _, b in data for k in range(len(b) - window + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        edge = [k for k in range(len(b) + 1) if (gone[k - 1] if k else 0) != (gone[k] if k < len(b) else 0)]
        out.append((i, len(b), tuple(zip(edge[::2], edge[1::2])), bytes(c for c, g in zip(b, gone) if not g)))
    return Counter(out)


def got(df):
    return Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["stop"]) for s in r["removed"]), bytes(r["kept"])) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, chunk int, kept string")


def passages(seed, n, alphabet="abcdefgh é", window=20):
    """Texts of private runs and shared passages cut at random, some copied whole."""
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    pool = [word(rnd.randrange(window // 2, 6 * window)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(0, 6)):
            if rnd.random() < 0.5:
                p = rnd.choice(pool)
                a = rnd.randrange(len(p))
                parts.append(p[a : a + rnd.randrange(1, len(p))])
            else:
                parts.append(word(rnd.randrange(1, 3 * window)))
        rows.append((i, "".join(parts)))
    return rows + [(n, rows[1][1]), (n + 1, rows[2][1]), (n + 1, rows[2][1])]


def test_query_on_whole_table(spark):
    rows = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = Counter((i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
                   for i, n, spans, kept in plain([(r["doc_id"], r["text"]) for r in rows], 200))
    df = QUERIES["op13_suffix_merge"](spark, SF001)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r) for r in df.collect()) == want and sum(r[2] > 0 for r in want) > 20


@pytest.mark.parametrize("chunk_bytes, hot", [(1 << 23, 1 << 16), (700, 1 << 16), (700, 4)])
def test_every_edge_of_short_and_long_repeats(spark, chunk_bytes, hot):
    rows = passages(chunk_bytes + hot, 120)
    df = S.without_repeats(frame(spark, rows).repartition(3), window=20, spread=8, chunk_bytes=chunk_bytes, hot=hot, bytes_a_task=4000)
    assert got(df) == plain(rows, 20)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "ab" * 40), (4, "ab" * 40 + "c"), (5, "z" * 19), (6, "z" * 20), (6, "q" * 21), (7, "\0" * 9 + "é" * 30), (8, "x\0" * 30),
            (9, "".join(chr(97 + k * k % 26) + str(k) for k in range(900))), (9, None), (10, "z" * 300000), (11, "one passage of text here"), (12, "passage of text here, two")]
    assert got(S.without_repeats(frame(spark, rows), window=20, spread=8, chunk_bytes=2000)) == plain(rows, 20)
    assert S.without_repeats(frame(spark, []), window=20, spread=8).collect() == []


def test_slices_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 64)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[2000:2300] = data[100:400]
    ends = np.array([0, 500, 500, 2900, 3000])
    one = S.anchors(data, ends, 20, 8)
    monkeypatch.setattr(S, "SLICE", 1 << 20)
    for a, b in zip(one, S.anchors(data, ends, 20, 8)):
        assert a.tolist() == b.tolist()
    places, low, high = one
    assert sorted(s for a, b in zip(low, high) for s in range(a, b + 1)) == [s for a, b in zip([0, 500, 2900], [500, 2900, 3000]) for s in range(a, b - 19)]
    assert (places - low < 8).all() and (places >= high).all()


def test_loser_tree_and_front_coding():
    rnd = random.Random(3)
    for runs_n in (1, 2, 5, 9):
        runs = []
        for _ in range(runs_n):
            rows = sorted(bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(rnd.randrange(0, 20)))
            keys = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 6)
            counts = np.array([rnd.randrange(1, 3) for _ in rows])
            back, common, several = S.decoded(S.front_coded(keys, counts), len(rows), 6)
            assert back == rows and several.tolist() == (counts > 1).tolist()
            runs.append((back, common))
        order = list(S.merged(runs, 6))
        out = [runs[r][0][k] for r, k, _ in order]
        assert out == sorted(x for r, _ in runs for x in r)
        for a, b, (_, _, c) in zip(out, out[1:], order[1:]):
            assert c == next((k for k in range(6) if a[k] != b[k]), 6)
