"""Operators 5 and 9 against plain versions, with the odd rows their docstrings define."""

import hashlib
import os
import random
import re
from collections import defaultdict

import pytest

from tests.conftest import SF001
from tidewise.llm import exact, minhash
from tidewise.llm.components import components
from tidewise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def plain_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


# --- operator 5 -----------------------------------------------------------

def test_exact_copies_odd_rows(spark):
    rows = [(1, "a"), (2, None), (3, ""), (4, "a"), (None, "a"), (None, "only null ids"), (None, "only null ids"), (7, "A"), (8, "b" * 300_000), (9, "b" * 300_000), (4, "a")]
    out = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.copy_groups(docs_frame(spark, rows), support=0.3).collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = []
    for i, t in rows:
        own = [x for x in groups[t or ""] if x is not None]
        keep = max(own) if own else None
        want.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(out, key=repr) == sorted(want, key=repr)


def test_exact_copies_hot_groups_do_not_change_the_result(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(300)}") for i in range(2000)]
    df = docs_frame(spark, rows)
    wide = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.copy_groups(df, support=0.2).collect()}
    narrow = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.copy_groups(df, support=0.001).collect()}
    best, size = {}, defaultdict(int)
    for i, t in rows:
        best[t] = max(i, best.get(t, i))
        size[t] += 1
    assert wide == narrow == {i: (best[t], size[t]) for i, t in rows}


def test_frequent_digests_finds_all_heavy_ones(spark):
    rows = [(i, f"heavy{i % 3}" if i % 2 else f"single{i}") for i in range(3000)]
    digests = docs_frame(spark, rows).select("doc_id", exact.digest_column().alias("text_sha256"))
    found = {r["text_sha256"]: r["hot_size"] for r in exact.frequent_digests(digests, 0.1).collect()}
    assert found == {hashlib.sha256(f"heavy{k}".encode()).hexdigest(): 500 for k in range(3)}


def test_drop_copies_keeps_columns_and_one_of_each(spark):
    rows = [(1, "a"), (2, None), (3, ""), (4, "a"), (5, "c"), (1, "different text, same id")]
    df = docs_frame(spark, rows)
    out = exact.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == [(1, "different text, same id"), (3, ""), (4, "a"), (5, "c")]


def test_drop_copies_keeps_one_of_rows_that_nothing_tells_apart(spark):
    rows = [(1, "a"), (1, "a"), (0, "a"), (None, "n"), (None, "n"), (None, "n"), (None, "b"), (2, "b"), (None, None), (None, ""), (3, "single"), (None, "alone")]
    out = exact.drop_copies(docs_frame(spark, rows).repartition(4))
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in out.collect()) == [(-1, ""), (-1, "alone"), (-1, "n"), (1, "a"), (2, "b"), (3, "single")]


def test_exact_empty_table(spark):
    assert exact.copy_groups(docs_frame(spark, [])).count() == 0
    assert exact.drop_copies(docs_frame(spark, [])).count() == 0


# --- operator 9 -----------------------------------------------------------

def near_rows(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for base in range(12):
        text = [word() for _ in range(rng.choice([6, 9, 40, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            own = list(text)
            for _ in range(rng.choice([0, 1, 2, 5])):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own))
    shared = [word() for _ in range(60)]
    rows += [" ".join([*shared, *[word() for _ in range(rng.choice([10, 25, 40]))]]) for _ in range(25)]
    # a chain: neighbours are alike, the ends are not
    chain = [word() for _ in range(100)]
    for k in range(12):
        rows.append(" ".join(chain[:]))
        chain[k * 8] = word()
        chain[k * 8 + 1] = word()
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [5, 6])
def test_near_duplicates_equal_all_pairs(spark, seed):
    rows = near_rows(seed)
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "One two"), (1004, "one  TWO"), (1005, "one two three"), (1006, "é É"), (1007, "é É"), (1008, "É é")]
    out = {r["doc_id"]: r for r in minhash.near_duplicates(docs_frame(spark, rows)).collect()}
    want = plain_components(rows)
    assert {i: r["component_id"] for i, r in out.items()} == want
    assert {i: r["n_shingles"] for i, r in out.items()} == {i: len(shingle_set(t)) for i, t in rows}
    assert all(r["kept"] == (want[i] == i) for i, r in out.items())


def edited_copies(n, seed=11, words=120, edits=4):
    """One text with n copies of some edits each: most of them are no links of each other."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text, rows = [word() for _ in range(words)], []
    for i in range(n):
        own = list(text)
        for _ in range(edits):
            own[rng.randrange(words)] = word()
        rows.append((i, " ".join(own)))
    return rows


def test_a_large_group_of_near_copies_makes_pairs_in_proportion(spark, monkeypatch):
    compared = []
    keep = minhash.stored

    def counted(df, label):
        out = keep(df, label)
        if label in ("pairs", "candidates"):
            compared.append(out.count())
        return out

    monkeypatch.setattr(minhash, "stored", counted)
    totals = []
    for n in (300, 600):
        rows = edited_copies(n)
        compared.clear()
        out = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_frame(spark, rows)).collect()}
        if n == 300:
            assert out == plain_components(rows)
        totals.append(sum(compared))
    assert totals[1] <= 2.3 * totals[0], totals


def test_links_apart_from_the_hub_are_all_found(spark):
    """The smallest id of a bucket is like none of two groups whose members are alike."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = [(0, " ".join(base))]
    for g in range(3):
        own = list(base)
        for _ in range(7):
            own[rng.randrange(150)] = word()
        for k in range(6):
            one = list(own)
            one[rng.randrange(150)] = word()
            rows.append((10 * g + k + 1, " ".join(one)))
    out = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_frame(spark, rows)).collect()}
    assert out == plain_components(rows) and len(set(out.values())) > 1


def test_near_duplicates_link_all_rows_of_an_id(spark):
    a, b, other = "a b c d e f", "g h i j k l", "m n o p q r"
    out = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs_frame(spark, [(7, a), (7, b), (2, a), (3, b), (8, other)])).collect()}
    assert out == {(7, 2, False), (2, 2, True), (3, 2, False), (8, 8, True)}
    # a unique and an empty text of an id share the fate of its near copy
    df = docs_frame(spark, [(7, a), (7, other), (7, ""), (2, a), (4, None), (9, other)])
    out = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()}
    assert out == {(7, 2, False), (2, 2, True), (9, 2, False), (4, 4, True)}
    assert sorted(r["doc_id"] for r in minhash.drop_near_duplicates(df).collect()) == [2, 4]


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A B c d e f"), (None, "a b c d e f"), (9, "x " * 200_000 + "y")]
    out = sorted(((r["doc_id"] or -1), r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs_frame(spark, rows)).collect())
    assert out == [(-1, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    assert minhash.near_duplicates(docs_frame(spark, [])).count() == 0
    kept = minhash.drop_near_duplicates(docs_frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "digest"] and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 3, 9]


def test_long_texts_are_read_in_runs(spark, monkeypatch):
    from tidewise.llm import wordhash

    rows = near_rows(8)[:20]
    monkeypatch.setattr(wordhash, "SLICE", 64)  # in this process only: the signature function is called directly
    import pyarrow as pa

    texts = pa.array([t for _, t in rows])
    short = [len(wordhash.shingles(w)) for _, w in wordhash.word_hashes(texts)]
    assert short == [len(shingle_set(t)) for _, t in rows]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 260)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {x: find(x) for x in list(root) if find(x) != x}


def test_min_max_signature_estimates_similarity():
    """Both ends of every permutation agree with the probability of the similarity."""
    import numpy as np

    from tidewise.llm.wordhash import stream

    a, b = stream(1, 900), np.concatenate([stream(1, 900)[300:], stream(2, 300)])  # 600 of 1,200 in common
    factors = stream(23, 2000) | np.uint64(1)
    with np.errstate(over="ignore"):
        x, y = factors[:, None] * a[None, :], factors[:, None] * b[None, :]
    assert abs((x.min(axis=1) == y.min(axis=1)).mean() - 0.5) < 0.04
    assert abs((x.max(axis=1) == y.max(axis=1)).mean() - 0.5) < 0.04


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op9_minhash_neardup"])
def test_queries_return_every_document(spark, name):
    out = QUERIES[name](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert out.count() == docs.count()
    if name.startswith("op9"):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert {r["doc_id"]: r["component_id"] for r in out.collect()} == plain_components(rows)


def test_bands_are_shuffled_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tidewise.llm import minhash

    held = {}
    plain = minhash.stored

    def stored(df, label):
        held.setdefault(label, df)
        return plain(df, label)

    monkeypatch.setattr(minhash, "stored", stored)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*base[: 59 - i % 2], f"x{i}"])) for i in range(6)] + [(9, "one other text that is alone")]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(6), 0), 9: 9}
    pairs = held["pairs"]
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_rows_of_elements_are_shuffled_without_sketches(spark, monkeypatch):
    """A member's sketch goes with its pairs, not with each of its elements."""
    held, plain = {}, minhash.stored

    def stored(df, label):
        out = plain(df, label)
        held.setdefault(label, (df, out))
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = [(0, " ".join(base))]
    for g in range(3):
        own = list(base)
        for _ in range(7):
            own[rng.randrange(150)] = word()
        for k in range(6):
            one = list(own)
            one[rng.randrange(150)] = word()
            rows.append((10 * g + k + 1, " ".join(one)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == plain_components(rows)
    elements, pairs = held["rare_elements"][1], held["star_pairs"]
    assert all(kind != "array<bigint>" for _, kind in elements.dtypes)
    assert "sketch" not in pairs[0]._jdf.queryExecution().executedPlan().toString()
    assert 0 < pairs[1].count() <= 2 * elements.count()


def test_only_the_differences_of_pairs_are_shuffled(spark):
    members = spark.createDataFrame([(k, k, 8, [1, 2] if k < 2 else [10 * k, 10 * k + 1]) for k in range(40)], "m long, u long, n long, d array<long>")
    links = minhash._links(spark.createDataFrame([(0, 1), (0, 2)], "m long, mv long"), members)
    assert [tuple(r) for r in links.collect()] == [(0, 1)]  # 0 and 2 differ in 4 of 8 and 8 shingles: a seventh of 16 is less
    assert "bitmap_construct_agg" in links._jdf.queryExecution().optimizedPlan().toString()


def test_tables_that_nothing_reads_any_more_are_deleted(spark, monkeypatch):
    """Signatures and sets of shingles don't lie beside the later tables; hubs are tested by their unlinked members alone."""
    held, plain = {}, minhash.stored

    def stored(df, label):
        out = plain(df, label)
        held.setdefault(label, (df, out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")))
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = [(0, " ".join(base))]
    for g in range(3):
        own = list(base)
        for _ in range(7):
            own[rng.randrange(150)] = word()
        for k in range(6):
            one = list(own)
            one[rng.randrange(150)] = word()
            rows.append((10 * g + k + 1, " ".join(one)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == plain_components(rows)
    gone = {label for label, (_, path) in held.items() if not os.path.exists(path)}
    assert {"signatures", "sets", "differences"} <= gone and "classes" not in gone
    assert "sketchv" not in held["apart_pairs"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "size(d" in held["open_hubs"][0]._jdf.queryExecution().optimizedPlan().toString()
