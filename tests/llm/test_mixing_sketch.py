"""Operators 6 and 7 against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewise.llm import mixing, sketch
from tidewise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- operator 7 -----------------------------------------------------------

def plain_targets(sizes, share=1.0, cap=3):
    """Reshare by weight, round by round, until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, full = sum(sizes.values()) * share, set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        over = {s for s in order if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def plain_mix(rows, seed=7):
    hashed = []
    for i, t, s in rows:
        key = str(i) if i is not None else hashlib.md5((t or "").encode()).hexdigest()
        hashed.append((s, int(hashlib.md5(f"{key}#{seed}".encode()).hexdigest()[:15], 16), len(WORD.findall(t or ""))))
    sizes = defaultdict(int)
    for s, _, n in hashed:
        sizes[s] += n
    target, taken = plain_targets(sizes), []
    more = {}
    for s in sizes:
        times = int(target[s] // sizes[s]) if sizes[s] else 0
        budget, upto, groups = target[s] - times * sizes[s], 0, defaultdict(int)
        for s2, h, n in hashed:
            if s2 == s:
                groups[h] += n
        below = set()
        for h in sorted(groups):
            if budget > 0 and (upto + groups[h] <= budget or (upto <= budget and (budget - upto) * 2 > groups[h])):
                below.add(h)
            upto += groups[h]
        more[s] = (times, below)
    for (i, t, _), (s, h, n) in zip(rows, hashed):
        times, below = more[s]
        taken.append((i, n, sizes[s], round(target[s], 6), n * (times + (h in below))))
    return taken


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 0) for i, t, s in rows], "doc_id long, text string, source string, size int")


def rows_of(seed, n=400):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), rng.choice(["a"] * 8 + ["b", "c", "é", "Z", None])) for i in range(n)]


@pytest.mark.parametrize("few", [50_000, 1])
def test_mix_equals_plain_version(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", few)
    rows = rows_of(1) + [(1000, None, "only null"), (1001, "", "only null"), (None, "no id", "a"), (None, "no id", "a"), (7, "again seven", "a"), (2000, "long " * 50_000, "b")]
    out = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix(frame(spark, rows)).collect()]
    assert sorted(out, key=repr) == sorted(plain_mix(rows), key=repr)


def test_mix_hits_targets_and_limits(spark):
    out = QUERIES["op7_source_mixing"](spark, SF001).join(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "source"), "doc_id")
    assert out.filter("taken > 3 * size").isEmpty()
    worst = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] / 2 + 1 for r in worst)


def test_larger_budgets_keep_what_smaller_ones_took(spark):
    df = frame(spark, rows_of(2))
    small = {r["doc_id"]: r["times"] for r in mixing.mix(df, share=0.3).collect()}
    large = {r["doc_id"]: r["times"] for r in mixing.mix(df, share=0.6).collect()}
    assert all(large[i] >= n for i, n in small.items()) and sum(large.values()) > sum(small.values())


def test_mixed_documents_repeat_rows(spark):
    rows = rows_of(3, 120) + [(500, None, None)]
    df = frame(spark, rows)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n}


def test_mix_empty_table(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


# --- operator 6 -----------------------------------------------------------

def check_fingerprints(rows, out):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out), key=repr) == sorted(want, key=repr)


def likeness(a, b):
    """Of two fingerprints; their first field stands for the whole text."""
    x, y = ({s[k : k + 16] for k in range(16, len(s), 16)} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else float(a[:16] == b[:16])


def test_fingerprints_odd_rows(spark):
    rng = random.Random(9)
    rows = [(k * 3, " ".join(rng.choice(["ab", "cd", "é", "\U0001f600"]) + str(rng.randrange(9)) for _ in range(rng.randrange(0, 80)))) for k in range(60)]
    rows += [(5, None), (7, ""), (8, "same text of words here now"), (11, "same text of words here now"), (None, "z"), (None, "a b"), (8, "again eight"), (1000, "word " * 60_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, _range int, sketch string")
    out = sketch.fingerprints(df).collect()
    check_fingerprints(rows, out)
    prints = defaultdict(set)
    for r in out:
        prints[r["doc_id"]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["near_edited"] == pytest.approx(likeness(r["fingerprint"], r["edited_fingerprint"]))
    assert prints[8] & prints[11] and prints[5] == prints[7] and len(prints[5]) == 1 and len(min(prints[5])) == 16
    short = [(k, f"short {k}") for k in range(60)]  # different texts differ, also without a kept shingle
    out = sketch.fingerprints(spark.createDataFrame(short, "doc_id long, text string")).collect()
    assert len({r["fingerprint"] for r in out}) == 60 and all(len(r["fingerprint"]) in (16, 32) for r in out)


def test_fingerprints_small_tables(spark):
    schema = "doc_id long, text string"
    assert sketch.fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = sketch.fingerprints(spark.createDataFrame([(1, "alone")], schema)).collect()
    check_fingerprints([(1, "alone")], one)
    check_fingerprints([(None, "no id")], sketch.fingerprints(spark.createDataFrame([(None, "no id")], schema)).collect())


def test_sketch_merges_and_estimates_containment(spark):
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40_000)]
    book, page = " ".join(words), " ".join(words[1000:3000])
    other = " ".join(f"v{k}" for k in range(3000))
    df = spark.createDataFrame([(book, page, other, page + " " + other)], "book string, page string, other string, both string")
    s = {c: sketch.sketch(F.col(c)) for c in df.columns}
    r = df.select(
        sketch.containment(s["page"], s["book"]).alias("inside"), sketch.containment(s["other"], s["book"]).alias("outside"),
        F.size(F.array_except(sketch.merge(s["page"], s["other"]), s["both"])).alias("lost"), F.size(s["book"]).alias("n"),
        sketch.likeness(s["page"], s["book"], F.lit(False)).alias("near"),
    ).first()
    assert (r["inside"], r["outside"], r["lost"]) == (1.0, 0.0, 0)
    assert abs(r["n"] - 40_000 / sketch.SCALE) < 5 * (40_000 / sketch.SCALE) ** 0.5
    assert abs(r["near"] - 1996 / 39_996) < 0.015


def test_fingerprint_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op6_scaled_sketch"](spark, SF001).collect()
    check_fingerprints(rows, out)
    long = [r for r in out if r["n_chars"] > 1500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.97 * len(long)
