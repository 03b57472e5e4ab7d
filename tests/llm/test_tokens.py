"""Operators 1 and 10 against encoding every text on its own and against exhaustive packing."""

import itertools
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tidewise.llm import packing, tokenstore, wordhash
from tidewise.llm.common import scratch_path
from tidewise.llm.queries import QUERIES
from tidewise.llm.tokens import Encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "   ", " a\n\nb  c \n d  \n e", "　x   y", "don't stop's 12 34!! <|endoftext|> hi", "x" * 3000 + " y", "tab\there\x1c z\x7f q", "É é É é İ",
    " lead", "trail \n ", "l'homme d'été. é. ×. ÷. ab—. \x01 a\x01b we'll don't. DON'T, x.'s", "''...!!a--b é's É́. á. İ.", "\U0001f600!\U0001f600 ñandú, niño.",
]


def plain(path, text, end=0):
    return [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("slice_bytes", [1 << 21, 40])
def test_chunked_ids_are_the_librarys(path, slice_bytes, monkeypatch):
    monkeypatch.setattr(wordhash, "SLICE", slice_bytes)
    encoder = Encoder(path)
    texts = ODD * 2
    got = defaultdict(list)
    for first, last, ids, counts, _ in encoder.runs(pa.array(texts)):
        at = 0
        for k in range(last - first):
            got[first + k] += ids[at : at + counts[k]].tolist()
            at += counts[k]
    assert [got[k] for k in range(len(texts))] == [plain(path, t) for t in texts]


def test_chunk_table_is_emptied_when_full(monkeypatch):
    from tidewise.llm import tokens

    monkeypatch.setattr(tokens, "MOST", 3)
    encoder = Encoder(BYTE)
    for text in ["one two three four five", "six one two", "one six"] * 2:
        assert [i for _, _, ids, _, _ in encoder.runs(pa.array([text])) for i in ids.tolist()] == plain(BYTE, text)


def docs_frame(spark, rows, kind="long"):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], f"doc_id {kind}, text string, start int")


def test_store_round_trip_and_odd_rows(spark):
    rows = [(10 * k, t) for k, t in enumerate(ODD)] + [(30, "again"), (None, "no id"), (None, None), (-5, None), (2**40, "big")]
    folder = scratch_path(spark, "store")
    manifest = tokenstore.write_store(docs_frame(spark, rows), folder, BYTE, shards=3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for i, t in order:
        ids = plain(BYTE, t or "")
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert manifest["ids"] == start and manifest["width"] == 2
    out = tokenstore.read_documents(spark, folder, docs_frame(spark, rows).select("doc_id"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    store = tokenstore.TokenStore(folder)
    assert [x.tolist() for x in store.get(30)] == [plain(BYTE, t) for i, t in order if i == 30]
    assert [x.tolist() for x in store.get(None)] == [plain(BYTE, ""), plain(BYTE, "no id")]
    assert store.get(31) == [] and store.get("30") == []


def test_store_with_text_keys_and_empty_table(spark):
    rows = [("b", "x y"), ("a", "z"), ("é", "w"), (None, "n")]
    folder = scratch_path(spark, "store")
    tokenstore.write_store(docs_frame(spark, rows, "string"), folder, WORD, shards=2)
    store = tokenstore.TokenStore(folder)
    assert all([x.tolist() for x in store.get(i)] == [plain(WORD, t)] for i, t in rows)
    empty = scratch_path(spark, "store")
    assert tokenstore.write_store(docs_frame(spark, []), empty, BYTE)["ids"] == 0
    assert tokenstore.read_documents(spark, empty, docs_frame(spark, []).select("doc_id")).count() == 0
    assert tokenstore.TokenStore(empty).get(1) == []


def test_perfect_hash_is_minimal_and_rejects_foreign_keys():
    keys = random.Random(2).sample(range(-(10**12), 10**12), 20_000)
    one, two = tokenstore.key_hashes(keys)
    hash_ = tokenstore.PerfectHash.build(one, two)
    assert sorted(hash_.slots(one, two).tolist()) == list(range(len(keys)))
    index = tokenstore.ShardIndex.build(sorted(keys), np.ones(len(keys), np.int64))
    foreign = [k for k in range(5000) if k not in set(keys)]
    assert (index.find(foreign) < 0).all() and (index.find(keys) >= 0).all()
    mixed = tokenstore.key_hashes([5, "x", None, 5])
    assert mixed[0][0] == mixed[0][3] == tokenstore.key_hashes([5])[0][0] and len(set(mixed[0].tolist())) == 3


def test_fullest_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        lengths = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 60)
        sums = {sum(a * n for a, n in zip(lengths, ns)) for ns in itertools.product(*[range(n + 1) for n in lengths.values()])}
        got = packing.fullest(room, lengths)
        assert all(n <= lengths[a] for a, n in got.items())
        assert sum(a * n for a, n in got.items()) == max(s for s in sums if s <= room)


def _fewest(sizes, room):
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins) if b >= sizes[k]}.values():
            place(k + 1, [*bins[:j], bins[j] - sizes[k], *bins[j + 1 :]])
        place(k + 1, [*bins, room - sizes[k]])

    place(0, [])
    return best


def test_packing_is_near_the_fewest_bins():
    rng, over = random.Random(6), 0
    for _ in range(40):
        sizes = sorted((rng.randrange(3, 40) for _ in range(9)), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        bins = packing.pack_histogram(counts, 50)
        assert all(sum(a * n for a, n in b.items()) <= 50 for b, _ in bins)
        packed = defaultdict(int)
        for b, times in bins:
            for a, n in b.items():
                packed[a] += n * times
        assert dict(packed) == counts
        over += sum(times for _, times in bins) - _fewest(sizes, 50)
    assert over <= 2


def test_packing_large_histogram_fills_sequences():
    rng = random.Random(7)
    counts = {length: rng.randrange(1, 5000) for length in range(1, 2049)}
    bins = packing.pack_histogram(counts)
    total = sum(a * n for a, n in counts.items())
    used = sum(times for _, times in bins)
    # lengths over half a sequence need one each; otherwise nearly no room is lost
    assert used <= max(-(-total // 2048), sum(n for a, n in counts.items() if a > 1024)) * 1.01
    assert len(bins) < 20_000


def check_pieces(rows, out, capacity=2048):
    want = []
    for i, t in rows:
        ids = plain(WORD, t or "")
        want += [(i, k // capacity, k, len(ids[k : k + capacity]), crc(ids[k : k + capacity])) for k in range(0, len(ids), capacity)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(r["length"] for r in out)


def test_pack_odd_rows(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id"), (50, None), (51, "word, " * 3000), (51, "word, " * 3000), (52, "a " * 2047), (53, "a " * 2048)]
    used, total = check_pieces(rows, packing.pack(docs_frame(spark, rows), WORD).collect())
    assert used == -(-total // 2048)
    assert packing.pack(docs_frame(spark, []), WORD).count() == 0
    small = packing.pack(docs_frame(spark, rows), WORD, capacity=7).collect()
    check_pieces(rows, small, 7)


def test_queries(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    used, total = check_pieces(rows, QUERIES["op10_min_slack_packing"](spark, SF001).collect())
    assert used <= -(-total // 2048) + 1
    start, want = 0, []
    for i, t in sorted(rows):
        ids = plain(BYTE, t or "")
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_store"](spark, SF001).collect())) == want


def test_packing_sends_small_batches_and_restores_the_session(spark, monkeypatch):
    key, seen, plain = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.stored
    before = spark.conf.get(key)

    def stored(df, label):
        seen.append((label, spark.conf.get(key)))
        return plain(df, label)

    monkeypatch.setattr(packing, "stored", stored)
    rows = spark.range(2500).selectExpr("id AS doc_id", "'a b' AS text")
    assert packing.pack(rows, WORD).count() == 2500
    assert ("pieces", "1000") in seen and spark.conf.get(key) == before


def test_a_worker_drops_what_another_operator_has_left(monkeypatch):
    monkeypatch.delitem(sys.modules, "_tidewise_llm_worker", raising=False)
    one, two = (lambda batches: iter([wordhash.worker_cache("left", object)]) for _ in range(2))
    one.__module__ = two.__module__ = "first"
    a, b = next(wordhash.tidied(one)([])), next(wordhash.tidied(two)([]))
    assert a is b  # of the same operator
    two.__module__ = "second"
    assert next(wordhash.tidied(two)([])) is not a
