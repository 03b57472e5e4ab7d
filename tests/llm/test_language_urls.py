"""Operators 3 and 4, and the pipeline, against plain versions and held-out labels."""

import math
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tests.llm.test_dedup import plain_components
from tests.llm.test_mixing_sketch import plain_mix
from tests.llm.test_tokens import check_pieces
from tidewise.llm import exact, langid, minhash, mixing, packing, urls
from tidewise.llm.queries import QUERIES

# --- operator 3 -----------------------------------------------------------


def test_text_model_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    model = langid.fit_text(train, "lang", sample=50)
    assert model.languages == ("de", "en", "es", "fr")
    blind = test.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    out = langid.identify_documents(blind, model).join(test.select("doc_id", "lang"), "doc_id")
    n = out.count()
    assert out.filter("lang_id = lang AND text_lang = lang").count() >= 0.99 * n
    assert out.filter("kept").count() >= 0.99 * n


def test_prior_evidence_decides_where_text_does_not(spark):
    model = langid.fit_text(spark.read.parquet(f"{SF001}/documents.parquet"), "lang")
    texts = {r["lang"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "text").collect()}
    page = lambda lang, text: f'<!doctype html><HTML lang="{lang}-x"><script>if (a < b) the()</script><p>{text}</p></html>'
    rows = [(k, "http://www.news.fr/a", page("fr", texts["fr"])) for k in range(40)] + [(100 + k, "http://en.example.com/", page("en", texts["en"])) for k in range(40)]
    rows += [(200, "http://other.news.fr/b", page("fr", "xx")), (201, "http://en.example.com/b", page("en", "xx")), (202, None, None), (203, "http://x.fr/", "<p>12 !! 34</p>")]
    out = {r["page_id"]: r for r in langid.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert out[0]["lang_id"] == "fr" and out[100]["lang_id"] == "en"
    assert out[200]["lang_id"] == "fr" and out[201]["lang_id"] == "en"  # the same text, other surroundings
    assert (out[202]["lang_id"], out[202]["kept"], out[203]["lang_id"]) == ("und", False, "und")


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit_text(docs, "lang")
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "123 !!! ???", "en", "s"), (4, "the and of with " * 60_000, None, "s"), (4, "the and of with", "en", "s"), (None, "der die das und nicht", "de", None)]
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, lang string, source string, _host string")
    out = sorted((r["doc_id"] or -1, r["lang_id"], r["kept"]) for r in langid.identify_documents(df, model).collect())
    assert out == [(-1, "de", True), (1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True)]
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 4, 4]
    assert langid.identify_documents(df.limit(0), model).count() == 0
    none = langid.fit_text(df.withColumn("lang", F.lit(None).cast("string")), "lang")
    assert none.languages == () and langid.identify_documents(df, none).filter("kept").isEmpty()


def test_trigrams_stay_within_texts():
    import numpy as np

    data = np.frombuffer(b"abcabc", np.uint8)
    apart, before = langid.trigrams(data, np.array([0, 3, 3, 6]))
    assert before.tolist() == [0, 1, 1, 2] and apart[0] == apart[1]


# --- operator 4 -----------------------------------------------------------


def plain_split(label, counts, total):
    best = None
    for cuts in range(1 << max(0, len(label) - 1)):
        words, at = [], 0
        for k in range(1, len(label) + 1):
            if k == len(label) or cuts >> (k - 1) & 1:
                words.append(label[at:k])
                at = k
        score = sum(math.log(counts[w] / total) if counts.get(w) else math.log(10 / total) - len(w) * math.log(10) for w in words)
        if best is None or score > best + 1e-12:
            best = score
    return best


def test_viterbi_finds_the_best_split():
    rng = random.Random(1)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))): rng.randrange(1, 50) for _ in range(8)}
    total = sum(counts.values())
    for _ in range(60):
        label = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 10)))
        words = urls.best_split(label, counts, total)
        assert "".join(words) == label
        score = sum(math.log(counts[w] / total) if counts.get(w) else math.log(10 / total) - len(w) * math.log(10) for w in words)
        assert score == pytest.approx(plain_split(label, counts, total))


def test_long_words_count_and_win(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    texts = spark.createDataFrame([(f"{long} und {long}",), ("ab ab ab",)], "t string")
    counts = urls.word_counts(texts, "t")
    assert {r["word"]: r["n"] for r in counts.collect()} == {long: 2, "und": 1, "ab": 3}
    labels = spark.createDataFrame([(long,), ("abab",), (long + "x",)], "label string")
    got = {r["label"]: r["words"] for r in urls.segment_labels(labels, counts).collect()}
    assert got[long] == [long] and got["abab"] == ["ab", "ab"] and "".join(got[long + "x"]) == long + "x"


def test_unclosed_markup_takes_linear_time(spark):
    from pyspark.sql import functions as F

    from tidewise.llm.common import MARKUP

    def seconds(n):
        rows = spark.createDataFrame([("<script " * n + "<!-- " * n + "< " * n,)], "t string")
        began = time.perf_counter()
        assert rows.select(F.regexp_replace("t", MARKUP, " ").alias("t")).first()["t"] == " "
        return time.perf_counter() - began

    seconds(10)
    assert seconds(80_000) < 5


def test_sample_of_null_ids_is_not_empty(spark):
    rows = [(None, f"the same few words of {k}", "en") for k in range(300)] + [(None, f"einige andere wörter {k}", "de") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for sample in (1, 100):
        model = langid.fit_text(df, "lang", sample=sample)
        assert model.languages == ("de", "en") and (model.log_p.max(axis=1) > model.log_p.min(axis=1)).all()


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/EN/x", "http://a.example.net/en/y?z#q", "https://example.com/de/", "https://example.com?de/", "http://x.org/fr/a",
    "http://cheappills.example.org/en/1", "http://notexample.net/en/", "x://y://z/net/", "http://net", "http://net/", "http://é.ORG/Fr/", "http://a.net#/", "http://" + "ab" * 3000 + ".com/" + "c" * 50_000,
]


def plain_address(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return m[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), m[2]


def plain_judge(pages):
    """Rules and the naive Bayes score of each page, one by one."""
    counts = defaultdict(int)
    addresses = {}
    for i, url, html in pages:
        addresses[i] = plain_address(url)
        shown = re.sub(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[a-z/!?][^>]*(?:>|\Z)|&[a-z]+;", " ", html or "")
        for w in re.findall("[a-z]+", f"{shown} {addresses[i][1]}".lower()):
            counts[w] += 1
    for words in urls.SEEDS.values():
        for w in words:
            counts[w] += urls.SEED_COUNT
    total, named = sum(counts.values()), {w for r in urls.RULES for w in re.findall("[a-z]+", r.name)}

    def tokens(host, path):
        out = [w for label in re.findall("[a-z]+", host) for w in urls.best_split(label, counts, total)]
        out += ["0" if w[0].isdigit() else w for w in re.findall("[a-z]+|[0-9]+", path.lower())]
        return [w for w in out if w not in named]

    def rule(host, path):
        fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name), default=None)

    by = {"block": defaultdict(float), "allow": defaultdict(float)}
    n = {"block": 0, "allow": 0}
    for v, words in urls.SEEDS.items():
        for w in words:
            by[v][w] += urls.SEED_COUNT
    for i, address in addresses.items():
        if r := rule(*address):
            n[r.verdict] += 1
            for w in tokens(*address):
                by[r.verdict][w] += 1
    known = set(by["block"]) | set(by["allow"])
    size = {v: sum(by[v].values()) + len(known) for v in by}
    out = []
    for i, (host, path) in addresses.items():
        r, score = rule(host, path), None
        own = [w for w in tokens(host, path) if w in known]
        if r is None and own:
            score = math.log((n["block"] + 1) / (n["allow"] + 1)) + sum(math.log((by["block"][w] + 1) / size["block"]) - math.log((by["allow"][w] + 1) / size["allow"]) for w in own)
        out.append((i, host, path, r.name if r else None, r.verdict if r else "block" if (score or 0) > 1e-9 else "allow", score))
    return out


def test_url_filter_equals_plain_version(spark):
    pages = [(k, u, "<p>cheap pills the example of a blog</p>") for k, u in enumerate(ODD_URLS)]
    given = spark.read.parquet(f"{SF001}/pages.parquet").limit(50).collect()
    pages += [(100 + r["page_id"], r["url"], r["html"]) for r in given] + [(900, ODD_URLS[9], None), (900, ODD_URLS[9], None)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    out = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]): r["score"] for r in urls.judge(df).collect()}
    want = {p[:5]: p[5] for p in plain_judge(pages)}
    assert out.keys() == want.keys()
    assert all(out[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    assert urls.judge(df).count() == len(pages)


def test_url_filter_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- pipeline -------------------------------------------------------------


def test_pipeline_equals_plain_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit_text(docs, "lang")
    judged = {r["doc_id"]: r["kept"] for r in langid.identify_documents(docs, model).collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if judged[r["doc_id"]]]
    last = {t or "": i for i, t, _ in sorted(rows)}
    rows = [r for r in rows if last[r[1] or ""] == r[0]]
    near = plain_components([r[:2] for r in rows])
    rows = [r for r in rows if near[r[0]] == r[0]]
    times = {i: taken // size if size else 0 for i, size, _, _, taken in plain_mix(rows)}
    rows = [(i, t) for i, t, _ in rows for _ in range(times[i])]
    used, total = check_pieces(rows, corpus_pipeline.run(spark, SF001).collect())
    assert used <= -(-total // 2048) * 1.02 + 1


def test_stages_accept_empty_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF001)
        assert out.count() == 0
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF001).count() == 0


def test_language_queries_return_every_row(spark):
    assert QUERIES["op3_language_id"](spark, SF001).count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert QUERIES["language_id_pages"](spark, SF001).count() == spark.read.parquet(f"{SF001}/pages.parquet").count()


def test_operators_named_by_the_pipeline():
    assert [f.__module__.rpartition(".")[2] for f in (langid.keep_identified, exact.drop_copies, minhash.drop_near_duplicates, mixing.mixed_documents, packing.pack)] == [
        "langid", "exact", "minhash", "mixing", "packing"]
