"""URL filters: rules first, then naive Bayes over segmented host words (operator 4).

Rules name a host (it and all its subdomains) and a path prefix; the longest
one that fits decides.  Other addresses are scored by a multinomial naive Bayes
model over the words of host and path.  Concatenated host labels are split by a
unigram Viterbi: word counts come from all visible page texts and paths, and the
count of every substring of a label is found by an equi-join, so no dictionary
is collected or broadcast.  The model is fitted on all addresses that a rule
decides, plus a few seed words per verdict.  Words that the rules themselves name
are left out: they tell which rule applied, not what kind of site it is.

Addresses are judged once per distinct (host, path) and joined back.

Defined results: a null url, or one without ``://``, has empty host and path; an
address without any known word is allowed; ties of the score allow; repeated rows are
judged alike; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MARKUP, stored

#: Words within a label up to this length, and the label as a whole at any length; letters of a word that nobody
#: knows cost a factor of ten each.
LONGEST = 20
SMOOTHING = 1.0
#: Number of distinct words up to which their weights (some 40 bytes each) are broadcast.
BROADCAST_WORDS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed by the task.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Words that speak for a verdict before any address is seen, each as if seen once.
SEEDS = {"block": ("adult", "bets", "betting", "casino", "escort", "lottery", "pills", "poker", "porn", "spam", "viagra", "xxx"), "allow": ("wiki", "news", "blog", "docs", "university", "library")}
SEED_COUNT = 1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(addresses: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``host, path`` with ``rule`` and ``ruled`` (its verdict) of the longest rule that fits, else null.

    Rules meet the hosts' suffixes in an equi-join, so their number does not multiply the addresses.
    """
    spark = addresses.sparkSession
    listed = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "suffix string, prefix string, rule string, ruled string")
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat_ws(".", F.slice(parts, k, F.size(parts))))
    hosts = addresses.select("host").distinct().select("host", F.explode(suffixes).alias("suffix"))
    own = hosts.join(F.broadcast(listed), "suffix").groupBy("host").agg(F.collect_list(F.struct("prefix", "rule", "ruled")).alias("rules"))
    fitting = F.filter("rules", lambda r: F.col("path").startswith(r["prefix"]))
    longest = F.element_at(
        F.array_sort(fitting, lambda a, b: F.when(F.length(a["rule"]) != F.length(b["rule"]), F.length(b["rule"]) - F.length(a["rule"])).when(a["ruled"] == b["ruled"], 0).when(a["ruled"] == "block", -1).otherwise(1)),
        1,
    )
    joined = addresses.join(own, "host", "left").withColumn("_r", F.when(F.size(fitting) > 0, longest))
    return joined.select("host", "path", F.col("_r.rule").alias("rule"), F.col("_r.ruled").alias("ruled"))


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` of all lower-cased ASCII words."""
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]+"), 0)
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words whose concatenation is ``label``: unigram Viterbi, shorter split on ties."""
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # log probability, number of words with its sign turned, start of the last
    for end in range(1, len(label) + 1):
        options = []
        whole = [0] if end == len(label) > LONGEST and label in counts else []
        for start in [*whole, *range(max(0, end - LONGEST), end)]:
            word = label[start:end]
            n = counts.get(word)
            gain = math.log(n / total) if n else math.log(10.0 / total) - len(word) * math.log(10.0)
            options.append((best[start][0] + gain, best[start][1] - 1, start))
        best.append(max(options, key=lambda o: (o[0], o[1], -o[2])))
    words, end = [], len(label)
    while end:
        start = best[end][2]
        words.append(label[start:end])
        end = start
    return words[::-1]


def segment_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label, words`` for each distinct label of ASCII letters."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    ends = F.sequence(F.lit(1), F.length("label"))
    pieces = F.flatten(
        F.transform(ends, lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("label") - s + 1)), lambda n: F.substring(F.col("label"), s, n)))
    )
    known = labels.select("label", F.explode(F.array_distinct(F.concat(pieces, F.array("label")))).alias("word")).join(counts, "word")
    found = known.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))  # at most LONGEST entries per letter, and one

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            words = [best_split(label, dict(known) if known is not None else {}, total) for label, known in zip(rows["label"], rows["known"])]
            yield pd.DataFrame({"label": rows["label"], "words": words})

    return labels.join(found, "label", "left").select("label", "known").mapInPandas(split, "label string, words array<string>")


def _tokens(addresses: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, path, word``: segmented host words, path words, numbers as ``0``."""
    letters = F.regexp_extract_all(F.col("host"), F.lit("[a-z]+"), 0)
    labels = addresses.select("host").distinct().select("host", F.explode(letters).alias("label"))
    segmented = segment_labels(labels.select("label").distinct(), counts)
    host_words = stored(labels.join(segmented, "label").select("host", F.explode("words").alias("word")), "host_words")
    path_words = F.transform(F.regexp_extract_all(F.lower("path"), F.lit("[a-z]+|[0-9]+"), 0), lambda w: F.when(w.rlike("^[0-9]"), "0").otherwise(w))
    in_path = addresses.select("host", "path", F.explode(path_words).alias("word"))
    return addresses.select("host", "path").join(host_words, "host").select("host", "path", "word").unionByName(in_path)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, seeds: dict[str, tuple[str, ...]] = SEEDS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row; ``score`` is the log odds of block, null under a rule."""
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    addresses = stored(rule_for(urls.select("host", "path").distinct(), rules), "addresses")
    shown = pages.select(F.concat_ws(" ", F.regexp_replace(F.coalesce(html_col, F.lit("")), MARKUP, " "), path_of(F.col(url_col))).alias("t"))
    planted = spark.createDataFrame([(w, v, SEED_COUNT) for v, words in seeds.items() for w in words], "word string, ruled string, n long")
    counts = word_counts(shown, "t").unionByName(planted.select("word", "n")).groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    named = sorted({w for r in rules for w in re.findall("[a-z]+", r.name)})
    tokens = stored(_tokens(addresses, counts).filter(~F.col("word").isin(named)), "tokens")
    # fit: words of the addresses that rules decide, as often as pages have them
    seen = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).join(addresses.filter("rule IS NOT NULL"), ["host", "path"])
    labelled = stored(seen.select("host", "path", "n", "ruled"), "labelled")
    by_word = tokens.join(labelled, ["host", "path"]).select("word", "ruled", "n").unionByName(planted).groupBy("word").agg(
        F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("block"), F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("allow")
    )
    by_word = stored(by_word, "by_word")
    size = by_word.agg(F.sum("block"), F.sum("allow"), F.count(F.lit(1))).first()
    classes = {r["ruled"]: r["n"] for r in labelled.groupBy("ruled").agg(F.sum("n").alias("n")).collect()}
    block, allow, vocabulary = size[0] or 0, size[1] or 0, size[2]
    weight = F.log((F.col("block") + SMOOTHING) / (block + SMOOTHING * vocabulary)) - F.log((F.col("allow") + SMOOTHING) / (allow + SMOOTHING * vocabulary))
    weights = by_word.select("word", weight.alias("weight"))
    prior = math.log((classes.get("block", 0) + SMOOTHING) / (classes.get("allow", 0) + SMOOTHING))
    open_ = addresses.filter("rule IS NULL").select("host", "path")
    scored = tokens.join(open_, ["host", "path"], "left_semi").join(F.broadcast(weights) if vocabulary <= BROADCAST_WORDS else weights, "word")
    scores = scored.groupBy("host", "path").agg((F.round(F.sum("weight") + prior, 9)).alias("score"))
    decided = stored(addresses.join(scores, ["host", "path"], "left"), "decided")
    verdict = F.when(F.col("ruled").isNotNull(), F.col("ruled")).when(F.col("score") > 0, "block").otherwise("allow")
    return urls.join(decided, ["host", "path"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
