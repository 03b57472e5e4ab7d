"""Language identification by Bayesian evidence fusion (operator 3).

Evidence about a document's language ``l``:

* its text: naive Bayes over hashed byte trigrams of the lower-cased letters,
  fitted on a sample of about ``SAMPLE`` labelled documents per language;
* the language its markup declares and the suffix of its address: how much more
  often a value occurs with ``l`` than overall, shrunk towards "no evidence" by
  ``SHRINK`` documents;
* its host: ``P(l | host)``, smoothed by ``KAPPA`` documents towards
  ``P(l | domain)``, which is smoothed the same way towards ``P(l)``.

All but the first are sums of the text posteriors over all documents, grouped by
value; a document's own share is taken out of its host's sums.  A further class
with equal probability for all trigrams stands for text in none of the languages.
A document is rejected if it has no letters, if that class wins or if the best
posterior is below ``CONFIDENCE``.

Defined results: a null, empty or letterless text has language ``und`` and is
rejected; null host, suffix or declaration are no evidence; repeated rows count
as often as they occur; without any labelled document, every document is ``und``; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MARKUP, free_name, stored, text_of
from .wordhash import columns, slices, tidied, worker_cache

#: Labelled documents per language for the text model, chosen by a hash of the id.
SAMPLE = 2000
BUCKETS = 1 << 16
SHRINK, KAPPA, CONFIDENCE = 20.0, 20.0, 0.6
#: Trigrams count as this many independent observations at most.
EVIDENCE = 200.0
OTHER, OTHER_PRIOR = "other", 1e-4
#: Values of one kind of evidence up to which its table (a few hundred bytes a row) is broadcast.
BROADCAST_VALUES = 20_000


def _classes() -> np.ndarray:
    """For bytes: ASCII letters lower-cased, bytes of longer characters as they are, all else a blank."""
    kind = np.full(256, 32, np.uint32)
    kind[97:123] = np.arange(97, 123)
    kind[65:91] = np.arange(97, 123)
    kind[128:] = np.arange(128, 256)
    return kind


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of a run of texts and, by row, how many come before it.

    A trigram lies within one text, has no two blanks in a row and no blank in its middle.
    """
    kind = worker_cache("letter kinds", _classes)[data]
    if len(kind) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    a, b, c = kind[:-2], kind[1:-1], kind[2:]
    ok = b != 32
    inner = offsets[(offsets > 0) & (offsets < len(kind))]
    for back in (1, 2):  # not across the border of two texts
        at = inner - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    at = np.flatnonzero(ok)
    value = (a[at].astype(np.uint64) << np.uint64(16)) | (b[at].astype(np.uint64) << np.uint64(8)) | c[at].astype(np.uint64)
    bucket = ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    return bucket, np.searchsorted(at, offsets)


@dataclass(frozen=True)
class TextModel:
    """Languages and the log probabilities of the trigram buckets (languages x buckets)."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def fit_text(df: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> TextModel:
    """Fit on about ``sample`` documents per label, whole texts; at most languages x buckets counts reach the driver.

    A document is in the sample by a hash of its id and text, so repeated rows are in or out together; null ids are ids.
    """
    h = F.xxhash64(F.col(id_col), text_of(text_col))
    labelled = df.select(F.col(label_col).alias("label"), h.alias("h"), text_of(text_col).alias("text")).filter("label IS NOT NULL")
    # at least the rows of the smallest hash are in the sample
    sizes = {r["label"]: (r["n"], r["least"]) for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).collect()}
    if not sizes:
        return TextModel((), np.zeros((0, BUCKETS), np.float32))
    limit = F.lit(None).cast("long")
    for label, (n, least) in sizes.items():
        limit = F.when(F.col("label") == label, F.lit(max(least, ((1 << 64) - 1) * min(sample, n) // n - (1 << 63)))).otherwise(limit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            data, offsets = columns(batch.column(1))
            for first, last, part, at, _ in slices(data, offsets):
                buckets, before = trigrams(part, at)
                for k in range(last - first):
                    own = sums.setdefault(labels[first + k], np.zeros(BUCKETS, np.int64))
                    own += np.bincount(buckets[before[k] : before[k + 1]], minlength=BUCKETS)
        for label, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at)), pa.array(at), pa.array(own[at])], ["label", "bucket", "n"])

    chosen = labelled.filter(F.col("h") <= limit).select("label", "text")
    counts = chosen.mapInArrow(tidied(count), "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(sizes))
    table = np.full((len(languages), BUCKETS), 0.5)
    for k, label in enumerate(languages):
        own = counts[counts["label"] == label]
        table[k, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _score(model: TextModel) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = columns(batch.column(batch.num_columns - 1))
            n = np.zeros(batch.num_rows, np.int64)
            sums = np.zeros((len(model.languages), batch.num_rows))
            for first, last, part, at, _ in slices(data, offsets):
                buckets, before = trigrams(part, at)
                n[first:last] += np.diff(before)
                for k, log_p in enumerate(model.log_p):
                    upto = np.concatenate([[0.0], np.cumsum(log_p[buckets], dtype=np.float64)])
                    sums[k, first:last] += upto[before[1:]] - upto[before[:-1]]
            # the last class: all trigrams alike
            scores = np.vstack([sums, -n * math.log(BUCKETS)]) / np.maximum(1.0, n / EVIDENCE)
            scores -= scores.max(axis=0)
            prior = np.ones(len(scores))
            prior[-1] = OTHER_PRIOR
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            p = _softmax(scores.T + np.log(prior))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n), _vectors(scores.T), _vectors(p)], [*batch.schema.names[:-1], "_n", "_text", "_p"])
    return score


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Probabilities, row by row, from log scores."""
    raw = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raw / raw.sum(axis=1, keepdims=True)


def _vectors(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


EVIDENCE_KINDS = ("_declared", "_suffix", "_domain", "_host")


def _fuse(languages: tuple[str, ...], share: np.ndarray, confidence: float, keys: int) -> Callable:
    """The posterior of each row from its text scores and the sums of its declaration, suffix, domain and host."""
    names, total = np.array([*languages, OTHER]), share.sum()
    prior = share / total

    def sums(column, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """A column of vectors, zeros for null, and where it is null."""
        got = np.zeros((rows, len(share)))
        there = np.flatnonzero(np.asarray(column.is_valid()))
        if len(there):
            got[there] = np.asarray(column.drop_null().flatten()).reshape(-1, len(share))
        return got, np.asarray(column.is_null())

    def weight(own: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """log of P(value | class) / P(value), shrunk; 0 without a value."""
        marginal = own.sum(axis=1, keepdims=True) / total
        marginal[gone] = 1.0
        return np.where(gone[:, None], 0.0, np.log((own + SHRINK * marginal) / ((share + SHRINK) * marginal)))

    def smoothed(own: np.ndarray, gone: np.ndarray, mine: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """P(class | value) without the document itself, smoothed towards ``upper``."""
        others = np.maximum(own - mine, 0.0)
        got = (others + KAPPA * upper) / (others.sum(axis=1, keepdims=True) + KAPPA)
        return np.where(gone[:, None], upper, got)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            col = lambda name: batch.column(batch.schema.get_field_index(name))
            n = np.asarray(col("_n"))
            said = n > 0
            text, _ = sums(col("_text"), rows)
            p, _ = sums(col("_p"), rows)
            mine = p * said[:, None]
            declared, suffix, domain, host = (sums(col(f"_of{kind}"), rows) for kind in EVIDENCE_KINDS)
            level = smoothed(*host, mine, smoothed(*domain, mine, np.broadcast_to(prior, p.shape)))
            post = _softmax(text + weight(*declared) + weight(*suffix) + np.log(level)) if rows else p
            best = post.max(axis=1) if rows else np.zeros(0)
            found = np.where(said, names[post.argmax(axis=1)] if rows else [], "und")
            by_text = np.where(said, names[p.argmax(axis=1)] if rows else [], "und")
            sure = np.round(np.where(said, best, 0.0), 6)
            kept = (sure >= confidence) & (found != OTHER) & (found != "und")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(keys)), pa.array(found.tolist(), pa.string()), pa.array(sure), pa.array(by_text.tolist(), pa.string()),
                 col("_declared"), col("_host"), pa.array(n), pa.array(kept)],
                [*batch.schema.names[:keys], "lang_id", "confidence", "text_lang", "declared", "host", "n_trigrams", "kept"],
            )
    return fuse


def _joined(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    few = table.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES
    return rows.join(F.broadcast(table) if few else table, key, "left")


def identify(
    df: DataFrame, model: TextModel, key: list[str], text: Column, declared: Column, host: Column, confidence: float = CONFIDENCE,
) -> DataFrame:
    """``key`` columns with ``lang_id, confidence, text_lang, declared, host, n_trigrams, kept``.

    ``text``, ``declared`` and ``host`` are expressions over ``df``.  Only the scan
    handles texts; the fusion works on a compact row per document.
    """
    named = df.select(
        *key, F.lower(F.regexp_extract(declared, "^[A-Za-z]+", 0)).alias("_declared"), F.lower(host).alias("_host"), F.coalesce(text, F.lit("")).alias("_t")
    ).withColumn("_declared", F.when(F.col("_declared") != "", F.col("_declared"))).withColumn("_host", F.when(F.col("_host") != "", F.col("_host")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1])
    classes = len(model.languages) + 1
    rows = named.mapInArrow(tidied(_score(model)), f"{kinds}, _n long, _text array<double>, _p array<double>")
    dotted = F.instr("_host", ".") > 0
    rows = stored(
        rows.withColumn("_suffix", F.when(dotted, F.substring_index("_host", ".", -1))).withColumn("_domain", F.when(dotted, F.substring_index("_host", ".", -2))),
        "language_scores",
    )
    own = [F.sum(F.get("_p", F.lit(k))) for k in range(classes)]
    said = rows.filter("_n > 0")
    share = np.array([(x or 0.0) + 1.0 for x in said.agg(*own).first()])
    out = rows
    for by in EVIDENCE_KINDS:
        out = _joined(out, stored(said.filter(F.col(by).isNotNull()).groupBy(by).agg(F.array(*own).alias(f"_of{by}")), f"by{by}"), by)
    key_kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[: len(key)])
    out = out.select(*key, "_n", "_text", "_p", "_declared", "_host", *[f"_of{by}" for by in EVIDENCE_KINDS])
    return out.mapInArrow(
        tidied(_fuse(model.languages, share, confidence, len(key))),
        f"{key_kinds}, lang_id string, confidence double, text_lang string, declared string, host string, n_trigrams long, kept boolean",
    )


DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)"
HOST = r"^[^:]*://([^/?#:]*)"


def identify_documents(df: DataFrame, model: TextModel) -> DataFrame:
    """``documents``: declared language ``lang``, host ``source``."""
    return identify(df, model, ["doc_id"], F.col("text"), F.col("lang"), F.col("source"))


def identify_pages(df: DataFrame, model: TextModel) -> DataFrame:
    """``pages``: the language its markup declares, the address's host and suffix, the visible text."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), MARKUP, " ")
    return identify(df, model, ["page_id"], text, F.regexp_extract("html", DECLARED, 1), F.regexp_extract("url", HOST, 1))


def keep_identified(df: DataFrame, model: TextModel) -> DataFrame:
    """The documents that are not rejected, all columns unchanged."""
    key, text, other = free_name(df, "_rejected_id"), free_name(df, "_text_sum"), free_name(df, "_rejected_sum")
    rows = df.withColumn(text, F.xxhash64(text_of()))
    judged = identify(rows, model, ["doc_id", text], F.col("text"), F.col("lang"), F.col("source"))
    gone = stored(judged.filter("NOT kept").select(F.col("doc_id").alias(key), F.col(text).alias(other)).distinct(), "rejected")
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text) == F.col(other)), "left_anti").drop(text)
