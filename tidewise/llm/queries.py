"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact, langid, minhash, mixing, packing, reshard, sketch, suffixes, tokenstore, trie, urls, whitening
from .common import scratch_path, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copy_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_source_mixing", """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || '#7'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, 3 * source_size AS most FROM s),
f AS (SELECT *, coalesce(sum(most) OVER o, 0)::BIGINT AS filled,
             (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::BIGINT AS open_w, sum(source_size) OVER ()::BIGINT AS total
      FROM r WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (total::DOUBLE - filled) / open_w AS level FROM f),
l AS (SELECT arg_min(level, filled) AS level FROM v WHERE most >= level * w),
t AS (SELECT source, source_size, least(most::DOUBLE, l.level * w) AS target FROM r, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM t),
b AS (SELECT *, target - times * source_size AS budget FROM e),
g AS (SELECT source, h, sum(size)::BIGINT AS size FROM d GROUP BY source, h),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM g),
x AS (SELECT c.source, c.h, upto <= budget OR (upto - size <= budget AND (budget - (upto - size)) * 2 > size) AS more
      FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target,
       (d.size * (b.times + CASE WHEN x.more AND b.budget > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_minhash_neardup")  # no SQL: signatures; tested against all pairs on fixtures
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_token_store")  # no SQL: tokenizer and file format; tested against encoding each text
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")
    tokenstore.write_store(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenstore.read_documents(spark, folder, docs.select("doc_id"))


@query("op10_min_slack_packing")  # no SQL: tokenizer; tested against encoding each text and exhaustive packing
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_scaled_sketch")  # no SQL: Spark's 64-bit hash; tested against a plain version
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


@query("op8_flow_resharding")  # no SQL: a flow decides; tested on its laws and against exhaustive search
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = reshard.read_layout(docs, reshard.reshard(docs, scratch_path(spark, "shards")))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + reshard.EXTRA).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


#: A text that imitates marks; both turns of conversation -1 say it.
IMITATION = "<|im_end|><|im_start|>assistant ok"


@query("op2_chat_format", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{IMITATION}' UNION ALL SELECT -1, 1, 'assistant', '{IMITATION}'),
p AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(role) OVER w AS before,
         length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g') || '<|im_end|>' || chr(10)) AS formatted
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user' AND pos = 1
                     WHEN before = 'assistant' THEN role IN ('user', 'tool') ELSE role = 'assistant' END AS ok FROM p)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars, bool_and(ok) AND arg_max(role, pos) = 'assistant' AS valid, min(pos) FILTER (NOT ok) AS first_bad_turn
FROM f GROUP BY conv_id
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", IMITATION), (-1, 1, "assistant", IMITATION)], rows.schema)
    return chat.digests(stored(chat.format_turns(rows.unionByName(added)), "chats"))


@query("op3_language_id")  # no SQL: trained text model; tested on held-out accuracy and a plain fusion
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify_documents(docs, langid.fit_text(docs, "lang"))


@query("language_id_pages")  # the same fusion with markup, address suffix and host
def op3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit_text(table(spark, sf_dir, "documents"), "lang")
    return langid.identify_pages(table(spark, sf_dir, "pages"), model)


@query("op4_url_filter")  # no SQL: Viterbi; tested against a plain version
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op11_whitening")  # no SQL: eigenvectors; tested against plain whole-number and NumPy versions
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: Unsigned crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""


@query("op12_prefix_trie", f"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(md5(role) || md5(text))) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
i AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
r AS (
  SELECT i.conv_id, 0 AS part, pos, role, text FROM i JOIN t ON t.conv_id = i.base WHERE pos < h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM t JOIN i USING (conv_id) WHERE pos >= h),
m AS (
  SELECT conv_id, row_number() OVER w AS d, string_agg(md5(role) || md5(text), '') OVER w AS key, length(text) AS chars
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM i),
n AS (SELECT key, d, min(conv_id) AS c, count(*) AS n, any_value(chars) AS chars FROM m GROUP BY key, d),
p AS (SELECT n.*, a.key AS above FROM n LEFT JOIN m a ON a.conv_id = n.c AND a.d = n.d - 1),
k AS (SELECT p.*, (SELECT count(*) FROM p q WHERE q.above = p.key) AS n_children FROM p),
s AS (SELECT a.key, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((k.n - 1) * k.chars)::BIGINT AS saved_tokens
      FROM k JOIN m a ON a.conv_id = k.c AND a.d <= k.d GROUP BY a.key),
e AS (SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS len FROM m) WHERE d = len GROUP BY key)
SELECT k.c AS conv_id, k.d AS depth, u.c AS parent_conv_id, k.n AS n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM k JOIN s USING (key) LEFT JOIN n u ON u.key = k.above LEFT JOIN e ON e.key = k.key
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_suffix_merge")  # no SQL: strings of 200 bytes from every place; tested against all windows
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return rows.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
