"""A training corpus from ``documents``: identify, de-duplicate, mix, pack.

Every stage gets what its predecessor kept and returns the columns of
``documents`` (the last one: the packed pieces).  ``run`` writes each stage's
result as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewise.llm import exact, langid, minhash, mixing, packing
from tidewise.llm.common import stored, table

#: A tokenizers file with a vocabulary for plain words.
TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose language is not identified go."""
    return langid.keep_identified(docs, langid.fit_text(docs, "lang"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the largest id stays."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near-duplicates the smallest id stays."""
    return minhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: each document as often as its source's target takes it, from not at all to three times."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces in sequences of 2,048 tokens; a document taken twice is packed twice."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("minhash_neardup", near_copies),
    ("source_mixing", mixture),
    ("packing", packed),
]

#: The text model, signatures and tokenizer have no SQL; the tests run a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
