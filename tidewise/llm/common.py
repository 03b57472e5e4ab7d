"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space and words as the contracts define them.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: What a page doesn't show: scripts, styles, comments, tags, entities; what isn't closed goes on to the end, so no
#: opening is read twice.
MARKUP = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[a-z/!?][^>]*(?:>|\z)|&[a-z]+;"

_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's own reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_forget)
    _WRITTEN.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - the session is gone or has no JVM here; the cluster's own clean-up remains
        return


def _forget() -> None:
    """Delete this process's scratch tables when the driver ends."""
    for spark, path in _WRITTEN:
        _delete(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage: what was computed once is not computed again when an
    executor is lost, and every executor can read it.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held._stored_at = path
    return held


def forget(df: DataFrame) -> None:
    """Delete the table that ``stored`` has written for ``df``, once nothing reads it any more."""
    path = df.__dict__.pop("_stored_at", None)
    if path is not None:
        _delete(df.sparkSession, path)


#: Rows of a batch of whole texts on its way to Python.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written inside sends ``BATCH_ROWS`` rows at most to Python at a time.

    A batch lies in the executor and in the worker, and the session's 10,000 whole texts take tens of MB in each.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(key, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` (in any case) has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


#: Of the bitmap of ``maybe_among``: 1 MB.
FILTER_BITS = 23


def maybe_among(df: DataFrame, hashed: Column, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: whether the hash may be among ``keys`` (one column of 64-bit hashes).

    A bitmap of ``2**FILTER_BITS`` hashes, whose size is fixed, is broadcast; false means surely not, so such rows need
    no join, and their texts no shuffle.
    """
    part, at, bits = (free_name(df, c) for c in ("_part", "_at", "_bits"))
    low = F.lit(32767)
    place = F.col(keys.columns[0]).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    table_ = keys.groupBy(F.shiftright(place, 15).alias(part)).agg(F.bitmap_construct_agg(place.bitwiseAND(low)).alias(bits))
    own = hashed.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    rows = df.withColumns({part: F.shiftright(own, 15), at: own.bitwiseAND(low).cast("int")}).join(F.broadcast(table_), part, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.col(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.col(at) % 8) == 1, F.lit(False))
    return rows.withColumn(name, found).select(*[F.col(f"`{c}`") for c in df.columns], name)
