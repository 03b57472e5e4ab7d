"""Session construction and the shared checkpoint folder.

Lineage is cut only with ``DataFrame.checkpoint()`` into the folder the
cluster names in ``spark.checkpoint.dir``.  A private folder is created only
when that setting is missing *and* the master is local (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tidewise", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests, bench and the examples."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session configuration.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we never
    invent a machine-local one there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    path = tempfile.mkdtemp(prefix="tidewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes(conf_value: str | None, default: int) -> int:
    if not conf_value:
        return default
    v = conf_value.strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    for suf in ("kb", "mb", "gb", "tb", "k", "m", "g", "t", "b"):
        if v.endswith(suf):
            num = v[: -len(suf)]
            return int(float(num) * units.get(suf[0], 1)) if suf != "b" else int(float(num))
    return int(float(v))


def shuffle_partitions_for(df: DataFrame) -> int:
    """Partition count for a full-data shuffle of ``df``: enough partitions
    of ``advisoryPartitionSizeInBytes`` for the optimizer's size estimate, at
    least one per core (``defaultParallelism``).

    Where the optimizer has no estimate (after a checkpoint) this is the
    session's ``spark.sql.shuffle.partitions``, with a warning."""
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    target = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None), 64 << 20)
    try:
        est = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable (Connect)
        est = 0
    if est <= 0 or est >= UNKNOWN_BYTES:
        warnings.warn(f"no size estimate: {base} shuffle partitions (spark.sql.shuffle.partitions)", stacklevel=3)
        return base
    try:
        cores = int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext (Connect)
        cores = base
    return int(max(cores, -(-est // max(target, 1))))


#: Estimates from here on come from a plan without statistics.
UNKNOWN_BYTES = 1 << 60
