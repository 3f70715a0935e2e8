"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators assume. Timestamps are UTC instants; ANSI mode
# makes bad casts fail loudly unless an operator asks for ``try_*``.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state (open windows, dedupe keys within the watermark) lives in
    # RocksDB on executor disk instead of the JVM heap, and each micro-batch
    # checkpoints only its changes; the choice is pinned in a query's
    # checkpoint on first start.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pricepanel", checkpoint_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library needs.

    On a cluster the master and ``spark.checkpoint.dir`` come from the
    submit configuration; ``checkpoint_dir`` is only used where none is set
    (local runs and tests).
    """
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``REQUIRED_CONF`` to a session created elsewhere (a cluster's own
    session). All of them are runtime settings; a value already equal is left alone."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Runtime settings for the actions inside; afterwards the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# One task of a write: so many bytes of shuffled rows, some ten times as many in memory, where they are sorted.
TASK_BYTES = 16 << 20
# One partition of the shuffles before it: so many bytes of compressed input.
INPUT_BYTES = 4 << 20


def sized_tasks(spark: SparkSession, input_bytes: int = 0):
    """Settings that size the tasks of a write by its data, so that no task sorts more than its memory holds.

    The shuffles start with partitions by the bytes of the input, at least the session's number; AQE merges small
    ones and splits those of a rebalance at ``TASK_BYTES``. A join whose smaller side has no partition over that
    hashes it, so the larger side is not sorted.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // INPUT_BYTES))
    return settings(spark, {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(TASK_BYTES)})


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder: ``spark.checkpoint.dir`` as the cluster set it.

    ``spark.checkpoint.dir`` is a static setting, so it is only read here.
    When it is unset the context's checkpoint folder is used, then ``fallback``,
    and on a ``local`` master (tests, a laptop) a temporary folder; a cluster
    must name a folder that all its machines share.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not fallback and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "pricepanel-checkpoints"))
    return sc.getCheckpointDir()
