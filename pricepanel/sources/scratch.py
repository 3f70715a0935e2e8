"""Scratch tables: intermediate results written once under ``spark.checkpoint.dir``.

They cut a lineage at a durable table that every machine can read. Each has a
folder of its own; ``clear_scratch`` removes those that no running job can need.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

FOLDER = "pricepanel-scratch"


def scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{FOLDER}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in a folder of its own and read it back with the same schema."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete the scratch tables last written before then; for a scheduler to call. Returns how many."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return 0
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(fs_path) if s.getModificationTime() < limit]
    for p in old:
        fs.delete(p, True)
    return len(old)
