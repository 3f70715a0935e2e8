"""The listing lake: Hive-partitioned (``dt=YYYY-MM-DD``) zstd Parquet.

A fresh lake is written as a whole; later writes are numbered deltas that
readers merge by key (``deltas``), so no stored file is ever overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LAKE_SCHEMA, LISTING_COLUMNS, LISTING_KEY
from ..session import sized_tasks
from .deltas import read_table

# Columns the files are clustered by inside each dt, so Parquet min/max
# statistics can skip row groups for the usual gpu_type/provider filters.
CLUSTER_COLUMNS = ["gpu_type", "provider", "instance_type"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on the (possibly remote) file system?"""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def is_committed(spark: SparkSession, path: str) -> bool:
    """A table directory counts as written once Spark's commit marker exists."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def with_dt(df: DataFrame) -> DataFrame:
    return df if "dt" in df.columns else df.withColumn("dt", F.to_date("timestamp"))


def write_lake(df: DataFrame, path: str, mode: str = "overwrite", num_partitions: int | None = None,
               dynamic: bool = True, in_ranges: bool = False, input_bytes: int = 0) -> None:
    """Write listings partitioned by ``dt``.

    Rows are rebalanced on ``dt`` (AQE splits a big snapshot over several
    tasks, so no single task holds a hot dt) and sorted by the cluster
    columns inside each file for row-group skipping. ``mode='overwrite'`` with
    ``dynamic=True`` replaces only the dts present; ``dynamic=False``
    replaces the whole table (a fresh build). ``in_ranges``: the rows already
    lie in ranges of their timestamps and are not moved again. ``input_bytes``
    of what ``df`` reads size the shuffles before the write (``sized_tasks``).
    """
    out = with_dt(df).select(*LISTING_COLUMNS, "dt")
    if num_partitions:
        out = out.repartitionByRange(num_partitions, "dt", *CLUSTER_COLUMNS)
    elif not in_ranges:
        # REBALANCE lets AQE size the write tasks from the real data and split
        # a hot dt over several tasks, instead of a fixed partition count.
        out = out.hint("rebalance", "dt")
    with sized_tasks(df.sparkSession, input_bytes):
        (out.sortWithinPartitions("dt", *CLUSTER_COLUMNS)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .option("compression", "zstd")
            .partitionBy("dt")
            .parquet(path))


def scan_prices(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """Scan the lake, its deltas merged in. With the declared schema absent columns read as NULL;
    ``merge_schema=True`` instead discovers which vintages are present."""
    return read_table(spark, root, LAKE_SCHEMA, LISTING_KEY, merge_schema)
