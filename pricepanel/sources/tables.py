"""Readers for the driver's parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table, selecting only ``columns`` so the scan prunes the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def source_bytes(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    """Bytes of the tables as stored."""
    total = 0
    for n in names:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, n))
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return total


def source_fingerprint(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Cheap identity of the inputs used to key derived tables: per table its
    qualified path, bytes, file count and modification time.

    Read through the Hadoop file system of the path, so it works for a shared
    store (``hdfs://``, ``s3a://``...) as well as local files, with two
    metadata calls per table.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, n))
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            parts.append(f"{p.toString()}:?")
            continue
        summary = fs.getContentSummary(p)
        parts.append(f"{fs.makeQualified(p).toString()}:{summary.getLength()}:{summary.getFileCount()}:"
                     f"{fs.getFileStatus(p).getModificationTime()}")
    return "|".join(parts)
