"""Mergeable exact distinct counts (A1, A14, A22, A26, K2): bitmaps per snapshot over dictionary ids.

A distinct count cannot be added up over snapshots; a bitmap of ids can be
or-ed. Names get dense ids in a dictionary that only grows, each snapshot stores
one bitmap of the ids it holds per column (in buckets of 32,768 ids), and any
window's distinct count is the bit count of the or of its bitmaps: nothing of
the listings is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.deltas import ROWS, add_delta, read_table
from ..sources.lake import path_exists, with_dt
from ..sources.scratch import scratch_table

COUNTED = ("provider", "gpu_type", "region_group")
BUCKET = 1 << 15
NAMES_SCHEMA = "column string, name string, id long"
BITMAPS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("column", T.StringType()),
    T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType()),
    T.StructField("rows", T.LongType()), T.StructField("dt", T.DateType())])
_KEY = ["timestamp", "column", "bucket"]


def read_names(spark: SparkSession, path: str) -> DataFrame:
    names = f"{path}/names"
    return spark.read.schema(NAMES_SCHEMA).parquet(names) if path_exists(spark, names) else spark.createDataFrame([], NAMES_SCHEMA)


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, f"{path}/bitmaps", BITMAPS_SCHEMA, _KEY)


def cells_of(listings: DataFrame, columns=COUNTED) -> DataFrame:
    """(timestamp, dt, column, name, n): the listings reduced to the names of each counted column, map-side combined."""
    named = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("name")) for c in columns])
    return with_dt(listings).groupBy("timestamp", "dt", *columns).agg(F.count(F.lit(1)).alias("n")).select(
        "timestamp", "dt", "n", F.inline(named)).groupBy("timestamp", "dt", "column", "name").agg(F.sum("n").alias("n"))


def write_bitmaps(spark: SparkSession, listings: DataFrame, path: str, columns=COUNTED) -> None:
    """Store the bitmaps of the snapshots of ``listings``, replacing those of the same snapshots.

    New names are numbered first, after the greatest id of their column; a failure in between leaves ids that no
    bitmap uses yet, and the next run finds these names numbered."""
    cells = scratch_table(cells_of(listings, columns), "bitmap-cells")
    names = read_names(spark, path)
    top = names.groupBy("column").agg((F.max("id") + 1).alias("next"))
    fresh = cells.filter("name IS NOT NULL").select("column", "name").distinct().join(names, ["column", "name"], "left_anti")
    number = F.row_number().over(Window.partitionBy("column").orderBy("name")) - 1
    fresh = fresh.withColumn("number", number).join(top, "column", "left").select(
        "column", "name", (F.coalesce("next", F.lit(0)) + F.col("number")).cast("long").alias("id"))
    scratch_table(fresh, "bitmap-names").write.mode("append").parquet(f"{path}/names")
    # a snapshot's rows are kept with one (its least) bucket of each column; a column without names has an empty bitmap
    numbered = cells.join(read_names(spark, path), ["column", "name"], "left").withColumn(
        "bucket", F.coalesce(F.floor(F.col("id") / BUCKET), F.lit(0)))
    bitmap = F.bitmap_construct_agg(F.col("id") % BUCKET)
    maps = numbered.groupBy(*_KEY, "dt").agg(bitmap.alias("bitmap"), F.sum("n").alias("rows"))
    add_delta(maps.select(*[f.name for f in BITMAPS_SCHEMA]), f"{path}/bitmaps", ROWS)


def distinct_counts(bitmaps: DataFrame, by: dict[str, Column], columns=COUNTED) -> DataFrame:
    """Distinct names of every counted column, and the listings, per value of ``by``: from the bitmaps alone."""
    merged = bitmaps.select(*[c.alias(n) for n, c in by.items()], "column", "bucket", "bitmap", "rows").groupBy(
        *by, "column", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("rows").alias("rows"))
    bits = F.bitmap_count("bitmap")
    return merged.groupBy(*by).agg(
        F.sum(F.when(F.col("column") == columns[0], F.col("rows"))).alias("listings"),
        *[F.sum(F.when(F.col("column") == c, bits).otherwise(0)).alias(f"{c}s") for c in columns])


def dataset_stats_from_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    """A1 without the listings: span, snapshots, records, providers and types."""
    maps = read_bitmaps(spark, path)
    counts = distinct_counts(maps, {"_all": F.lit(0)})
    span = maps.agg(F.min("timestamp").alias("first_snapshot"), F.max("timestamp").alias("last_snapshot"),
                    F.count_distinct("timestamp").alias("snapshots"))
    return span.select("*", counts.select("listings").scalar().alias("total_records"),
                       counts.select("providers").scalar().alias("providers"),
                       counts.select("gpu_types").scalar().alias("gpu_types"))
