"""Ingest: raw catalogue items -> listings.

Raw items arrive loosely typed (the price may not even be a number). Every
rule is a column expression; unparseable values become NULL through
``try_cast`` and are routed to a quarantine instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import normalize_provider, quality_at_ingest
from ..schema import LISTING_SCHEMA

RAW_ITEM_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("provider", T.StringType(), True),
    T.StructField("gpu_name", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("instance_name", T.StringType(), True),
    T.StructField("gpu_count", T.DoubleType(), True),
    T.StructField("gpu_memory", T.DoubleType(), True),
    T.StructField("cpu", T.DoubleType(), True),
    T.StructField("memory", T.DoubleType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("price", T.StringType(), True),
    T.StructField("spot", T.BooleanType(), True),
])


def _truthy_str(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _truthy_num(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def _whole(column: str) -> Column:
    return F.expr(f"try_cast({column} AS INT)")


def _parsed(raw: DataFrame) -> DataFrame:
    """Shared parse step: every derived field, plus the item's fate (status, reason)."""
    # a name that is absent has a default; the key columns of a listing are never NULL
    gpu_name = F.when(_truthy_str(F.col("gpu_name")), F.col("gpu_name")).otherwise(F.coalesce("name", F.lit("Unknown")))
    inst = F.when(_truthy_str(F.col("instance_name")), F.col("instance_name")).otherwise(
        F.coalesce("name", F.lit("unknown")))
    count = F.when(_truthy_num(F.col("gpu_count")), _whole("gpu_count")).otherwise(F.lit(0))
    price = F.expr("try_cast(price AS DOUBLE)")
    # The collector's order of failure: provider is read first, the GPU count
    # decides a silent drop, then sizes and the price are parsed. A number no
    # integer can hold (NaN, infinite, too large) rejects its own item only.
    no_size = ((_truthy_num(F.col("gpu_memory")) & _whole("gpu_memory").isNull())
               | (_truthy_num(F.col("cpu")) & _whole("cpu").isNull()))
    fate = (F.when(F.col("provider").isNull(), F.struct(F.lit("rejected"), F.lit("provider")))
             .when(count.isNull(), F.struct(F.lit("rejected"), F.lit("gpu_count")))
             .when(count <= 0, F.struct(F.lit("dropped"), F.lit("no_gpu")))
             .when(no_size, F.struct(F.lit("rejected"), F.lit("size")))
             .when(price.isNull(), F.struct(F.lit("rejected"), F.lit("price")))
             .otherwise(F.struct(F.lit("accepted"), F.lit(None).cast("string"))))
    status, reason = fate["col1"], fate["col2"]
    return raw.select(
        "*", gpu_name.alias("_gpu"), inst.alias("_inst"), count.alias("_count"), price.alias("_price"),
        status.alias("status"), reason.alias("reason"))


def normalize_listings(raw: DataFrame, timestamp=None) -> DataFrame:
    """Accepted raw items as listings (schema v1.1 without region columns).

    Name fallbacks, provider aliasing, int truncation of counts/memory/cpus,
    quality at ingest; items with no GPU or an unparseable field are dropped.
    ``timestamp`` (if given) stamps the whole batch as one snapshot.
    """
    p = _parsed(raw).filter(F.col("status") == "accepted")
    mem = F.col("gpu_memory")
    ts = F.lit(timestamp).cast("timestamp") if timestamp is not None else F.col("timestamp")
    return p.select(
        ts.alias("timestamp"),
        normalize_provider("provider").alias("provider"),
        F.col("_inst").alias("instance_type"),
        F.col("_gpu").alias("gpu_type"),
        F.col("_count").alias("gpu_count"),
        F.when(_truthy_num(mem), _whole("gpu_memory")).alias("gpu_memory_gb"),
        F.when(_truthy_num(F.col("cpu")), _whole("cpu")).otherwise(F.lit(0)).alias("vcpus"),
        F.when(_truthy_num(F.col("memory")), F.col("memory")).otherwise(F.lit(0.0)).alias("ram_gb"),
        F.coalesce("location", F.lit("unknown")).alias("region"),
        F.col("_price").alias("price_per_hour"),
        F.coalesce(F.col("spot"), F.lit(False)).alias("is_spot"),
        F.lit(True).alias("available"),
        F.lit(None).cast("string").alias("availability_zone"),
        quality_at_ingest("_gpu", "gpu_memory").alias("quality"),
    )


def ingest_report(raw: DataFrame, source_col: str = "provider") -> DataFrame:
    """Per source, how many items were accepted, dropped and rejected."""
    return _parsed(raw).groupBy(F.col(source_col).alias("source"), "status", "reason").agg(
        F.count(F.lit(1)).alias("items"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side becomes NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def filter_ingest(raw: DataFrame, min_gpu_memory=None, min_cpu=None, max_price=None, gpu_name=None,
                  provider=None) -> DataFrame:
    """The collector's query options; a falsy option means no filter."""
    preds = []
    if min_gpu_memory:
        preds.append(F.col("gpu_memory") >= min_gpu_memory)
    if min_cpu:
        preds.append(F.col("cpu") >= min_cpu)
    if max_price:
        preds.append(F.expr("try_cast(price AS DOUBLE)") <= max_price)
    if gpu_name:
        preds.append(F.upper(F.coalesce(F.col("gpu_name"), F.col("name"))) == gpu_name.upper())
    if provider:
        preds.append(F.lower(F.col("provider")) == provider.lower())
    out = raw
    for p in preds:
        out = out.filter(p)
    return out


class EmptySnapshotError(RuntimeError):
    """A collection that produced no rows must not be published."""


def require_rows(df: DataFrame) -> DataFrame:
    """Raise before anything is written when the snapshot is empty."""
    if df.isEmpty():
        raise EmptySnapshotError("snapshot has no rows; nothing is published")
    return df


def listing_to_json(df: DataFrame) -> DataFrame:
    """One JSON document per listing."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("json"))


def listing_from_json(df: DataFrame, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Parse listing documents back; fields absent in old documents read as NULL."""
    return df.select(F.from_json("json", schema).alias("r")).select("r.*")
