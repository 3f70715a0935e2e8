"""Declared schemas (schema v1.1 of the listing panel and its companions)."""

from pyspark.sql import types as T

SCHEMA_VERSION = "1.1"

# Natural key of one listing observation: at most one row per key.
LISTING_KEY = ["timestamp", "provider", "instance_type", "region", "is_spot"]

# Columns of the oldest published vintage (13 columns, no quality/regions).
BASE_FIELDS = [
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("instance_type", T.StringType(), False),
    T.StructField("gpu_type", T.StringType(), False),
    T.StructField("gpu_count", T.IntegerType(), True),
    T.StructField("gpu_memory_gb", T.IntegerType(), True),
    T.StructField("vcpus", T.IntegerType(), True),
    T.StructField("ram_gb", T.DoubleType(), True),
    T.StructField("region", T.StringType(), False),
    T.StructField("price_per_hour", T.DoubleType(), False),
    T.StructField("is_spot", T.BooleanType(), True),
    T.StructField("available", T.BooleanType(), True),
    T.StructField("availability_zone", T.StringType(), True),
]
BASE_COLUMNS = [f.name for f in BASE_FIELDS]

REGION_COLUMNS = ["region_canonical", "country", "region_lat", "region_lon", "region_group"]

ENRICH_FIELDS = [
    T.StructField("quality", T.StringType(), True),
    T.StructField("region_canonical", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("region_lat", T.DoubleType(), True),
    T.StructField("region_lon", T.DoubleType(), True),
    T.StructField("region_group", T.StringType(), True),
]

# Full v1.1 listing row as stored in the lake (``dt`` is the Hive partition).
LISTING_SCHEMA = T.StructType(BASE_FIELDS + ENRICH_FIELDS)
LISTING_COLUMNS = [f.name for f in LISTING_SCHEMA.fields]
LAKE_SCHEMA = T.StructType(LISTING_SCHEMA.fields + [T.StructField("dt", T.DateType(), True)])

# Region dimension as kept in the lookup file: all strings except coordinates.
REGIONS_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType(), True),
    T.StructField("raw_region", T.StringType(), True),
    T.StructField("region_canonical", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("region_group", T.StringType(), True),
])
REGIONS_COLUMNS = [f.name for f in REGIONS_SCHEMA.fields]

# Snapshot summary (one row per snapshot timestamp).
SNAPSHOT_SUMMARY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("total_instances", T.LongType(), False),
    T.StructField("providers_count", T.LongType(), False),
    T.StructField("gpu_types_count", T.LongType(), False),
    T.StructField("min_price", T.DoubleType(), True),
    T.StructField("max_price", T.DoubleType(), True),
    T.StructField("avg_price", T.DoubleType(), True),
    T.StructField("metadata", T.StringType(), True),
])

SNAPSHOT_METADATA_SCHEMA = T.StructType([
    T.StructField("providers", T.ArrayType(T.StringType()), True),
    T.StructField("gpu_types", T.ArrayType(T.StringType()), True),
])

# Snapshot summary as stored, and the manifest (provenance per snapshot); ``dt`` is the Hive partition.
STORED_SUMMARY_SCHEMA = T.StructType(SNAPSHOT_SUMMARY_SCHEMA.fields + [T.StructField("dt", T.DateType(), True)])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("quality_summary", T.StringType(), True),
    T.StructField("digest", T.StringType(), True),
    T.StructField("schema_version", T.StringType(), True),
    T.StructField("emitted_at", T.TimestampType(), True),
    T.StructField("code_version", T.StringType(), True),
    T.StructField("backfilled", T.BooleanType(), True),
    T.StructField("dt", T.DateType(), True),
])
