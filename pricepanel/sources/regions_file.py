"""Region lookup file (S3): all strings, only the empty string is NULL, coordinates numeric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import REGIONS_COLUMNS, REGIONS_SCHEMA
from .lake import path_exists

_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in REGIONS_COLUMNS])


def load_regions(spark: SparkSession, path: str, check_unique: bool = True) -> DataFrame:
    """Read the lookup CSV. A missing file yields an empty frame with the right columns;
    a bad coordinate becomes NULL. Duplicate keys are refused (D15)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REGIONS_SCHEMA)
    raw = (spark.read.schema(_RAW).option("header", True).option("nullValue", "")
           .option("emptyValue", None).option("mode", "PERMISSIVE").csv(path))
    df = raw.select(*[(F.expr(f"try_cast({c} AS DOUBLE)") if c in ("lat", "lon") else F.col(c)).alias(c)
                      for c in REGIONS_COLUMNS])
    if check_unique:
        dup = df.groupBy("provider", "raw_region").count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"region lookup {path} has duplicate (provider, raw_region) keys")
    return df


def write_regions(dimension: DataFrame, path: str) -> None:
    """Write the dimension sorted by key as one CSV file (blank = empty string)."""
    out = dimension.select(*[F.format_number(F.col(c), 4).alias(c) if c in ("lat", "lon") else F.col(c)
                             for c in REGIONS_COLUMNS])
    out = out.select(*[F.regexp_replace(c, ",", "").alias(c) if c in ("lat", "lon") else F.col(c)
                       for c in REGIONS_COLUMNS])
    (out.orderBy("provider", "raw_region").coalesce(1).write.mode("overwrite")
        .option("header", True).option("emptyValue", "").option("nullValue", "").csv(path))
