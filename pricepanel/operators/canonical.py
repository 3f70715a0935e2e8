"""Canonical listing view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quality_view
from ..schema import BASE_COLUMNS, REGION_COLUMNS

def region_lookup_for_join(regions: DataFrame, region_col: str = "region") -> DataFrame:
    """Rename the lookup file's columns to the names they take on a listing."""
    return regions.select(
        "provider",
        F.col("raw_region").alias(region_col),
        "region_canonical", "country",
        F.col("lat").alias("region_lat"), F.col("lon").alias("region_lon"),
        "region_group",
    )


def enrich_regions(df: DataFrame, regions: DataFrame, region_col: str = "region") -> DataFrame:
    """Add canonical region fields via a left join on (provider, region).

    Existing enriched columns are replaced; unmapped rows get NULLs. NULL
    keys never match (SQL rule, D23). ``regions`` must be unique on its key.
    """
    keep = [c for c in df.columns if c not in REGION_COLUMNS]
    lk = region_lookup_for_join(regions, region_col)
    return df.select(*keep).join(lk, on=["provider", region_col], how="left").select(*keep, *REGION_COLUMNS)


def migrate_defaults(df: DataFrame) -> DataFrame:
    """Columns added by migrations, with their defaults where absent or NULL."""
    out = df
    for name, default in (("is_spot", F.lit(False)), ("quality", F.lit("ok"))):
        out = out.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)
    return out


def canonical_prices(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """One canonical view over any vintage of the listing lake.

    Base columns are kept if present; ``quality`` is synthesized where the
    file had none (or NULL); region columns fall back to the lookup.

    The lookup is made visibly unique on its key (duplicates are refused when
    the file is loaded, D15), so for queries that use no region column
    Catalyst removes the join altogether. The join strategy is the planner's:
    broadcast while the lookup's statistics allow it, shuffled beyond.
    """
    cols = set(raw.columns)
    lk = region_lookup_for_join(regions).dropDuplicates(["provider", "region"]).select(
        "provider", "region", *[F.col(c).alias(f"_r_{c}") for c in REGION_COLUMNS])
    base = [c for c in BASE_COLUMNS + ["dt"] if c in cols]
    q = quality_view()
    quality = F.coalesce(F.col("quality"), q) if "quality" in cols else q
    region_parts = [
        (F.coalesce(F.col(c), F.col(f"_r_{c}")) if c in cols else F.col(f"_r_{c}")).alias(c)
        for c in REGION_COLUMNS
    ]
    joined = raw.join(lk, on=["provider", "region"], how="left")
    return joined.select(*base, quality.alias("quality"), *region_parts)
