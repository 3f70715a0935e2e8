"""Region dimension maintenance: resolution cascade (J6), refresh keeping hand edits (J7),
pair discovery (A31) and coverage (A32).

Resolution runs on the *distinct* (provider, raw_region) pairs, never on
listings. Every rule that looks a key up in a per-provider table becomes one
candidate row; a single join against the rule table finds all hits and the
first hit in rule order wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import REGIONS_COLUMNS

# Rule order of the cascade (lower wins).
EXACT, UPPER, LOWER, GCP_ZONE, AWS_PARENT4, AWS_PARENT3, COUNTRY = range(7)

_VALUES = ["region_canonical", "country", "lat", "lon", "region_group"]


def region_pairs(listings: DataFrame) -> DataFrame:
    """Distinct (provider, raw_region) pairs seen in the listings."""
    return listings.select("provider", F.col("region").alias("raw_region")).distinct()


def _table_candidates(pairs: DataFrame) -> DataFrame:
    raw = F.col("raw_region")
    parts = F.split(raw, "-")
    n = F.size(parts)
    zone = F.regexp_extract(raw, r"^(.+)-\p{L}$", 1)
    cands = F.array(
        F.struct(F.lit(EXACT).alias("rule"), raw.alias("key")),
        F.struct(F.lit(UPPER).alias("rule"), F.upper(raw).alias("key")),
        F.struct(F.lit(LOWER).alias("rule"), F.lower(raw).alias("key")),
        F.struct(F.lit(GCP_ZONE).alias("rule"),
                 F.when((F.col("provider") == "gcp") & (F.length(raw) > 2) & (zone != ""), zone).alias("key")),
        F.struct(F.lit(AWS_PARENT4).alias("rule"),
                 F.when((F.col("provider") == "aws") & (n > 4), F.array_join(F.slice(parts, 1, 4), "-")).alias("key")),
        F.struct(F.lit(AWS_PARENT3).alias("rule"),
                 F.when((F.col("provider") == "aws") & (n > 3), F.array_join(F.slice(parts, 1, 3), "-")).alias("key")),
    )
    return pairs.select("provider", "raw_region", F.inline(cands)).filter(F.col("key").isNotNull())


def _country_candidates(pairs: DataFrame) -> DataFrame:
    segs = F.filter(F.split(F.upper(F.col("raw_region")), "-"), lambda p: p.rlike(r"^\p{L}{2}$"))
    return pairs.select("provider", "raw_region", F.posexplode(segs).alias("pos", "code"))


def resolve_regions(pairs: DataFrame, provider_rules: DataFrame, country_rules: DataFrame) -> DataFrame:
    """Map each (provider, raw_region) to (canonical, country, lat, lon, group).

    Cascade: exact -> upper -> lower key in the provider's table; for gcp the
    zone-stripped name; for aws the 4- then 3-segment parent (canonical gets
    ``-zone``); else the first 2-letter segment that is a known country code
    (canonical NULL); else unmapped (all NULL). Empty or NULL names are unmapped.

    ``provider_rules``: provider, key, region_canonical, country, lat, lon, region_group.
    ``country_rules``: code, country, lat, lon, region_group (aliases are extra rows).
    """
    valid = pairs.filter(F.col("raw_region").isNotNull() & (F.col("raw_region") != ""))
    # Rule tables are joined without a hint: the planner broadcasts them while
    # their size estimate is under the broadcast threshold, AQE re-checks the
    # real size, and a large table falls back to a shuffle join.
    prules = provider_rules.select("provider", "key", *_VALUES)
    crules = country_rules.select("code", "country", "lat", "lon", "region_group")

    t_hits = _table_candidates(valid).join(prules, ["provider", "key"]).select(
        "provider", "raw_region", "rule", F.lit(0).alias("pos"),
        F.when(F.col("rule").isin(AWS_PARENT4, AWS_PARENT3), F.concat("region_canonical", F.lit("-zone")))
         .otherwise(F.col("region_canonical")).alias("region_canonical"),
        "country", "lat", "lon", "region_group")
    c_hits = _country_candidates(valid).join(crules, "code").select(
        "provider", "raw_region", F.lit(COUNTRY).alias("rule"), "pos",
        F.lit(None).cast("string").alias("region_canonical"), "country", "lat", "lon", "region_group")
    hits = t_hits.unionByName(c_hits)
    best = hits.groupBy("provider", "raw_region").agg(
        F.min_by(F.struct(*_VALUES, "rule"), F.struct("rule", "pos")).alias("m"))
    out = pairs.join(best, ["provider", "raw_region"], "left")
    return out.select("provider", "raw_region", *[F.col(f"m.{c}").alias(c) for c in _VALUES],
                      F.col("m.rule").alias("rule"))


def regions_refresh(pairs: DataFrame, existing: DataFrame, provider_rules: DataFrame,
                    country_rules: DataFrame) -> DataFrame:
    """The new dimension: existing rows win (even blank ones), new pairs are
    resolved, pairs no longer seen drop out. Keys compare as plain strings (D23)."""
    key = (pairs.provider.eqNullSafe(existing.provider)) & (pairs.raw_region.eqNullSafe(existing.raw_region))
    kept = existing.alias("e").join(pairs.alias("p"), (F.col("e.provider").eqNullSafe(F.col("p.provider")))
                                    & (F.col("e.raw_region").eqNullSafe(F.col("p.raw_region"))), "left_semi")
    new = pairs.join(existing, key, "left_anti")
    resolved = resolve_regions(new, provider_rules, country_rules).select(
        "provider", "raw_region", "region_canonical", "country",
        F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"), "region_group")
    return kept.select(*REGIONS_COLUMNS).unionByName(resolved)


def region_coverage(dimension: DataFrame) -> DataFrame:
    """How many pairs are mapped (have a region group) and how many are not."""
    mapped = F.col("region_group").isNotNull() & (F.col("region_group") != "")
    return dimension.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(mapped).alias("mapped"),
                         F.count_if(~mapped | F.col("region_group").isNull()).alias("unmapped"))


def unmapped_pairs(dimension: DataFrame) -> DataFrame:
    """The pairs still without a mapping."""
    mapped = F.col("region_group").isNotNull() & (F.col("region_group") != "")
    return dimension.filter(~mapped | F.col("region_group").isNull()).select("provider", "raw_region")


def duplicate_keys(dimension: DataFrame) -> DataFrame:
    """Keys that occur more than once (they would fan out the enrichment join)."""
    return dimension.groupBy("provider", "raw_region").count().filter("count > 1")
