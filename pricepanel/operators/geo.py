"""Geographic supply findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import metro, metro_label, ppgh, r6
from ..panel import Panel


def geo_base(panel: Panel, country: str | None = None, region_group: str | None = None) -> DataFrame:
    """Mapped listings of one country (or region group) with metro and coordinates."""
    r = panel.regions.filter(F.col("region_canonical").isNotNull())
    if country:
        r = r.filter(F.col("country") == country)
    if region_group:
        r = r.filter(F.col("region_group") == region_group)
    r = r.select("provider", F.col("raw_region").alias("region"), metro().alias("metro"), "lat", "lon")
    g = panel.prices.select("provider", "region", "gpu_type", "is_spot", "gpu_count", "price_per_hour").filter(
        (F.col("gpu_count") > 0) & (F.col("price_per_hour") > 0) & (F.col("gpu_type") != "Unknown"))
    return g.join(r, ["provider", "region"], "inner").select(
        "gpu_type", "is_spot", ppgh().alias("ppgh"), "metro", "lat", "lon")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("lat2", F.round("lat", 2)).withColumn("lon2", F.round("lon", 2))


def supply_clusters(geo: DataFrame) -> DataFrame:
    """Listings and distinct GPU types per rounded coordinate, with relative size."""
    a = _rounded(geo).groupBy(F.col("lat2").alias("lat"), F.col("lon2").alias("lon")).agg(
        F.count(F.lit(1)).alias("listings"), F.count_distinct("gpu_type").alias("gtypes"))
    mx = a.select(F.max("listings")).scalar()
    return a.withColumn("size_rel", r6(F.col("listings") / mx))


def top_hubs(geo: DataFrame, n: int = 9) -> DataFrame:
    """Per coordinate the biggest metro (ties by name) and total listings, top ``n``."""
    # counted at the raw coordinate, as collected; only the choice and the total are per rounded coordinate
    per_metro = _rounded(geo.groupBy("lat", "lon", "metro").agg(F.count(F.lit(1)).alias("n")))
    hubs = per_metro.groupBy(F.col("lat2").alias("lat"), F.col("lon2").alias("lon")).agg(
        F.min_by("metro", F.struct(-F.col("n"), F.col("metro"))).alias("metro"), F.sum("n").alias("listings"))
    top = hubs.orderBy(F.col("listings").desc(), "lat", "lon").limit(n)
    return top.withColumn("label", metro_label("metro"))


def cluster_metro_window(geo: DataFrame) -> DataFrame:
    """Per coordinate listings, GPU types and the metro with most rows.

    The reference counts rows per (coordinate, metro) with a window over the
    raw rows; here the same count is taken after a partial aggregation to
    (coordinate, metro, gpu_type), so no single hot metro lands in one task.
    """
    fine = _rounded(geo).groupBy("lat2", "lon2", "metro", "gpu_type").agg(F.count(F.lit(1)).alias("n"))
    cnt = F.sum("n").over(Window.partitionBy("lat2", "lon2", "metro"))
    fine = fine.withColumn("cnt", cnt)
    return fine.groupBy(F.col("lat2").alias("lat"), F.col("lon2").alias("lon")).agg(
        F.sum("n").alias("listings"), F.count_distinct("gpu_type").alias("gtypes"),
        F.min_by("metro", F.struct(-F.col("cnt"), F.col("metro"))).alias("metro"))


def gpu_metro_matrix(geo: DataFrame, families: list[str], n_metros: int = 12, n_types: int = 11) -> DataFrame:
    """Listings per (family, metro) for the top metros and top families; absent cells are 0.

    The grid is built by exploding the (bounded) top-metro list onto the
    top-family rows, then left-joined to the counts.
    """
    counts = geo.groupBy("gpu_type", "metro").agg(F.count(F.lit(1)).alias("n"))
    metros = counts.groupBy("metro").agg(F.sum("n").alias("c")).orderBy(F.col("c").desc(), "metro").limit(n_metros)
    types = (counts.filter(F.col("gpu_type").isin(*families)).groupBy("gpu_type").agg(F.sum("n").alias("c"))
             .orderBy(F.col("c").desc(), "gpu_type").limit(n_types))
    metro_list = metros.agg(F.collect_list("metro")).scalar()
    grid = types.select("gpu_type", F.explode(metro_list).alias("metro"))
    return grid.join(counts, ["gpu_type", "metro"], "left").select(
        "gpu_type", "metro", F.coalesce("n", F.lit(0)).alias("n"))


def footprints(geo: DataFrame, families: list[str]) -> DataFrame:
    """Per family listings and distinct metros (one grouped query for all families)."""
    return geo.filter(F.col("gpu_type").isin(*families)).groupBy("gpu_type").agg(
        F.count(F.lit(1)).alias("listings"), F.count_distinct("metro").alias("sites"))


def footprint_points(geo: DataFrame, families: list[str]) -> DataFrame:
    """Listings per family and rounded coordinate."""
    return (_rounded(geo).filter(F.col("gpu_type").isin(*families))
            .groupBy("gpu_type", F.col("lat2").alias("lat"), F.col("lon2").alias("lon"))
            .agg(F.count(F.lit(1)).alias("n")))


def concentration(geo: DataFrame, top: int = 3) -> DataFrame:
    """Share (%) of listings in the ``top`` metros and number of metros."""
    m = geo.groupBy("metro").agg(F.count(F.lit(1)).alias("n"))
    topn = m.orderBy(F.col("n").desc(), "metro").limit(top).agg(F.sum("n").alias("top_n"))
    tot = m.agg(F.sum("n").alias("tot"), F.count(F.lit(1)).alias("n_metros"))
    top_sum = topn.select("top_n").scalar()
    return tot.select(F.round(100 * top_sum / F.col("tot"), 1).alias("top3_share_pct"), "n_metros")


def metro_labels(geo: DataFrame) -> DataFrame:
    """Distinct metros with their short display label."""
    return geo.select("metro").distinct().select("metro", metro_label("metro").alias("label"))
