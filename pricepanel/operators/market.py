"""Market findings of the offline deck."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ppgh, r6
from ..functions.predicates import market_base
from ..panel import Panel
from .canonical import region_lookup_for_join
from .quantiles import exact_median


def _gpu(panel: Panel) -> DataFrame:
    """F8: priced GPU offers only."""
    return panel.prices.filter(market_base())


def headline(panel: Panel) -> DataFrame:
    """GPU listings, distinct days/providers/types, first/last day and total rows.

    The rows are first reduced to (dt, provider, gpu_type) counts (map-side
    combined); the distinct counts then run over those few aggregated rows
    instead of expanding every listing once per distinct aggregate.
    """
    base = market_base()
    cells = panel.prices.groupBy("dt", "provider", "gpu_type").agg(
        F.count_if(base).alias("g"), F.count(F.lit(1)).alias("t"))
    hit = F.col("g") > 0
    return cells.agg(
        F.sum("g").alias("gpu_listings"),
        F.count_distinct(F.when(hit, F.col("dt"))).alias("days"),
        F.count_distinct(F.when(hit, F.col("provider"))).alias("providers"),
        F.count_distinct(F.when(hit, F.col("gpu_type"))).alias("gpu_types"),
        F.min(F.when(hit, F.col("dt"))).alias("start"),
        F.max(F.when(hit, F.col("dt"))).alias("end"),
        F.sum("t").alias("total_rows"))


def median_series(panel: Panel, families: list[str]) -> DataFrame:
    """Daily median on-demand $/GPU-h per family, all families in one grouped query."""
    df = _gpu(panel).filter(~F.col("is_spot") & F.col("gpu_type").isin(*families))
    m = exact_median(df.withColumn("day", F.col("dt")), ["gpu_type", "day"], ppgh(), "median_price")
    return m.select("gpu_type", "day", r6("median_price").alias("median_price"))


def median_series_gaps(series: DataFrame, max_gap_days: int = 7) -> DataFrame:
    """Null the point that follows a gap of more than ``max_gap_days`` days.

    The window runs per family over the already-aggregated daily series.
    """
    w = Window.partitionBy("gpu_type").orderBy("day")
    gap = F.datediff("day", F.lag("day").over(w))
    return series.withColumn("median_price", F.when(gap > max_gap_days, F.lit(None)).otherwise(F.col("median_price")))


def median_first_last(series: DataFrame) -> DataFrame:
    """Per family first and last point of the (gap-broken) series, rounded to 2 (D17: last may be NULL)."""
    return series.groupBy("gpu_type").agg(
        F.round(F.min_by("median_price", "day"), 2).alias("first"),
        F.round(F.max_by("median_price", "day"), 2).alias("last"))


def price_ladder(panel: Panel, families: list[str]) -> DataFrame:
    """Median on-demand $/GPU-h and listings per family."""
    df = _gpu(panel).filter(~F.col("is_spot") & F.col("gpu_type").isin(*families))
    m = exact_median(df, ["gpu_type"], ppgh(), "p", "n")
    return m.select("gpu_type", r6("p").alias("p"), "n")


def spot_savings(panel: Panel, families: list[str]) -> DataFrame:
    """Median spot vs on-demand per family and the discount in %.

    One pass computes the medians per (type, spot flag); a small pivot puts
    the two side by side (types with both sides only), instead of joining
    two separately computed aggregates.
    """
    m = exact_median(_gpu(panel).filter(F.col("gpu_type").isin(*families)), ["gpu_type", "is_spot"], ppgh(), "m")
    a = m.groupBy("gpu_type").agg(F.max(F.when(F.col("is_spot"), F.col("m"))).alias("sp"),
                                  F.max(F.when(~F.col("is_spot"), F.col("m"))).alias("op"))
    a = a.filter(F.col("sp").isNotNull() & F.col("op").isNotNull())
    return a.select(F.col("gpu_type").alias("g"), r6("op").alias("op"), r6("sp").alias("sp"),
                    r6(100 * (1 - F.col("sp") / F.col("op"))).alias("disc"))


def provider_compare(panel: Panel, gpu_type: str, min_n: int = 50) -> DataFrame:
    """Median on-demand $/GPU-h per provider for one type, providers with more than ``min_n`` rows."""
    df = _gpu(panel).filter((F.col("gpu_type") == gpu_type) & ~F.col("is_spot"))
    a = exact_median(df, ["provider"], ppgh(), "p", "n")
    return a.filter(F.col("n") > min_n).select("provider", r6("p").alias("p"), "n")


def provider_spread(compare: DataFrame) -> DataFrame:
    """Cheapest and dearest provider of a comparison and their price ratio."""
    a = compare.agg(
        F.min_by("provider", F.struct("p", "provider")).alias("cheapest"), F.min("p").alias("cheapest_p"),
        F.max_by("provider", F.struct("p", F.col("provider"))).alias("dearest"), F.max("p").alias("dearest_p"))
    return a.filter(F.col("cheapest").isNotNull()).select(
        "cheapest", F.round("cheapest_p", 2).alias("cheapest_price"), "dearest",
        F.round("dearest_p", 2).alias("dearest_price"),
        F.round(F.col("dearest_p") / F.col("cheapest_p"), 1).alias("ratio"))


def region_group_median(panel: Panel, gpu_type: str, min_n: int = 30) -> DataFrame:
    """Median on-demand $/GPU-h per region group for one type (mapped listings only)."""
    lk = region_lookup_for_join(panel.regions).select("provider", "region", F.col("region_group").alias("rg"))
    df = panel.prices.select("provider", "region", "gpu_type", "gpu_count", "price_per_hour", "is_spot").filter(
        (F.col("gpu_count") > 0) & (F.col("price_per_hour") > 0) & (F.col("gpu_type") == gpu_type)
        & ~F.col("is_spot"))
    j = df.join(lk, ["provider", "region"], "inner").filter(F.col("rg").isNotNull())
    a = exact_median(j, ["rg"], ppgh(), "p", "n")
    return a.filter(F.col("n") > min_n).select("rg", r6("p").alias("p"), "n")


def provider_share(panel: Panel, top: int = 7) -> DataFrame:
    """GPU listings per provider: the ``top`` providers by count, the rest summed as 'other'."""
    counts = _gpu(panel).groupBy("provider").agg(F.count(F.lit(1)).alias("n"))
    rk = F.row_number().over(Window.orderBy(F.col("n").desc(), "provider"))
    ranked = counts.withColumn("rk", rk)
    label = F.when(F.col("rk") <= top, F.col("provider")).otherwise(F.lit("other"))
    return ranked.groupBy(label.alias("label")).agg(F.sum("n").alias("listings"), F.min("rk").alias("rank"))


def provider_top(panel: Panel, top: int = 8) -> DataFrame:
    """The ``top`` providers by GPU listings (ties by name)."""
    return (_gpu(panel).groupBy("provider").agg(F.count(F.lit(1)).alias("listings"))
            .orderBy(F.col("listings").desc(), "provider").limit(top))


def _long(metric: str, df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(F.lit(metric).alias("metric"), F.col(key).alias("key"), F.col(value).cast("double").alias("value"))


def findings(panel: Panel, ladder: list[str], savings: list[str], geo_rows: DataFrame) -> DataFrame:
    """K9: the deck's figures as one long frame (metric, key, value); ``df.write.json`` is the sink."""
    from .geo import concentration

    def melted(metric: str, df: DataFrame, columns: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in columns])
        return df.select(F.lit(metric).alias("metric"), F.inline(pairs))

    out = melted("headline", headline(panel), ["gpu_listings", "days", "providers", "gpu_types", "total_rows"])
    for part in (_long("ladder", price_ladder(panel, ladder), "gpu_type", "p"),
                 _long("spot_savings", spot_savings(panel, savings), "g", "disc"),
                 _long("provider_share", provider_top(panel), "provider", "listings"),
                 melted("concentration", concentration(geo_rows), ["top3_share_pct", "n_metros"])):
        out = out.unionByName(part)
    return out
