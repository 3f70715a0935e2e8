"""Time-series operators of the dashboard and the history CLI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import availability_label, day, ppgh, r6, region_display
from ..functions.predicates import all_of, listing_filters, optional_equals, ok
from ..panel import Panel


def _ppgh_stats(p="p"):
    return [r6(F.avg(p)).alias("avg_price_per_gpu_hour"),
            F.min(p).alias("min_price_per_gpu_hour"),
            F.max(p).alias("max_price_per_gpu_hour"),
            F.count(F.lit(1)).alias("listings")]


def price_trends(panel: Panel, gpu_type=None, provider=None, days: int = 30, as_of=None) -> DataFrame:
    """A2: per snapshot avg/min/max of the SKU price and a count, all rows, optional filters."""
    df = panel.since(days, as_of).filter(all_of(optional_equals(gpu_type=gpu_type, provider=provider)))
    return df.groupBy("timestamp").agg(
        r6(F.avg("price_per_hour")).alias("avg_price"),
        F.min("price_per_hour").alias("min_price"),
        F.max("price_per_hour").alias("max_price"),
        F.count(F.lit(1)).alias("instance_count"))


def trends_daily(panel: Panel, days: int = 30, gpu_types=(), providers=(), region_groups=(),
                 is_spot=None, as_of=None) -> DataFrame:
    """A3: per day x gpu_type avg/min/max price per GPU-hour and listings."""
    df = ok(panel.since(days, as_of)).filter(all_of(listing_filters(gpu_types, providers, region_groups, is_spot)))
    return (df.select(day().alias("day"), "gpu_type", ppgh().alias("p"))
              .groupBy("day", "gpu_type").agg(*_ppgh_stats()))


def regional_dispersion(panel: Panel, gpu_type: str, provider: str, days: int = 30, as_of=None) -> DataFrame:
    """A4: per day x region (canonical, else raw) x group for one (gpu, provider)."""
    df = ok(panel.since(days, as_of)).filter((F.col("gpu_type") == gpu_type) & (F.col("provider") == provider))
    return (df.select(day().alias("day"), region_display().alias("region"), "region_group", ppgh().alias("p"))
              .groupBy("day", "region", "region_group").agg(*_ppgh_stats()))


def regional_cv(dispersion: DataFrame) -> DataFrame:
    """A5: cross-region coefficient of variation per day (sample std / mean); n=1 dropped."""
    a = dispersion.groupBy("day").agg(
        F.avg("avg_price_per_gpu_hour").alias("mean"),
        F.stddev_samp("avg_price_per_gpu_hour").alias("std"),
        F.count(F.lit(1)).alias("regions"))
    return a.filter(F.col("std").isNotNull() & ~F.isnan("std")).select(
        "day", r6("mean").alias("mean"), r6("std").alias("std"), "regions",
        r6(F.try_divide("std", "mean")).alias("cv"))


def _spot_pairs(panel: Panel, gpu_type, days, as_of, quality_on_spot=True) -> DataFrame:
    """Spot rows of one type paired with on-demand rows of the same SKU/snapshot.

    Only the spot side carries the type/quality filter (D2). The lookback is
    applied to both sides: they are joined on timestamp equality, so the
    on-demand bound is implied and lets its scan prune partitions too.
    """
    win = panel.prices if days is None else panel.since(days, as_of)
    s = win.filter(F.col("is_spot") & (F.col("gpu_type") == gpu_type))
    if quality_on_spot:
        s = ok(s)
    od = win.filter(~F.col("is_spot"))
    key = ["timestamp", "provider", "instance_type", "region"]
    s = s.select(*key, F.col("price_per_hour").alias("s_price"), F.col("gpu_count").alias("s_gpus"))
    od = od.select(*key, F.col("price_per_hour").alias("od_price"), F.col("gpu_count").alias("od_gpus"))
    return s.join(od, key, "inner")


def spot_spread(panel: Panel, gpu_type: str, days: int = 30, as_of=None) -> DataFrame:
    """Per day x provider: avg spot and on-demand $/GPU-h, avg spread, pairs.

    The spread divides by the *spot* gpu_count as the dashboard does (D2);
    a zero on-demand count yields NULL instead of an ANSI error (D4).
    """
    j = _spot_pairs(panel, gpu_type, days, as_of)
    return j.groupBy(day().alias("day"), "provider").agg(
        r6(F.avg(ppgh("s_price", "s_gpus"))).alias("spot_price"),
        r6(F.avg(ppgh("od_price", "od_gpus"))).alias("on_demand_price"),
        r6(F.avg(F.try_divide(F.col("od_price") - F.col("s_price"), F.col("s_gpus")))).alias("spread"),
        F.count(F.lit(1)).alias("pairs"))


def spot_spread_raw(panel: Panel, gpu_type: str, days: int | None = None, as_of=None) -> DataFrame:
    """A6 (documented starter query): difference of average SKU prices per day and provider;
    no normalisation, no quality gate, whole history unless ``days`` is given."""
    j = _spot_pairs(panel, gpu_type, days, as_of, quality_on_spot=False)
    return j.groupBy(day().alias("day"), "provider").agg(
        r6(F.avg("od_price") - F.avg("s_price")).alias("spread"))


def price_history(panel: Panel, instance_type: str, provider: str, region: str, days: int = 7,
                  as_of=None) -> DataFrame:
    """F11 + P9: one SKU's price path with the tri-state availability label."""
    df = panel.since(days, as_of).filter(all_of(optional_equals(
        provider=provider, instance_type=instance_type, region=region)))
    return df.select("timestamp", "price_per_hour", "available", availability_label().alias("available_label"))


def price_history_stats(history: DataFrame, value: str = "price_per_hour") -> DataFrame:
    """Points, current (newest), min, max, avg, change and change % vs the first point."""
    # several offers may share a stamp (spot and on-demand): of these the lowest is the first, the highest the last
    at = F.struct("timestamp", value)
    first = F.min_by(value, at)
    last = F.max_by(value, at)
    a = history.agg(F.count(F.lit(1)).alias("points"), last.alias("current"), first.alias("first"),
                    F.min(value).alias("min_price"), F.max(value).alias("max_price"),
                    r6(F.avg(value)).alias("avg_price"))
    a = a.filter(F.col("points") > 0)
    change = F.when(F.col("points") > 1, F.col("current") - F.col("first"))
    return a.select("points", r6("current").alias("current"), "min_price", "max_price", "avg_price",
                    r6(change).alias("change"),
                    r6(F.try_divide(change, F.col("first")) * 100).alias("change_pct"))


def price_trend_stats(trends: DataFrame) -> DataFrame:
    """Over a per-snapshot trend: snapshots, current/lowest/highest avg, change, %."""
    a = trends.agg(F.count(F.lit(1)).alias("snapshots"), F.max_by("avg_price", "timestamp").alias("current"),
                   F.min_by("avg_price", "timestamp").alias("first"),
                   F.min("avg_price").alias("lowest"), F.max("avg_price").alias("highest"))
    a = a.filter(F.col("snapshots") > 0)
    change = F.when(F.col("snapshots") > 1, F.col("current") - F.col("first"))
    return a.select("snapshots", "current", "lowest", "highest", r6(change).alias("change"),
                    r6(F.try_divide(change, F.col("first")) * 100).alias("change_pct"))


def trend_day_guard(trends: DataFrame) -> DataFrame:
    """The trend plus the number of distinct days it spans (a chart needs >= 2)."""
    n_days = trends.select(F.count_distinct("day")).scalar()
    return trends.withColumn("distinct_days", n_days)


def daily_spot_price(panel: Panel, gpu_type: str) -> DataFrame:
    """A33 (starter query): daily avg spot $/GPU-hour and listings for one type."""
    df = panel.prices.filter((F.col("gpu_type") == gpu_type) & F.col("is_spot"))
    return df.groupBy(day().alias("day")).agg(r6(F.avg(ppgh())).alias("avg_price_per_gpu_hour"),
                                              F.count(F.lit(1)).alias("listings"))


def regional_index_raw(panel: Panel, gpu_type: str, provider: str) -> DataFrame:
    """A34 (starter query): daily avg $/GPU-hour per raw region for one (type, provider)."""
    df = panel.prices.filter((F.col("gpu_type") == gpu_type) & (F.col("provider") == provider))
    return df.groupBy(day().alias("day"), "region").agg(r6(F.avg(ppgh())).alias("avg_price_per_gpu_hour"))
