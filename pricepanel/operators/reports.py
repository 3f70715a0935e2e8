"""Latest-snapshot reports, dashboard KPIs and top-k listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (freshness_state, hours_between, ppgh, price_per_gpu_hour, provider_state, r6)
from ..functions.predicates import gpu_contains, not_unknown_ci, ok
from ..panel import Panel
from ..schema import LISTING_KEY

LATEST_COLUMNS = ["timestamp", "provider", "instance_type", "gpu_type", "gpu_count", "gpu_memory_gb", "vcpus",
                  "ram_gb", "region", "region_canonical", "country", "region_group", "price_per_hour", "is_spot",
                  "available", "availability_zone"]
# Deterministic tie-break for every ordered cut.
TIE_BREAK = ["provider", "instance_type", "region", "is_spot"]


def dataset_stats(panel: Panel) -> DataFrame:
    """A1: first/last snapshot, distinct snapshots, rows, distinct providers and GPU types.

    Rows are reduced to (timestamp, provider, gpu_type) counts first, so the
    three distinct counts run over aggregated cells, not over every listing.
    """
    cells = panel.prices.groupBy("timestamp", "provider", "gpu_type").agg(F.count(F.lit(1)).alias("n"))
    return cells.agg(
        F.min("timestamp").alias("first_snapshot"), F.max("timestamp").alias("last_snapshot"),
        F.count_distinct("timestamp").alias("snapshots"), F.sum("n").alias("total_records"),
        F.count_distinct("provider").alias("providers"), F.count_distinct("gpu_type").alias("gpu_types"))


def latest_snapshot(panel: Panel, provider: str | None = None, only_ok: bool = True) -> DataFrame:
    """the newest snapshot (optionally one provider), with price per GPU-hour."""
    df = panel.latest()
    if only_ok:
        df = ok(df)
    if provider:
        df = df.filter(F.col("provider") == provider)
    return df.select(*LATEST_COLUMNS, ppgh().alias("price_per_gpu_hour"))


def provider_freshness(panel: Panel) -> DataFrame:
    """Per provider last_seen and listings in the newest snapshot, plus a state.

    One pass over the ok rows: the "in latest" count is a conditional count
    against the scalar newest timestamp, equivalent to the left join + 0.
    """
    mx = panel.max_ts()
    a = ok(panel.prices).groupBy("provider").agg(
        F.max("timestamp").alias("last_seen"),
        F.count_if(F.col("timestamp") == mx).alias("listings_in_latest"))
    age = hours_between(mx, F.col("last_seen"))
    return a.select("provider", "last_seen", "listings_in_latest",
                    provider_state("listings_in_latest", age).alias("state"))


def filter_options(panel: Panel) -> DataFrame:
    """Popularity-ordered distinct GPU types, providers and (non-null) region groups.

    One scan: ok rows are counted per (gpu_type, provider, region_group)
    cell (map-side combined), then each cell emits its count under the three
    kinds. ``rank`` orders by count desc, then value.
    """
    cells = ok(panel.prices).groupBy("gpu_type", "provider", "region_group").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value"))
                      for k in ("gpu_type", "provider", "region_group")])
    long = cells.select("n", F.inline(kinds)).filter(F.col("value").isNotNull())
    counts = long.groupBy("kind", "value").agg(F.sum("n").alias("listings"))
    w = Window.partitionBy("kind").orderBy(F.col("listings").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(w))


def summary_by_gpu(panel: Panel) -> DataFrame:
    """Newest snapshot by GPU: instances, sorted provider list, min/max/avg price, best $/GPU-h."""
    return panel.latest().groupBy("gpu_type").agg(
        F.count(F.lit(1)).alias("instances"),
        F.array_join(F.array_sort(F.collect_set("provider")), ", ").alias("providers"),
        F.min("price_per_hour").alias("min_price"), F.max("price_per_hour").alias("max_price"),
        r6(F.avg("price_per_hour")).alias("avg_price"),
        F.min(price_per_gpu_hour()).alias("best_price_per_gpu_hour"))


def summary_by_provider(panel: Panel) -> DataFrame:
    """A10: newest snapshot by provider: instances, distinct GPU types, min/max/avg price."""
    return panel.latest().groupBy("provider").agg(
        F.count(F.lit(1)).alias("instances"), F.count_distinct("gpu_type").alias("gpu_types"),
        F.min("price_per_hour").alias("min_price"), F.max("price_per_hour").alias("max_price"),
        r6(F.avg("price_per_hour")).alias("avg_price"))


def availability_by_region(panel: Panel) -> DataFrame:
    """Newest snapshot by region: total GPUs, distinct types, most common type by GPUs
    (ties to the smaller name, D7). Two-level aggregation, both map-side combined."""
    per_type = panel.latest().groupBy("region", "gpu_type").agg(F.sum("gpu_count").alias("gpus"))
    return per_type.groupBy("region").agg(
        F.sum("gpus").alias("total_gpus"), F.count(F.lit(1)).alias("gpu_types"),
        F.min_by("gpu_type", F.struct(-F.col("gpus"), F.col("gpu_type"))).alias("top_gpu"),
        F.max("gpus").alias("top_gpu_count"))


def gpu_summary(panel: Panel, exclude_unknown: bool = True) -> DataFrame:
    """Newest snapshot per GPU: count, avg/min/max $/GPU-h (record form), providers."""
    df = panel.latest()
    if exclude_unknown:
        df = df.filter(not_unknown_ci())
    p = price_per_gpu_hour()
    return df.groupBy("gpu_type").agg(
        F.count(F.lit(1)).alias("count"), r6(F.avg(p)).alias("avg_price_per_gpu"),
        F.min(p).alias("min_price_per_gpu"), F.max(p).alias("max_price_per_gpu"),
        F.count_distinct("provider").alias("providers"))


def top_gpus(summary: DataFrame, top_n: int = 25) -> DataFrame:
    """The ``top_n`` types by count (ties by name), ranked by count and by average price."""
    top = summary.orderBy(F.col("count").desc(), F.col("gpu_type")).limit(top_n)
    return (top.withColumn("count_rank", F.row_number().over(Window.orderBy(F.col("count").desc(), "gpu_type")))
               .withColumn("price_rank", F.row_number().over(Window.orderBy("avg_price_per_gpu", "gpu_type"))))


def top_gpus_by_count(summary: DataFrame, top_n: int = 25) -> DataFrame:
    """The ``top_n`` most listed types, ranked by count (ties by name)."""
    top = summary.orderBy(F.col("count").desc(), F.col("gpu_type")).limit(top_n)
    return top.withColumn("count_rank", F.row_number().over(Window.orderBy(F.col("count").desc(), "gpu_type")))


def top_gpus_by_price(summary: DataFrame, top_n: int = 25) -> DataFrame:
    """The same ``top_n`` types re-ranked by average $/GPU-h (cheapest first)."""
    top = summary.orderBy(F.col("count").desc(), F.col("gpu_type")).limit(top_n)
    return top.withColumn("price_rank", F.row_number().over(Window.orderBy("avg_price_per_gpu", "gpu_type")))


def snapshots_window(summary: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Snapshot summaries inside the lookback, metadata parsed from JSON."""
    from ..schema import SNAPSHOT_METADATA_SCHEMA
    anchor = F.lit(as_of).cast("timestamp") if as_of is not None else summary.select(F.max("timestamp")).scalar()
    s = summary.filter(F.col("timestamp") >= anchor - F.make_dt_interval(F.lit(days)))
    meta = F.from_json("metadata", SNAPSHOT_METADATA_SCHEMA)
    return s.select("timestamp", "total_instances", "providers_count", "gpu_types_count", "min_price",
                    "max_price", "avg_price",
                    F.array_join(meta.providers, ",").alias("providers"),
                    F.size(meta.gpu_types).alias("gpu_types_listed"))


def latest_kpi(panel: Panel) -> DataFrame:
    """Newest snapshot KPIs: listings and median $/GPU-hour (ok rows).

    The median is exact and computed in bounded pieces (no single task holds
    the whole snapshot); it enters the one-row result as a scalar subquery.
    """
    from .quantiles import exact_median
    rows = ok(panel.latest())
    med = exact_median(rows, [], ppgh(), "m").select("m").scalar()
    return rows.agg(F.count(F.lit(1)).alias("listings")).select(
        "listings", r6(med).alias("median_price_per_gpu_hour"))


def cheapest_families(panel: Panel, n: int = 10, by_day: bool = True) -> DataFrame:
    """Cheapest ``n`` families in the newest day (``dt`` prunes to one partition)."""
    if by_day:
        last_dt = panel.snapshots.select(F.max("dt")).scalar()
        df = panel.prices.filter(F.col("dt") == last_dt)
    else:
        df = panel.latest()
    a = ok(df).groupBy("gpu_type").agg(F.round(F.avg(ppgh()), 3).alias("usd_per_gpu_hour"),
                                       F.count(F.lit(1)).alias("listings"))
    return a.orderBy("usd_per_gpu_hour", "gpu_type").limit(n)


def top10_per_gpu(panel: Panel, k: int = 10) -> DataFrame:
    """Per GPU type the ``k`` cheapest listings by price, plus how many more exist."""
    w = Window.partitionBy("gpu_type").orderBy("price_per_hour", *TIE_BREAK)
    df = panel.latest().select("gpu_type", "provider", "instance_type", "gpu_count", "vcpus", "ram_gb", "region",
                               "is_spot", "price_per_hour", price_per_gpu_hour().alias("price_per_gpu_hour"))
    ranked = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    more = panel.latest().groupBy("gpu_type").agg(F.greatest(F.count(F.lit(1)) - k, F.lit(0)).alias("more"))
    return ranked.join(more, "gpu_type")


def best_deals(panel: Panel, gpu_type: str | None = None, limit: int = 10) -> DataFrame:
    """The ``limit`` lowest $/GPU-h listings of the newest snapshot, optional substring match."""
    df = panel.latest()
    if gpu_type:
        df = df.filter(gpu_contains(gpu_type))
    df = df.select("provider", "instance_type", "gpu_type", "gpu_count", "vcpus", "ram_gb", "region", "is_spot",
                   "price_per_hour", price_per_gpu_hour().alias("price_per_gpu_hour"))
    return df.orderBy("price_per_gpu_hour", "gpu_type", *TIE_BREAK).limit(limit)


def best_deals_batch(panel: Panel, patterns: list[str], limit: int = 10) -> DataFrame:
    """Best deals for each of several GPU patterns at once.

    Each listing emits one row per pattern it matches (a generator, not a
    join); a per-pattern row_number keeps the ``limit`` cheapest, and Spark
    trims each pattern to ``limit`` rows map-side before the shuffle.
    """
    pats = F.array(*[F.lit(p.upper()) for p in patterns])
    df = panel.latest().select("*", F.explode(F.filter(pats, lambda p: F.upper("gpu_type").contains(p)))
                               .alias("pattern"))
    df = df.select("pattern", "provider", "instance_type", "gpu_type", "gpu_count", "region", "is_spot",
                   "price_per_hour", price_per_gpu_hour().alias("price_per_gpu_hour"))
    w = Window.partitionBy("pattern").orderBy("price_per_gpu_hour", "gpu_type", *TIE_BREAK)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def relative_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Value relative to the column maximum (a scalar subquery, not a global window)."""
    mx = df.select(F.max(col)).scalar()
    return df.withColumn(out or f"{col}_rel", r6(F.try_divide(F.col(col), mx)))


def dataset_freshness(panel: Panel, as_of) -> DataFrame:
    """P10: age of the newest snapshot at ``as_of`` and its state (fresh/stale/outdated)."""
    s = panel.snapshots.agg(F.max("timestamp").alias("last_snapshot"))
    age = hours_between(F.lit(as_of).cast("timestamp"), F.col("last_snapshot"))
    return s.select("last_snapshot", r6(age).alias("age_hours"), freshness_state(age).alias("state"))


def collection_cadence(panel: Panel) -> DataFrame:
    """Span of the collection (days + hours) and mean interval between snapshots.

    Reads the manifest (one row per snapshot), not the listings.
    """
    s = panel.snapshots.agg(F.min("timestamp").alias("first_snapshot"), F.max("timestamp").alias("last_snapshot"),
                            F.count(F.lit(1)).alias("snapshots"))
    secs = F.unix_micros("last_snapshot") / 1_000_000 - F.unix_micros("first_snapshot") / 1_000_000
    return s.select("first_snapshot", "last_snapshot", "snapshots",
                    F.floor(secs / 86400).cast("long").alias("duration_days"),
                    F.floor((secs % 86400) / 3600).cast("long").alias("duration_hours"),
                    r6(F.when(F.col("snapshots") > 1, secs / (F.col("snapshots") - 1) / 3600)).alias("avg_interval_hours"))


def default_families(panel: Panel, n: int = 6) -> DataFrame:
    """T5: the ``n`` most listed GPU types among ok rows (ties by name)."""
    return (ok(panel.prices).groupBy("gpu_type").agg(F.count(F.lit(1)).alias("listings"))
            .orderBy(F.col("listings").desc(), "gpu_type").limit(n))


def trends_default_families(panel: Panel, days: int = 30, n: int = 6) -> DataFrame:
    """T5: daily trends restricted to the default families (semi join on <= n rows)."""
    from .trends import trends_daily
    return trends_daily(panel, days).join(F.broadcast(default_families(panel, n).select("gpu_type")),
                                          "gpu_type", "left_semi")
