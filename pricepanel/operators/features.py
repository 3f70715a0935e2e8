"""Modelling frames the methodology describes (M1-M8): supply, spreads, co-movement,
generation gaps, lag/rolling features, collection gaps, quantiles and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day, market_segment as _segment, ppgh, r6
from ..functions.predicates import ok
from ..panel import Panel


def supply_panel(panel: Panel) -> DataFrame:
    """M1: listings per (timestamp, gpu_type, provider)."""
    return panel.prices.groupBy("timestamp", "gpu_type", "provider").agg(F.count(F.lit(1)).alias("listings"))


def spread_ratio(panel: Panel) -> DataFrame:
    """M2: per (gpu_type, region, provider) with both sides: avg spot and on-demand $/GPU-h,
    their difference and ratio (spot side gated on quality)."""
    key = ["timestamp", "provider", "instance_type", "region"]
    s = ok(panel.prices.filter(F.col("is_spot"))).select(*key, "gpu_type", ppgh().alias("sp"))
    od = panel.prices.filter(~F.col("is_spot")).select(*key, ppgh().alias("op"))
    a = s.join(od, key).groupBy("gpu_type", "region", "provider").agg(
        F.avg("sp").alias("spot"), F.avg("op").alias("od"), F.count(F.lit(1)).alias("pairs"))
    return a.select("gpu_type", "region", "provider", r6("spot").alias("spot_price"),
                    r6("od").alias("on_demand_price"), r6(F.col("od") - F.col("spot")).alias("spread"),
                    r6(F.try_divide(F.col("od"), F.col("spot"))).alias("ratio"), "pairs")


def provider_corr(panel: Panel, gpu_type: str, min_days: int = 3) -> DataFrame:
    """M3: Pearson correlation of each provider's daily mean $/GPU-h with the mean of all others' offers.

    One row per provider: the others' mean of a day is the day's total less
    the provider's own, so no provider is paired with another and the plan
    does not grow with their number.
    """
    own = ok(panel.prices.filter(F.col("gpu_type") == gpu_type)).groupBy(day().alias("day"), "provider").agg(
        F.sum(ppgh()).alias("s"), F.count(ppgh()).alias("n"))
    whole = own.groupBy("day").agg(F.sum("s").alias("day_s"), F.sum("n").alias("day_n"))
    daily = own.join(whole, "day").filter(F.col("day_n") > F.col("n")).select(
        "provider", (F.col("s") / F.col("n")).alias("p"),
        ((F.col("day_s") - F.col("s")) / (F.col("day_n") - F.col("n"))).alias("rest"))
    return daily.groupBy("provider").agg(F.corr("p", "rest").alias("c"), F.count(F.lit(1)).alias("n_days")).filter(
        F.col("n_days") >= min_days).select("provider", r6(F.when(~F.isnan("c"), F.col("c"))).alias("corr"), "n_days")


def generation_gap(panel: Panel, newer: str, older: str) -> DataFrame:
    """M4: per day the avg $/GPU-h of two types and their ratio (days with both)."""
    p = ppgh()
    a = ok(panel.prices.filter(F.col("gpu_type").isin(newer, older))).groupBy(day().alias("day")).agg(
        F.avg(F.when(F.col("gpu_type") == newer, p)).alias("n"), F.avg(F.when(F.col("gpu_type") == older, p)).alias("o"))
    return a.filter(F.col("n").isNotNull() & F.col("o").isNotNull()).select(
        "day", r6("n").alias("newer_price"), r6("o").alias("older_price"), r6(F.col("n") / F.col("o")).alias("gap_ratio"))


def feature_frame(panel: Panel, window: int = 3) -> DataFrame:
    """M5: per (gpu_type, snapshot): price, listings, cross-provider CV, lags, rolling CV,
    day of week and hour. Windows run per type over the aggregated series."""
    per_prov = ok(panel.prices).groupBy("gpu_type", "timestamp", "provider").agg(
        F.sum(ppgh()).alias("s"), F.count(F.lit(1)).alias("n"))
    per_prov = per_prov.withColumn("pm", F.col("s") / F.col("n"))
    snap = per_prov.groupBy("gpu_type", "timestamp").agg(
        (F.sum("s") / F.sum("n")).alias("price"), F.sum("n").alias("listings"),
        F.try_divide(F.stddev_samp("pm"), F.avg("pm")).alias("provider_cv"))
    w = Window.partitionBy("gpu_type").orderBy("timestamp")
    roll = w.rowsBetween(-(window - 1), 0)
    return snap.select(
        "gpu_type", "timestamp", r6("price").alias("price"), "listings", r6("provider_cv").alias("provider_cv"),
        r6(F.lag("price").over(w)).alias("lag_price"), F.lag("listings").over(w).alias("lag_listings"),
        r6(F.try_divide(F.stddev_samp("price").over(roll), F.avg("price").over(roll))).alias("rolling_cv"),
        F.dayofweek("timestamp").alias("day_of_week"), F.hour("timestamp").alias("hour"))


def _slot(step_hours: int):
    """The slot a snapshot belongs to: its stamp floored to a grid of ``step_hours`` from midnight UTC.

    Collectors stamp the moment they run, some minutes into the slot."""
    return F.window("timestamp", f"{step_hours} hours").getField("start")


def gap_mask(panel: Panel, step_hours: int = 12, min_outage_days: int = 2) -> DataFrame:
    """M6: every expected slot, whether it was collected, and whether it lies in a
    multi-day outage (a run of at least ``min_outage_days`` days without any snapshot).

    The windows run over the day calendar, whose length is set by the time
    span, not by the number of listings.
    """
    seen = panel.snapshots.select(_slot(step_hours).alias("timestamp")).distinct().withColumn("observed", F.lit(True))
    step = F.make_dt_interval(F.lit(0), F.lit(step_hours))
    calendar = seen.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", step)).alias("timestamp"))
    slots = calendar.join(seen, "timestamp", "left").select(
        "timestamp", day().alias("day"), F.coalesce("observed", F.lit(False)).alias("observed"))
    days = slots.groupBy("day").agg(F.max(F.col("observed").cast("int")).alias("day_seen"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    seen_day = F.when(F.col("day_seen") == 1, F.col("day"))
    days = days.select("day", "day_seen", F.max(seen_day).over(before).alias("prev"),
                       F.min(seen_day).over(after).alias("next"))
    run = F.datediff("next", "prev") - 1
    days = days.select("day", F.coalesce((F.col("day_seen") == 0) & (run >= min_outage_days), F.lit(False))
                       .alias("outage"))
    return slots.join(days, "day").select("timestamp", "day", "observed", "outage")


def within_day_fill(panel: Panel, step_hours: int = 12) -> DataFrame:
    """M6: per (gpu_type, provider) series of avg $/GPU-h on every slot of a collected day;
    a missing slot takes the last earlier value of the same day, never across days."""
    obs = ok(panel.prices).withColumn("slot", _slot(step_hours)).groupBy("gpu_type", "provider", "slot").agg(
        r6(F.avg(ppgh())).alias("price")).withColumnRenamed("slot", "timestamp")
    mask = gap_mask(panel, step_hours)
    day_slots = mask.groupBy("day").agg(F.max(F.col("observed").cast("int")).alias("seen"),
                                        F.collect_list("timestamp").alias("slots")).filter("seen = 1")
    series_days = obs.select("gpu_type", "provider", day().alias("day")).distinct()
    grid = series_days.join(day_slots, "day").select("gpu_type", "provider", "day",
                                                     F.explode("slots").alias("timestamp"))
    g = grid.join(obs, ["gpu_type", "provider", "timestamp"], "left")
    w = Window.partitionBy("gpu_type", "provider", "day").orderBy("timestamp").rowsBetween(
        Window.unboundedPreceding, 0)
    return g.select("gpu_type", "provider", "timestamp", "price",
                    F.last("price", ignorenulls=True).over(w).alias("filled_price"),
                    F.col("price").isNull().alias("was_missing"))


def series_outages(panel: Panel, step_hours: int = 12, min_slots: int = 2) -> DataFrame:
    """M6: the outages of every (gpu_type, provider) series: runs of at least ``min_slots`` slots without a price.

    Gaps and islands: the listings are reduced to the slots of each series, and a run lies between two slots
    that follow one another (``ended``), or between a series' last slot and the panel's end (still open).
    A window holds the slots of one series, so it grows with the calendar, not with the listings."""
    step = F.make_dt_interval(F.lit(0), F.lit(step_hours))
    slots = ok(panel.prices).select("gpu_type", "provider", _slot(step_hours).alias("slot")).distinct()
    end = panel.snapshots.select(F.max(_slot(step_hours))).scalar()
    after = F.lead("slot").over(Window.partitionBy("gpu_type", "provider").orderBy("slot"))
    runs = slots.withColumn("next", after).select(
        "gpu_type", "provider", (F.col("slot") + step).alias("outage_start"),
        F.coalesce("next", end + step).alias("outage_end"), F.col("next").isNotNull().alias("ended"))
    missing = F.floor((F.unix_timestamp("outage_end") - F.unix_timestamp("outage_start")) / (step_hours * 3600))
    return runs.withColumn("missing_slots", missing).filter(F.col("missing_slots") >= min_slots)


def provider_pairs(panel: Panel, per_type: int = 8, named: list[str] | None = None, min_days: int = 3) -> DataFrame:
    """M3: co-movement of pairs of providers, of every type: covariance and correlation of their daily mean $/GPU-h.

    The ``per_type`` providers with the most listings of a type are paired (ties by name), or exactly the ``named``
    ones, so a day of a type makes a bounded number of pairs. They come from one array a day, not from a join of
    the series with itself, and the centred co-moments of a pair merge from task to task."""
    daily = ok(panel.prices).groupBy("gpu_type", "provider", day().alias("day")).agg(
        F.sum(ppgh()).alias("s"), F.count(ppgh()).alias("n")).filter("n > 0")
    if named is not None:
        chosen = daily.filter(F.col("provider").isin(*named))
    else:
        rank = F.row_number().over(Window.partitionBy("gpu_type").orderBy(F.col("listings").desc(), "provider"))
        top = daily.groupBy("gpu_type", "provider").agg(F.sum("n").alias("listings")).withColumn("rank", rank).filter(
            F.col("rank") <= per_type)
        chosen = daily.join(top.select("gpu_type", "provider"), ["gpu_type", "provider"], "left_semi")
    series = chosen.groupBy("gpu_type", "day").agg(F.array_sort(F.collect_list(
        F.struct("provider", F.round(F.col("s") / F.col("n"), 9).alias("p")))).alias("v"))
    pairs = F.flatten(F.transform("v", lambda a, i: F.transform(
        F.slice("v", i + 2, F.size("v")), lambda b: F.struct(
            a["provider"].alias("provider_a"), b["provider"].alias("provider_b"), a["p"].alias("pa"), b["p"].alias("pb")))))
    moments = series.select("gpu_type", F.inline(pairs)).groupBy("gpu_type", "provider_a", "provider_b").agg(
        F.count(F.lit(1)).alias("n_days"), F.covar_samp("pa", "pb").alias("cov"), F.corr("pa", "pb").alias("c"))
    return moments.filter(F.col("n_days") >= min_days).select(
        "gpu_type", "provider_a", "provider_b", "n_days", r6("cov").alias("covariance"),
        r6(F.when(~F.isnan("c"), F.col("c"))).alias("correlation"))


def feature_frame_hours(panel: Panel, step_hours: int = 12, lag_hours: int = 24, window_hours: int = 48) -> DataFrame:
    """M5 on the clock: lags and rolling features that follow hours, not rows, across snapshots that are missing.

    ``RANGE`` frames over the slot: the lag is the price exactly ``lag_hours`` before (NULL if that slot was not
    collected), the rolling features cover the slots of the last ``window_hours`` that are there."""
    snap = ok(panel.prices).groupBy("gpu_type", _slot(step_hours).alias("slot"), "provider").agg(
        F.sum(ppgh()).alias("s"), F.count(F.lit(1)).alias("n")).groupBy("gpu_type", "slot").agg(
        (F.sum("s") / F.sum("n")).alias("price"), F.sum("n").alias("listings"))
    over = "OVER (PARTITION BY gpu_type ORDER BY slot RANGE BETWEEN INTERVAL {} HOURS PRECEDING AND {})"
    lag = over.format(lag_hours, f"INTERVAL {lag_hours} HOURS PRECEDING")
    roll = over.format(window_hours, "CURRENT ROW")
    return snap.select(
        "gpu_type", "slot", r6("price").alias("price"), "listings", r6(F.expr(f"max(price) {lag}")).alias("lag_price"),
        F.expr(f"max(listings) {lag}").alias("lag_listings"), F.expr(f"count(price) {roll}").alias("rolling_slots"),
        r6(F.expr(f"avg(price) {roll}")).alias("rolling_price"),
        r6(F.try_divide(F.expr(f"stddev_samp(price) {roll}"), F.expr(f"avg(price) {roll}"))).alias("rolling_cv"))


QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9]


def spot_quantiles(panel: Panel, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """M7: spot $/GPU-h quantiles per type. Exact by default, computed in bounded
    pieces (see ``quantiles``); ``approx=True`` uses a one-pass sketch instead."""
    from .quantiles import exact_quantiles
    names = [f"q{int(x * 100)}" for x in QUANTILES]
    rows = ok(panel.prices.filter(F.col("is_spot")))
    if approx:
        a = rows.groupBy("gpu_type").agg(F.percentile_approx(ppgh(), QUANTILES, accuracy).alias("q"),
                                         F.count(F.lit(1)).alias("n"))
        return a.select("gpu_type", "n", *[r6(F.col("q")[i]).alias(n) for i, n in enumerate(names)])
    a = exact_quantiles(rows, ["gpu_type"], ppgh(), QUANTILES, names=names, count_name="n")
    return a.select("gpu_type", "n", *[r6(n).alias(n) for n in names])


def market_segment(panel: Panel) -> DataFrame:
    """M8: hyperscaler vs marketplace bucket x spot flag: listings and avg $/GPU-h."""
    return ok(panel.prices).groupBy(_segment().alias("segment"), "is_spot").agg(
        F.count(F.lit(1)).alias("listings"), r6(F.avg(ppgh())).alias("avg_price_per_gpu_hour"))
