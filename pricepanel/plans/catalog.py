"""Registered queries: each runs a library operator over a panel derived from
the driver tables, paired (where SQL can say it) with an oracle query.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame``; ``ORACLES[name] = sql``.
Parameters that the reference hard-codes for its own data (GPU family lists,
HAVING thresholds, country) are substituted by values present in the test
panel (FIXTURES.md), and passed to the operators as ordinary arguments.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions.columns import (METRO_REPLACEMENTS, PROVIDER_ALIASES, day, normalize_provider, ppgh, price_per_gpu_hour, quality_at_ingest,
                                 quality_backfill, quality_view, snapshot_filename)
from ..operators import geo, market, reports, trends
from ..session import configure
from .oracle import f1, f2, f2_gaps
from .pipeline import panel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        run.__name__ = run.__qualname__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- parameters substituted for the reference's literals -------------------
DAYS = 365                       # snapshots are monthly in the listing panel
GPU = "red plate"                # the single-family queries
GPU_DISP, PROV_DISP = "red widget", "aws"
FAMILIES = ["red plate", "small widget", "red widget", "hot gizmo", "hot bolt", "large rod", "hot plate"]
LADDER = FAMILIES + ["old rod", "blue ring", "blue widget", "small anvil", "blue gizmo", "hot ring"]
SAVINGS = LADDER[:9]
AS_OF = "2001-12-01 00:00:00"
SKU = ("standard-0", "aws", "NATION_9")
PATTERNS = ["RED", "HOT", "WIDGET", "BLUE W"]


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


LOOKBACK = f"timestamp >= (SELECT MAX(timestamp) FROM prices) - INTERVAL {DAYS} DAY"
PPGH = "price_per_hour / NULLIF(gpu_count, 0)"
GPU_BASE = "gpu_count > 0 AND price_per_hour > 0 AND gpu_type <> 'Unknown'"
LATEST = "timestamp = (SELECT MAX(timestamp) FROM prices)"


def L(spark, sf_dir):
    return panel(spark, sf_dir, "listings")


def E(spark, sf_dir):
    return panel(spark, sf_dir, "events")


def EG(spark, sf_dir):
    """The events panel with an outage and jittered stamps: for the gap queries only."""
    return panel(spark, sf_dir, "event_gaps")


# Every listing with its rate and its age against the newest snapshot, for the oracles below.
_RATED = f"""
, rated AS (
  SELECT *, CASE WHEN gpu_count <> 0 THEN price_per_hour / gpu_count END AS rate,
         max(timestamp) OVER () - timestamp <= INTERVAL {DAYS} DAY AS recent,
         gpu_count > 0 AND price_per_hour > 0 AND gpu_type <> 'Unknown' AS priced
  FROM prices)"""
# Both offers of a SKU in a snapshot side by side: the key holds one offer of each kind.
_SIDES = _RATED + """
, sides AS (
  SELECT timestamp, provider, instance_type, region, bool_or(recent) AS recent,
         any_value(gpu_type) FILTER (is_spot) AS spot_type, any_value(quality) FILTER (is_spot) AS spot_quality,
         any_value(gpu_count) FILTER (is_spot) AS spot_gpus, any_value(price_per_hour) FILTER (is_spot) AS spot_price,
         any_value(price_per_hour) FILTER (NOT is_spot) AS list_price, any_value(gpu_count) FILTER (NOT is_spot) AS list_gpus
  FROM rated GROUP BY ALL HAVING count(*) = 2)"""


# ============================== canonical view ===============================
CANON_COLS = ("timestamp, provider, instance_type, gpu_type, gpu_count, gpu_memory_gb, vcpus, ram_gb, region, "
              "price_per_hour, is_spot, available, availability_zone, dt, quality, region_canonical, country, "
              "region_lat, region_lon, region_group")

register("canonical_prices", f1(f"SELECT {CANON_COLS} FROM prices"))(lambda s, d: L(s, d).prices)


# ============================== trends (dashboard) ===========================
_DAILY = """
SELECT dt AS day, gpu_type, round(avg(rate), 6) AS avg_price_per_gpu_hour, min(rate) AS min_price_per_gpu_hour,
       max(rate) AS max_price_per_gpu_hour, count(*) AS listings
FROM rated WHERE recent AND quality = 'ok' GROUP BY dt, gpu_type"""
register("trends_daily", f1(_RATED + _DAILY))(lambda s, d: trends.trends_daily(L(s, d), DAYS))

register("trend_day_guard", f1(_RATED + f""", daily AS ({_DAILY})
SELECT *, (SELECT count(DISTINCT day) FROM daily) AS distinct_days FROM daily"""))(
    lambda s, d: trends.trend_day_guard(trends.trends_daily(L(s, d), DAYS)))

register("filter_listings", f1(f"""
SELECT {CANON_COLS.replace('dt, ', '')}, price_per_hour / gpu_count AS price_per_gpu_hour FROM prices
WHERE {LATEST} AND quality = 'ok' AND provider IN ('aws', 'gcp', 'oci') AND region_group IN ('ASIA', 'EUROPE')
  AND is_spot = FALSE"""))(
    lambda s, d: _filter_listings(L(s, d)))


def _filter_listings(p):
    from pyspark.sql import functions as F
    from ..functions.columns import ppgh
    from ..functions.predicates import all_of, listing_filters, ok
    df = ok(p.latest()).filter(all_of(listing_filters((), ["aws", "gcp", "oci"], ["ASIA", "EUROPE"], False)))
    return df.drop("dt").withColumn("price_per_gpu_hour", ppgh()).orderBy(F.col("price_per_gpu_hour"))


_BY_PLACE = _RATED + f"""
, places AS (
  SELECT dt AS day, COALESCE(region_canonical, region) AS region, region_group, round(avg(rate), 6) AS avg_price_per_gpu_hour,
         min(rate) AS min_price_per_gpu_hour, max(rate) AS max_price_per_gpu_hour, count(*) AS listings
  FROM rated WHERE recent AND quality = 'ok' AND provider = '{PROV_DISP}' AND gpu_type = '{GPU_DISP}' GROUP BY ALL)"""
register("regional_dispersion", f1(_BY_PLACE + " SELECT * FROM places"))(
    lambda s, d: trends.regional_dispersion(L(s, d), GPU_DISP, PROV_DISP, DAYS))
register("regional_cv", f1(_BY_PLACE + """
, spread AS (SELECT day, count(*) AS regions, avg(avg_price_per_gpu_hour) AS m, stddev_samp(avg_price_per_gpu_hour) AS sd
             FROM places GROUP BY day)
SELECT day, round(m, 6) AS mean, round(sd, 6) AS std, regions, round(sd / m, 6) AS cv FROM spread WHERE sd IS NOT NULL"""))(
    lambda s, d: trends.regional_cv(trends.regional_dispersion(L(s, d), GPU_DISP, PROV_DISP, DAYS)))

register("spot_spread", f1(_SIDES + f"""
SELECT CAST(timestamp AS DATE) AS day, provider, round(avg(spot_price / NULLIF(spot_gpus, 0)), 6) AS spot_price,
       round(avg(list_price / NULLIF(list_gpus, 0)), 6) AS on_demand_price,
       round(avg((list_price - spot_price) / NULLIF(spot_gpus, 0)), 6) AS spread, count(*) AS pairs
FROM sides WHERE recent AND spot_type = '{GPU}' AND spot_quality = 'ok' GROUP BY ALL"""))(
    lambda s, d: trends.spot_spread(L(s, d), GPU, DAYS))
register("spot_spread_raw", f1(_SIDES + f"""
SELECT CAST(timestamp AS DATE) AS day, provider, round(avg(list_price) - avg(spot_price), 6) AS spread
FROM sides WHERE spot_type = '{GPU}' GROUP BY ALL"""))(lambda s, d: trends.spot_spread_raw(L(s, d), GPU))

_PT_SQL = f"""
SELECT timestamp, round(AVG(price_per_hour), 6) AS avg_price, MIN(price_per_hour) AS min_price,
       MAX(price_per_hour) AS max_price, COUNT(*) AS instance_count
FROM prices WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS * 3} DAY AND provider = 'aws' GROUP BY timestamp"""
register("price_trends", f1(_PT_SQL))(lambda s, d: trends.price_trends(L(s, d), None, "aws", DAYS * 3, AS_OF))
register("price_trend_stats", f1(f""", t AS ({_PT_SQL}),
a AS (SELECT COUNT(*) AS snapshots, arg_max(avg_price, timestamp) AS cur, arg_min(avg_price, timestamp) AS fst,
             MIN(avg_price) AS lowest, MAX(avg_price) AS highest FROM t)
SELECT snapshots, cur AS current, lowest, highest,
       round(CASE WHEN snapshots > 1 THEN cur - fst END, 6) AS change,
       round(CASE WHEN snapshots > 1 THEN cur - fst END / NULLIF(fst, 0) * 100, 6) AS change_pct
FROM a WHERE snapshots > 0"""))(
    lambda s, d: trends.price_trend_stats(trends.price_trends(L(s, d), None, "aws", DAYS * 3, AS_OF)))

_PH_SQL = f"""
SELECT timestamp, price_per_hour, available,
       CASE WHEN available THEN 'yes' WHEN NOT available THEN 'no' ELSE 'unknown' END AS available_label
FROM prices WHERE provider = '{SKU[1]}' AND instance_type = '{SKU[0]}' AND region = '{SKU[2]}'
  AND timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 3650 DAY"""
register("price_history", f1(_PH_SQL))(lambda s, d: trends.price_history(L(s, d), *SKU, days=3650, as_of=AS_OF))
register("price_history_stats", f1(f""", h AS ({_PH_SQL}),
a AS (SELECT COUNT(*) AS points, max({{'t': timestamp, 'p': price_per_hour}}).p AS cur,
             min({{'t': timestamp, 'p': price_per_hour}}).p AS fst,
             MIN(price_per_hour) AS min_price, MAX(price_per_hour) AS max_price,
             round(AVG(price_per_hour), 6) AS avg_price FROM h)
SELECT points, round(cur, 6) AS current, min_price, max_price, avg_price,
       round(CASE WHEN points > 1 THEN cur - fst END, 6) AS change,
       round(CASE WHEN points > 1 THEN cur - fst END / NULLIF(fst, 0) * 100, 6) AS change_pct
FROM a WHERE points > 0"""))(
    lambda s, d: trends.price_history_stats(trends.price_history(L(s, d), *SKU, days=3650, as_of=AS_OF)))

register("daily_spot_price", f1(f"""
SELECT CAST(timestamp AS DATE) AS day, round(AVG({PPGH}), 6) AS avg_price_per_gpu_hour, COUNT(*) AS listings
FROM prices WHERE gpu_type = '{GPU}' AND is_spot GROUP BY 1"""))(lambda s, d: trends.daily_spot_price(L(s, d), GPU))
register("regional_index_raw", f1(f"""
SELECT CAST(timestamp AS DATE) AS day, region, round(AVG({PPGH}), 6) AS avg_price_per_gpu_hour
FROM prices WHERE gpu_type = '{GPU}' AND provider = 'aws' GROUP BY 1, 2"""))(
    lambda s, d: trends.regional_index_raw(L(s, d), GPU, "aws"))


# ============================== reports =====================================
register("dataset_stats", f1("""
SELECT MIN(timestamp) AS first_snapshot, MAX(timestamp) AS last_snapshot, COUNT(DISTINCT timestamp) AS snapshots,
       COUNT(*) AS total_records, COUNT(DISTINCT provider) AS providers, COUNT(DISTINCT gpu_type) AS gpu_types
FROM prices"""))(lambda s, d: reports.dataset_stats(L(s, d)))

register("latest_snapshot", f1(f"""
SELECT timestamp, provider, instance_type, gpu_type, gpu_count, gpu_memory_gb, vcpus, ram_gb, region,
       region_canonical, country, region_group, price_per_hour, is_spot, available, availability_zone,
       price_per_hour / gpu_count AS price_per_gpu_hour
FROM prices WHERE {LATEST} AND quality = 'ok'"""))(lambda s, d: reports.latest_snapshot(L(s, d)))

register("provider_freshness", f2("""
, mx AS (SELECT MAX(timestamp) AS m FROM prices),
a AS (SELECT provider, MAX(timestamp) AS last_seen,
             CAST(count_if(timestamp = (SELECT m FROM mx)) AS BIGINT) AS listings_in_latest
      FROM prices WHERE quality = 'ok' GROUP BY provider)
SELECT provider, last_seen, listings_in_latest,
       CASE WHEN listings_in_latest > 0 THEN 'green'
            WHEN (epoch_us((SELECT m FROM mx)) - epoch_us(last_seen)) / 3600000000.0 <= 168 THEN 'yellow'
            ELSE 'red' END AS state
FROM a"""))(lambda s, d: reports.provider_freshness(E(s, d)))

register("filter_options", f1("""
, long AS (SELECT 'gpu_type' AS kind, gpu_type AS value FROM prices WHERE quality = 'ok'
           UNION ALL SELECT 'provider', provider FROM prices WHERE quality = 'ok'
           UNION ALL SELECT 'region_group', region_group FROM prices WHERE quality = 'ok' AND region_group IS NOT NULL),
c AS (SELECT kind, value, COUNT(*) AS listings FROM long GROUP BY 1, 2)
SELECT kind, value, listings, CAST(row_number() OVER (PARTITION BY kind ORDER BY listings DESC, value) AS INTEGER)
       AS rank FROM c"""))(
    lambda s, d: reports.filter_options(L(s, d)))

register("summary_by_gpu", f1(f"""
SELECT gpu_type, COUNT(*) AS instances, string_agg(DISTINCT provider, ', ' ORDER BY provider) AS providers,
       MIN(price_per_hour) AS min_price, MAX(price_per_hour) AS max_price, round(AVG(price_per_hour), 6) AS avg_price,
       MIN(CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END) AS best_price_per_gpu_hour
FROM prices WHERE {LATEST} GROUP BY gpu_type"""))(lambda s, d: reports.summary_by_gpu(L(s, d)))

register("summary_by_provider", f1(f"""
SELECT provider, COUNT(*) AS instances, COUNT(DISTINCT gpu_type) AS gpu_types, MIN(price_per_hour) AS min_price,
       MAX(price_per_hour) AS max_price, round(AVG(price_per_hour), 6) AS avg_price
FROM prices WHERE {LATEST} GROUP BY provider"""))(lambda s, d: reports.summary_by_provider(L(s, d)))

register("availability_by_region", f1(f"""
, t AS (SELECT region, gpu_type, SUM(gpu_count) AS gpus FROM prices WHERE {LATEST} GROUP BY 1, 2),
r AS (SELECT region, gpu_type, gpus, row_number() OVER (PARTITION BY region ORDER BY gpus DESC, gpu_type) AS rn FROM t)
SELECT region, CAST(SUM(gpus) AS BIGINT) AS total_gpus, COUNT(*) AS gpu_types,
       MAX(CASE WHEN rn = 1 THEN gpu_type END) AS top_gpu, CAST(MAX(gpus) AS BIGINT) AS top_gpu_count
FROM r GROUP BY region"""))(lambda s, d: reports.availability_by_region(L(s, d)))

_GS_SQL = f"""
SELECT gpu_type, COUNT(*) AS count,
       round(AVG(CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END), 6) AS avg_price_per_gpu,
       MIN(CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END) AS min_price_per_gpu,
       MAX(CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END) AS max_price_per_gpu,
       COUNT(DISTINCT provider) AS providers
FROM prices WHERE {LATEST} AND upper(gpu_type) <> 'UNKNOWN' GROUP BY gpu_type"""
register("gpu_summary", f1(_GS_SQL))(lambda s, d: reports.gpu_summary(L(s, d)))
register("top_gpus", f1(f""", g AS ({_GS_SQL}), t AS (SELECT * FROM g ORDER BY count DESC, gpu_type LIMIT 25)
SELECT *, CAST(row_number() OVER (ORDER BY count DESC, gpu_type) AS INTEGER) AS count_rank,
       CAST(row_number() OVER (ORDER BY avg_price_per_gpu, gpu_type) AS INTEGER) AS price_rank FROM t"""))(
    lambda s, d: reports.top_gpus(reports.gpu_summary(L(s, d)), 25))

_K2_SQL = """
SELECT timestamp, COUNT(*) AS total_instances, COUNT(DISTINCT provider) AS providers_count,
       COUNT(DISTINCT gpu_type) AS gpu_types_count, COALESCE(MIN(price_per_hour), 0.0) AS min_price,
       COALESCE(MAX(price_per_hour), 0.0) AS max_price, round(COALESCE(AVG(price_per_hour), 0.0), 6) AS avg_price,
       list_sort(list_distinct(list(provider))) AS pl, list_sort(list_distinct(list(gpu_type))) AS gl
FROM prices GROUP BY timestamp"""
register("snapshot_summary", f1(f""", k AS ({_K2_SQL})
SELECT timestamp, total_instances, providers_count, gpu_types_count, min_price, max_price, avg_price,
       CAST(to_json({{'providers': pl, 'gpu_types': gl}}) AS VARCHAR) AS metadata FROM k"""))(
    lambda s, d: _k2(L(s, d)))
register("snapshots_window", f1(f""", k AS ({_K2_SQL})
SELECT timestamp, total_instances, providers_count, gpu_types_count, min_price, max_price, avg_price,
       array_to_string(pl, ',') AS providers, CAST(len(gl) AS INTEGER) AS gpu_types_listed
FROM k WHERE timestamp >= (SELECT MAX(timestamp) FROM k) - INTERVAL {DAYS} DAY"""))(
    lambda s, d: reports.snapshots_window(_stored_summary(s, d, DAYS), DAYS))


def _k2(p):
    from ..operators.lake import snapshot_summary
    return snapshot_summary(p.prices)


def _stored_summary(s, d, days: int | None = None) -> DataFrame:
    """The stored snapshot summaries, written by two overlapping upserts; only the dates of the last ``days``."""
    from ..operators.lake import read_snapshot_summary, write_snapshot_summary
    root = f"{_root(s, d)}/summary"
    if not is_committed(s, f"{root}/done"):
        p = L(s, d)
        write_snapshot_summary(s, p.prices.filter(F.col("dt") < "1999-01-01"), f"{root}/table")
        write_snapshot_summary(s, p.prices.filter(F.col("dt") >= "1998-06-01"), f"{root}/table")
        s.range(1).write.mode("overwrite").parquet(f"{root}/done")
    table = read_snapshot_summary(s, f"{root}/table")
    if days is not None:
        table = table.filter(F.col("dt") >= F.date_sub(L(s, d).snapshots.select(F.max("dt")).scalar(), days + 1))
    return table.drop("dt")


register("snapshot_summary_stored", f1(f""", k AS ({_K2_SQL})
SELECT timestamp, total_instances, providers_count, gpu_types_count, min_price, max_price, avg_price,
       CAST(to_json({{'providers': pl, 'gpu_types': gl}}) AS VARCHAR) AS metadata FROM k"""))(
    lambda s, d: _stored_summary(s, d))

register("latest_kpi", f1(f"""
SELECT COUNT(*) AS listings, round(median(price_per_hour / gpu_count), 6) AS median_price_per_gpu_hour
FROM prices WHERE {LATEST} AND quality = 'ok'"""))(lambda s, d: reports.latest_kpi(L(s, d)))

register("cheapest_families", f1("""
SELECT gpu_type, round(AVG(price_per_hour / gpu_count), 3) AS usd_per_gpu_hour, COUNT(*) AS listings
FROM prices WHERE dt = (SELECT MAX(dt) FROM prices) AND quality = 'ok'
GROUP BY gpu_type ORDER BY usd_per_gpu_hour, gpu_type LIMIT 10"""))(lambda s, d: reports.cheapest_families(L(s, d)))

_RPPGH = "CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END"
register("top10_per_gpu", f1(f"""
, t AS (SELECT gpu_type, provider, instance_type, gpu_count, vcpus, ram_gb, region, is_spot, price_per_hour,
               {_RPPGH} AS price_per_gpu_hour,
               CAST(row_number() OVER (PARTITION BY gpu_type ORDER BY price_per_hour, provider, instance_type, region,
                                       is_spot) AS INTEGER) AS rank,
               GREATEST(COUNT(*) OVER (PARTITION BY gpu_type) - 10, 0) AS more
        FROM prices WHERE {LATEST})
SELECT * FROM t WHERE rank <= 10"""))(lambda s, d: reports.top10_per_gpu(L(s, d)))

register("best_deals", f1(f"""
SELECT provider, instance_type, gpu_type, gpu_count, vcpus, ram_gb, region, is_spot, price_per_hour,
       {_RPPGH} AS price_per_gpu_hour
FROM prices WHERE {LATEST} AND upper(gpu_type) LIKE '%RED%'
ORDER BY price_per_gpu_hour, gpu_type, provider, instance_type, region, is_spot LIMIT 10"""))(
    lambda s, d: reports.best_deals(L(s, d), "red", 10))

register("best_deals_batch", f1(f"""
, pats AS (SELECT unnest([{_in(PATTERNS)}]) AS pattern),
m AS (SELECT p.pattern, provider, instance_type, gpu_type, gpu_count, region, is_spot, price_per_hour,
             {_RPPGH} AS price_per_gpu_hour
      FROM prices JOIN pats p ON contains(upper(gpu_type), p.pattern) WHERE {LATEST}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY pattern ORDER BY price_per_gpu_hour, gpu_type, provider,
                                   instance_type, region, is_spot) AS INTEGER) AS rank FROM m)
SELECT * FROM r WHERE rank <= 10"""))(lambda s, d: reports.best_deals_batch(L(s, d), PATTERNS, 10))

register("dataset_freshness", f1("""
, m AS (SELECT MAX(timestamp) AS last_snapshot FROM prices)
SELECT last_snapshot, round((epoch_us(TIMESTAMP '2001-10-03 06:00:00') - epoch_us(last_snapshot)) / 3600000000.0, 6) AS age_hours,
       CASE WHEN (epoch_us(TIMESTAMP '2001-10-03 06:00:00') - epoch_us(last_snapshot)) / 3600000000.0 <= 24 THEN 'fresh'
            WHEN (epoch_us(TIMESTAMP '2001-10-03 06:00:00') - epoch_us(last_snapshot)) / 3600000000.0 <= 72 THEN 'stale'
            ELSE 'outdated' END AS state FROM m"""))(
    lambda s, d: reports.dataset_freshness(L(s, d), "2001-10-03 06:00:00"))

register("collection_cadence", f2("""
, s AS (SELECT MIN(timestamp) AS f, MAX(timestamp) AS l, COUNT(DISTINCT timestamp) AS n FROM prices),
x AS (SELECT f, l, n, (epoch_us(l) - epoch_us(f)) / 1000000.0 AS secs FROM s)
SELECT f AS first_snapshot, l AS last_snapshot, n AS snapshots, CAST(floor(secs / 86400) AS BIGINT) AS duration_days,
       CAST(floor((secs % 86400) / 3600) AS BIGINT) AS duration_hours,
       round(CASE WHEN n > 1 THEN secs / (n - 1) / 3600 END, 6) AS avg_interval_hours FROM x"""))(
    lambda s, d: reports.collection_cadence(E(s, d)))

register("trends_default_families", f1(_RATED + f""", daily AS ({_DAILY}),
liked AS (SELECT gpu_type FROM rated WHERE quality = 'ok' GROUP BY gpu_type ORDER BY count(*) DESC, gpu_type LIMIT 6)
SELECT daily.* FROM daily SEMI JOIN liked USING (gpu_type)"""))(
    lambda s, d: reports.trends_default_families(L(s, d), DAYS, 6))


# ============================== market (deck) ===============================
register("headline", f1(f"""
SELECT CAST(count_if({GPU_BASE}) AS BIGINT) AS gpu_listings,
       COUNT(DISTINCT CASE WHEN {GPU_BASE} THEN dt END) AS days,
       COUNT(DISTINCT CASE WHEN {GPU_BASE} THEN provider END) AS providers,
       COUNT(DISTINCT CASE WHEN {GPU_BASE} THEN gpu_type END) AS gpu_types,
       MIN(CASE WHEN {GPU_BASE} THEN dt END) AS start, MAX(CASE WHEN {GPU_BASE} THEN dt END) AS "end",
       COUNT(*) AS total_rows FROM prices"""))(lambda s, d: market.headline(L(s, d)))

_MS_SQL = f"""
SELECT gpu_type, dt AS day, round(median(price_per_hour / gpu_count), 6) AS median_price
FROM prices WHERE {GPU_BASE} AND NOT is_spot AND gpu_type IN ({_in(FAMILIES)}) GROUP BY 1, 2"""
_MSG_SQL = f""", ms AS ({_MS_SQL}),
g AS (SELECT gpu_type, day, CASE WHEN day - lag(day) OVER (PARTITION BY gpu_type ORDER BY day) > 7 THEN NULL
                               ELSE median_price END AS median_price FROM ms)"""
register("median_series", f1(_MS_SQL))(lambda s, d: market.median_series(L(s, d), FAMILIES))
register("median_series_gaps", f1(_MSG_SQL + " SELECT * FROM g"))(
    lambda s, d: market.median_series_gaps(market.median_series(L(s, d), FAMILIES)))
register("median_first_last", f1(_MSG_SQL + """,
o AS (SELECT gpu_type, median_price, row_number() OVER (PARTITION BY gpu_type ORDER BY day) AS a,
             row_number() OVER (PARTITION BY gpu_type ORDER BY day DESC) AS b FROM g)
SELECT gpu_type, round(MAX(CASE WHEN a = 1 THEN median_price END), 2) AS first,
       round(MAX(CASE WHEN b = 1 THEN median_price END), 2) AS last FROM o GROUP BY gpu_type"""))(
    lambda s, d: market.median_first_last(market.median_series_gaps(market.median_series(L(s, d), FAMILIES))))

register("price_ladder", f1(f"""
SELECT gpu_type, round(median(price_per_hour / gpu_count), 6) AS p, COUNT(*) AS n
FROM prices WHERE {GPU_BASE} AND NOT is_spot AND gpu_type IN ({_in(LADDER)}) GROUP BY 1"""))(
    lambda s, d: market.price_ladder(L(s, d), LADDER))

register("spot_savings", f1(_RATED + f"""
, both_kinds AS (SELECT gpu_type, median(rate) FILTER (NOT is_spot) AS listed, median(rate) FILTER (is_spot) AS spot
                 FROM rated WHERE priced AND gpu_type IN ({_in(SAVINGS)}) GROUP BY gpu_type)
SELECT gpu_type AS g, round(listed, 6) AS op, round(spot, 6) AS sp, round(100 * (1 - spot / listed), 6) AS disc
FROM both_kinds WHERE listed IS NOT NULL AND spot IS NOT NULL"""))(
    lambda s, d: market.spot_savings(L(s, d), SAVINGS))

_BY_PROVIDER = _RATED + f"""
, offers AS (SELECT provider, quantile_cont(rate, 0.5) AS m, count(*) AS n FROM rated
             WHERE priced AND NOT is_spot AND gpu_type = '{GPU}' GROUP BY provider),
compared AS (SELECT provider, round(m, 6) AS p, n FROM offers WHERE n > 50)"""
register("provider_compare", f1(_BY_PROVIDER + " SELECT * FROM compared"))(lambda s, d: market.provider_compare(L(s, d), GPU, 50))
register("provider_spread", f1(_BY_PROVIDER + """
, ends AS (SELECT min({'p': p, 'who': provider}) AS low, max({'p': p, 'who': provider}) AS high FROM compared)
SELECT low.who AS cheapest, round(low.p, 2) AS cheapest_price, high.who AS dearest, round(high.p, 2) AS dearest_price,
       round(high.p / low.p, 1) AS ratio FROM ends WHERE low IS NOT NULL"""))(
    lambda s, d: market.provider_spread(market.provider_compare(L(s, d), GPU, 50)))

register("region_group_median", f1(_RATED + f"""
, grouped AS (SELECT region_group AS rg, quantile_cont(rate, 0.5) AS m, count(*) AS n FROM rated
              WHERE gpu_type = '{GPU}' AND gpu_count > 0 AND price_per_hour > 0 AND NOT is_spot GROUP BY region_group)
SELECT rg, round(m, 6) AS p, n FROM grouped WHERE rg IS NOT NULL AND n > 30"""))(
    lambda s, d: market.region_group_median(L(s, d), GPU, 30))

register("provider_top", f1(_RATED + """
SELECT provider, count(*) AS listings FROM rated WHERE priced GROUP BY provider
ORDER BY listings DESC, provider LIMIT 8"""))(lambda s, d: market.provider_top(L(s, d), 8))

register("provider_share", f1(f"""
, c AS (SELECT provider, COUNT(*) AS n FROM prices WHERE {GPU_BASE} GROUP BY 1),
r AS (SELECT provider, n, row_number() OVER (ORDER BY n DESC, provider) AS rk FROM c)
SELECT CASE WHEN rk <= 7 THEN provider ELSE 'other' END AS label, CAST(SUM(n) AS BIGINT) AS listings,
       CAST(MIN(rk) AS INTEGER) AS rank
FROM r GROUP BY 1"""))(lambda s, d: market.provider_share(L(s, d), 7))


# ============================== geography (deck) ============================
_SITES = _RATED + """
, us AS (SELECT gpu_type, is_spot, rate AS ppgh, CASE WHEN ends_with(region_canonical, '-zone')
                THEN left(region_canonical, length(region_canonical) - 5) ELSE region_canonical END AS metro,
                region_lat AS lat, region_lon AS lon, country
         FROM rated WHERE priced AND region_canonical IS NOT NULL)"""
COUNTRY = "NATION_5"


def G(s, d):
    return geo.geo_base(L(s, d))


def _title(col):
    return (f"array_to_string(list_transform(range(1, length({col}) + 1), lambda i: CASE WHEN i = 1 OR NOT "
            f"regexp_matches({col}[i - 1], '^[[:alpha:]]$') THEN upper({col}[i]) ELSE lower({col}[i]) END), '')")


register("geo_base", f1(_SITES + " SELECT * EXCLUDE (country) FROM us"))(G)
register("geo_base_country", f1(_SITES + f" SELECT * EXCLUDE (country) FROM us WHERE country = '{COUNTRY}'"))(
    lambda s, d: geo.geo_base(L(s, d), country=COUNTRY))
register("supply_clusters_country", f1(_SITES + f"""
, spots AS (SELECT round(lat, 2) AS lat, round(lon, 2) AS lon, count(*) AS listings, count(DISTINCT gpu_type) AS gtypes
            FROM us WHERE country = '{COUNTRY}' GROUP BY ALL)
SELECT *, round(listings / max(listings) OVER (), 6) AS size_rel FROM spots"""))(
    lambda s, d: geo.supply_clusters(geo.geo_base(L(s, d), country=COUNTRY)))
register("supply_clusters", f1(_SITES + """
, a AS (SELECT round(lat, 2) AS lat, round(lon, 2) AS lon, COUNT(*) AS listings, COUNT(DISTINCT gpu_type) AS gtypes
      FROM us GROUP BY 1, 2)
SELECT *, round(listings / (SELECT MAX(listings) FROM a), 6) AS size_rel FROM a"""))(
    lambda s, d: geo.supply_clusters(G(s, d)))
_SHORT = "metro"
for _old, _new in METRO_REPLACEMENTS:
    _SHORT = f"replace({_SHORT}, '{_old}', '{_new}')"
register("top_hubs", f1(_SITES + f"""
, exact AS (SELECT lat, lon, metro, count(*) AS n FROM us GROUP BY ALL),
hubs AS (SELECT round(lat, 2) AS lat, round(lon, 2) AS lon, min({{'n': -n, 'metro': metro}}).metro AS metro,
                CAST(sum(n) AS BIGINT) AS listings FROM exact GROUP BY 1, 2 ORDER BY listings DESC, 1, 2 LIMIT 9),
s AS (SELECT *, {_SHORT} AS short FROM hubs)
SELECT lat, lon, metro, listings, {_title('short')} AS label FROM s"""))(lambda s, d: geo.top_hubs(G(s, d), 9))
register("cluster_metro_window", f1(_SITES + """
, spots AS (SELECT round(lat, 2) AS lat, round(lon, 2) AS lon, count(*) AS listings, count(DISTINCT gpu_type) AS gtypes
            FROM us GROUP BY ALL),
named AS (SELECT round(lat, 2) AS lat, round(lon, 2) AS lon, metro, count(*) AS n FROM us GROUP BY 1, 2, 3
          QUALIFY row_number() OVER (PARTITION BY round(lat, 2), round(lon, 2) ORDER BY n DESC, metro) = 1)
SELECT spots.*, named.metro FROM spots JOIN named USING (lat, lon)"""))(
    lambda s, d: geo.cluster_metro_window(G(s, d)))
register("gpu_metro_matrix", f1(_SITES + f"""
, tm AS (SELECT metro FROM us GROUP BY 1 ORDER BY COUNT(*) DESC, metro LIMIT 12),
tg AS (SELECT gpu_type FROM us WHERE gpu_type IN ({_in(LADDER)}) GROUP BY 1 ORDER BY COUNT(*) DESC, gpu_type LIMIT 11),
c AS (SELECT gpu_type, metro, COUNT(*) AS n FROM us GROUP BY 1, 2)
SELECT tg.gpu_type, tm.metro, COALESCE(c.n, 0) AS n
FROM tg CROSS JOIN tm LEFT JOIN c ON c.gpu_type = tg.gpu_type AND c.metro = tm.metro"""))(
    lambda s, d: geo.gpu_metro_matrix(G(s, d), LADDER))
register("footprints", f1(_SITES + f"""
SELECT gpu_type, COUNT(*) AS listings, COUNT(DISTINCT metro) AS sites FROM us
WHERE gpu_type IN ({_in(FAMILIES[:4])}) GROUP BY 1"""))(lambda s, d: geo.footprints(G(s, d), FAMILIES[:4]))
register("footprint_points", f1(_SITES + f"""
SELECT gpu_type, round(lat, 2) AS lat, round(lon, 2) AS lon, COUNT(*) AS n FROM us
WHERE gpu_type IN ({_in(FAMILIES[:4])}) GROUP BY 1, 2, 3"""))(lambda s, d: geo.footprint_points(G(s, d), FAMILIES[:4]))
register("concentration", f1(_SITES + """
, ranked AS (SELECT metro, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, metro) AS place FROM us GROUP BY metro)
SELECT round(100 * sum(n) FILTER (place <= 3) / sum(n), 1) AS top3_share_pct, count(*) AS n_metros FROM ranked"""))(
    lambda s, d: geo.concentration(G(s, d)))
register("metro_label", f1(_SITES + f"""
, s AS (SELECT DISTINCT metro FROM us)
SELECT metro, {_title(_SHORT)} AS label FROM s"""))(lambda s, d: geo.metro_labels(G(s, d)))


# ============================== modelling features ==========================
from ..operators import features  # noqa: E402

register("supply_panel", f1("""
SELECT timestamp, gpu_type, provider, COUNT(*) AS listings FROM prices GROUP BY 1, 2, 3"""))(
    lambda s, d: features.supply_panel(L(s, d)))

register("spread_ratio", f1("""
, j AS (SELECT s.gpu_type, s.region, s.provider, s.price_per_hour / NULLIF(s.gpu_count, 0) AS sp,
               od.price_per_hour / NULLIF(od.gpu_count, 0) AS op
        FROM prices s JOIN prices od ON s.timestamp = od.timestamp AND s.provider = od.provider
         AND s.instance_type = od.instance_type AND s.region = od.region
        WHERE s.is_spot AND NOT od.is_spot AND s.quality = 'ok'),
a AS (SELECT gpu_type, region, provider, AVG(sp) AS spot, AVG(op) AS od, COUNT(*) AS pairs FROM j GROUP BY 1, 2, 3)
SELECT gpu_type, region, provider, round(spot, 6) AS spot_price, round(od, 6) AS on_demand_price,
       round(od - spot, 6) AS spread, round(od / spot, 6) AS ratio, pairs FROM a"""))(
    lambda s, d: features.spread_ratio(L(s, d)))

register("provider_corr", f2("""
, own AS (SELECT dt AS day, provider, sum(price_per_hour / gpu_count) AS s, count(*) AS n
          FROM prices WHERE gpu_type = 'H100' AND quality = 'ok' GROUP BY ALL),
rest AS (SELECT provider, s / n AS p, sum(s) OVER w - s AS others, sum(n) OVER w - n AS others_n FROM own
         WINDOW w AS (PARTITION BY day)),
c AS (SELECT provider, corr(p, others / others_n) AS c, count(*) AS n_days FROM rest WHERE others_n > 0 GROUP BY provider)
SELECT provider, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS corr, n_days FROM c WHERE n_days >= 3"""))(
    lambda s, d: features.provider_corr(E(s, d), "H100"))

register("generation_gap", f2("""
, t AS (SELECT CAST(timestamp AS DATE) AS day, gpu_type, price_per_hour / gpu_count AS p FROM prices
        WHERE quality = 'ok' AND gpu_type IN ('H100', 'A100')),
a AS (SELECT day, AVG(CASE WHEN gpu_type = 'H100' THEN p END) AS n, AVG(CASE WHEN gpu_type = 'A100' THEN p END) AS o
      FROM t GROUP BY day)
SELECT day, round(n, 6) AS newer_price, round(o, 6) AS older_price, round(n / o, 6) AS gap_ratio
FROM a WHERE n IS NOT NULL AND o IS NOT NULL"""))(lambda s, d: features.generation_gap(E(s, d), "H100", "A100"))

register("feature_frame", f2("""
, pp AS (SELECT gpu_type, timestamp, provider, SUM(price_per_hour / gpu_count) AS s, COUNT(*) AS n
         FROM prices WHERE quality = 'ok' GROUP BY 1, 2, 3),
snap AS (SELECT gpu_type, timestamp, SUM(s) / SUM(n) AS price, CAST(SUM(n) AS BIGINT) AS listings,
                stddev_samp(s / n) / NULLIF(AVG(s / n), 0) AS provider_cv FROM pp GROUP BY 1, 2)
SELECT gpu_type, timestamp, round(price, 6) AS price, listings, round(provider_cv, 6) AS provider_cv,
       round(lag(price) OVER w, 6) AS lag_price, lag(listings) OVER w AS lag_listings,
       round(stddev_samp(price) OVER r / NULLIF(AVG(price) OVER r, 0), 6) AS rolling_cv,
       CAST(dayofweek(timestamp) + 1 AS INT) AS day_of_week, CAST(hour(timestamp) AS INT) AS hour
FROM snap
WINDOW w AS (PARTITION BY gpu_type ORDER BY timestamp),
       r AS (PARTITION BY gpu_type ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))(
    lambda s, d: features.feature_frame(E(s, d)))

_GAP = """
, slotted AS (SELECT *, time_bucket(INTERVAL 12 HOUR, timestamp, TIMESTAMP '2000-01-01') AS slot FROM prices),
b AS (SELECT MIN(slot) AS lo, MAX(slot) AS hi FROM slotted),
slots AS (SELECT unnest(generate_series(lo, hi, INTERVAL 12 HOUR)) AS timestamp FROM b),
seen AS (SELECT DISTINCT slot AS timestamp FROM slotted),
s AS (SELECT sl.timestamp, CAST(sl.timestamp AS DATE) AS day, seen.timestamp IS NOT NULL AS observed
      FROM slots sl LEFT JOIN seen ON sl.timestamp = seen.timestamp),
d AS (SELECT day, MAX(CAST(observed AS INT)) AS day_seen FROM s GROUP BY day),
d2 AS (SELECT day, day_seen,
              MAX(CASE WHEN day_seen = 1 THEN day END) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
              MIN(CASE WHEN day_seen = 1 THEN day END) OVER (ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
       FROM d),
m AS (SELECT s.timestamp, s.day, s.observed, COALESCE(d2.day_seen = 0 AND (d2.nxt - d2.prev) - 1 >= 2, FALSE) AS outage
      FROM s JOIN d2 ON s.day = d2.day)"""
register("gap_mask", f2_gaps(_GAP + " SELECT * FROM m"))(lambda s, d: features.gap_mask(EG(s, d)))
register("within_day_fill", f2_gaps(_GAP + """,
obs AS (SELECT gpu_type, provider, slot AS timestamp, round(AVG(price_per_hour / gpu_count), 6) AS price
        FROM slotted WHERE quality = 'ok' GROUP BY 1, 2, 3),
sd AS (SELECT DISTINCT gpu_type, provider, CAST(timestamp AS DATE) AS day FROM obs),
g AS (SELECT sd.gpu_type, sd.provider, m.timestamp, m.day, obs.price FROM sd JOIN m ON sd.day = m.day
      LEFT JOIN obs ON obs.gpu_type = sd.gpu_type AND obs.provider = sd.provider AND obs.timestamp = m.timestamp)
SELECT gpu_type, provider, timestamp, price,
       last_value(price IGNORE NULLS) OVER (PARTITION BY gpu_type, provider, day ORDER BY timestamp
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_price,
       price IS NULL AS was_missing FROM g"""))(lambda s, d: features.within_day_fill(EG(s, d)))

register("spot_quantiles", f1("""
, t AS (SELECT gpu_type, price_per_hour / gpu_count AS p FROM prices WHERE is_spot AND quality = 'ok')
SELECT gpu_type, COUNT(*) AS n, round(quantile_cont(p, 0.1), 6) AS q10, round(quantile_cont(p, 0.25), 6) AS q25,
       round(quantile_cont(p, 0.5), 6) AS q50, round(quantile_cont(p, 0.75), 6) AS q75,
       round(quantile_cont(p, 0.9), 6) AS q90 FROM t GROUP BY 1"""))(lambda s, d: features.spot_quantiles(L(s, d)))

register("market_segment", f1("""
SELECT CASE WHEN provider IN ('aws', 'gcp', 'azure', 'oci') THEN 'hyperscaler' ELSE 'marketplace' END AS segment,
       is_spot, COUNT(*) AS listings, round(AVG(price_per_hour / gpu_count), 6) AS avg_price_per_gpu_hour
FROM prices WHERE quality = 'ok' GROUP BY 1, 2"""))(lambda s, d: features.market_segment(L(s, d)))


# ============================== regions =====================================
from ..operators import regions as regops  # noqa: E402
from ..operators.canonical import enrich_regions  # noqa: E402
from ..sources import panel as fixtures  # noqa: E402
from ..sources.lake import is_committed, path_exists  # noqa: E402
from .pipeline import lake_root  # noqa: E402


def _root(s, d, kind="listings"):
    L(s, d) if kind == "listings" else E(s, d)
    return lake_root(s, d, kind)


def _source(s, d, name: str, build) -> DataFrame:
    """A derived input table (raw items, payloads, rule tables...) written once next to
    the lake, like the files a collector lands; queries then read it as a source."""
    path = f"{_root(s, d)}/sources/{name}"
    if not is_committed(s, path):
        build().write.mode("overwrite").parquet(path)
    return s.read.parquet(path)

_NR = """,
nr AS (SELECT n.n_nationkey AS k, n.n_name, r.r_name, lower(replace(r.r_name, ' ', '')) AS rg,
              lower(replace(n.n_name, '_', '')) AS nn, lower(concat(r.r_name, '-', n.n_name)) AS canon,
              CAST(n.n_nationkey AS DOUBLE) * 1.5 + 20 AS lat, CAST(n.n_nationkey AS DOUBLE) * -2.5 - 70 AS lon,
              chr(CAST(65 + n.n_nationkey // 5 AS INT)) || chr(CAST(65 + n.n_nationkey % 5 AS INT)) AS code
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
keys AS (SELECT *, CASE WHEN k % 2 = 0 THEN rg || '-' || nn || '-1' ELSE rg || '-x-' || nn || '-1' END AS aws_key,
                rg || '-' || nn AS gcp_key, upper(rg || '-' || nn || '-1') AS oci_key, rg || nn AS az_key FROM nr),
prules AS (SELECT 'aws' AS provider, aws_key AS key, canon, n_name AS country, lat, lon, r_name AS grp FROM keys
           UNION ALL SELECT 'gcp', gcp_key, canon, n_name, lat, lon, r_name FROM keys
           UNION ALL SELECT 'oci', oci_key, canon, n_name, lat, lon, r_name FROM keys
           UNION ALL SELECT 'azure', az_key, canon, n_name, lat, lon, r_name FROM keys),
crules AS (SELECT code, n_name AS country, lat, lon, r_name AS grp FROM nr
           UNION ALL SELECT 'Y' || chr(CAST(65 + k // 5 AS INT)), n_name, lat, lon, r_name FROM nr WHERE k % 5 = 2),
pairs AS (SELECT DISTINCT provider, region AS raw_region FROM prices),
pv AS (SELECT DISTINCT p.provider, CASE
         WHEN p.provider = 'aws' THEN CASE k % 4 WHEN 0 THEN aws_key WHEN 1 THEN upper(aws_key)
              WHEN 2 THEN aws_key || '-nyc-1' ELSE 'ap-' || code || '-1' END
         WHEN p.provider = 'gcp' THEN CASE k % 4 WHEN 0 THEN gcp_key WHEN 1 THEN gcp_key || '-b'
              WHEN 2 THEN gcp_key || '-bb' ELSE upper(gcp_key) END
         WHEN p.provider = 'oci' THEN CASE k % 4 WHEN 0 THEN lower(oci_key) WHEN 1 THEN oci_key
              WHEN 2 THEN 'xx-' || lower(code) ELSE 'nowhere' END
         WHEN p.provider = 'azure' THEN CASE k % 4 WHEN 0 THEN az_key WHEN 1 THEN az_key || '-zz'
              WHEN 2 THEN '' ELSE 'eur-' || code || '-2' END
         ELSE CASE k % 4 WHEN 0 THEN 'eu-' || code || '-1' WHEN 1 THEN lower(code) || '-' || nn
              WHEN 2 THEN 'nowhere-' || CAST(k AS VARCHAR) ELSE n_name END END AS raw_region
       FROM pairs p JOIN keys ON p.raw_region = keys.n_name),
valid AS (SELECT * FROM pv WHERE raw_region IS NOT NULL AND raw_region <> ''),
cand AS (SELECT provider, raw_region, 0 AS rule, raw_region AS key FROM valid
         UNION ALL SELECT provider, raw_region, 1, upper(raw_region) FROM valid
         UNION ALL SELECT provider, raw_region, 2, lower(raw_region) FROM valid
         UNION ALL SELECT provider, raw_region, 3, regexp_extract(raw_region, '^(.+)-[[:alpha:]]$', 1) FROM valid
                   WHERE provider = 'gcp' AND length(raw_region) > 2 AND regexp_matches(raw_region, '^(.+)-[[:alpha:]]$')
         UNION ALL SELECT provider, raw_region, 4, array_to_string(string_split(raw_region, '-')[1:4], '-') FROM valid
                   WHERE provider = 'aws' AND len(string_split(raw_region, '-')) > 4
         UNION ALL SELECT provider, raw_region, 5, array_to_string(string_split(raw_region, '-')[1:3], '-') FROM valid
                   WHERE provider = 'aws' AND len(string_split(raw_region, '-')) > 3),
th AS (SELECT c.provider, c.raw_region, c.rule, 0 AS pos,
              CASE WHEN c.rule IN (4, 5) THEN r.canon || '-zone' ELSE r.canon END AS canon, r.country, r.lat, r.lon, r.grp
       FROM cand c JOIN prules r ON c.provider = r.provider AND c.key = r.key),
segs AS (SELECT provider, raw_region, unnest(string_split(upper(raw_region), '-')) AS seg,
                unnest(range(1, len(string_split(raw_region, '-')) + 1)) AS pos FROM valid),
ch AS (SELECT s.provider, s.raw_region, 6 AS rule, s.pos, CAST(NULL AS VARCHAR) AS canon, c.country, c.lat, c.lon, c.grp
       FROM segs s JOIN crules c ON s.seg = c.code WHERE regexp_matches(s.seg, '^[[:alpha:]]{2}$')),
hits AS (SELECT * FROM th UNION ALL SELECT * FROM ch),
best AS (SELECT provider, raw_region, arg_min({'canon': canon, 'country': country, 'lat': lat, 'lon': lon, 'grp': grp,
                                              'rule': rule}, (rule, pos)) AS m FROM hits GROUP BY 1, 2),
resolved AS (SELECT pv.provider, pv.raw_region, b.m.canon AS region_canonical, b.m.country AS country, b.m.lat AS lat,
                    b.m.lon AS lon, b.m.grp AS region_group, b.m.rule AS rule
             FROM pv LEFT JOIN best b ON pv.provider = b.provider AND pv.raw_region = b.raw_region)"""


def _region_inputs(s, d):
    pairs = _source(s, d, "region_pairs_raw",
                    lambda: fixtures.raw_region_variants(s, d, regops.region_pairs(L(s, d).prices)))
    prules = _source(s, d, "provider_rules", lambda: fixtures.region_rule_tables(s, d)[0])
    crules = _source(s, d, "country_rules", lambda: fixtures.region_rule_tables(s, d)[1])
    return pairs, prules, crules


def _resolved(s, d):
    pairs, prules, crules = _region_inputs(s, d)
    return regops.resolve_regions(pairs, prules, crules)


register("region_pairs", f1("SELECT DISTINCT provider, region AS raw_region FROM prices"))(
    lambda s, d: regops.region_pairs(L(s, d).prices))
register("resolve_regions", f1(_NR + " SELECT * FROM resolved"))(_resolved)
register("region_coverage", f1(_NR + """
SELECT COUNT(*) AS pairs, CAST(count_if(region_group IS NOT NULL AND region_group <> '') AS BIGINT) AS mapped,
       CAST(count_if(region_group IS NULL OR region_group = '') AS BIGINT) AS unmapped FROM resolved"""))(
    lambda s, d: regops.region_coverage(_resolved(s, d)))
register("region_unmapped", f1(_NR + """
SELECT provider, raw_region FROM resolved WHERE region_group IS NULL OR region_group = ''"""))(
    lambda s, d: regops.unmapped_pairs(_resolved(s, d)))

_EXISTING = """,
ex AS (SELECT provider, raw_region,
              CASE WHEN h = 0 THEN NULL ELSE 'hand-' || raw_region END AS region_canonical,
              CASE WHEN h = 0 THEN NULL ELSE country END AS country, CASE WHEN h = 0 THEN NULL ELSE lat END AS lat,
              CASE WHEN h = 0 THEN NULL ELSE lon END AS lon, CASE WHEN h = 0 THEN NULL ELSE region_group END AS region_group
       FROM (SELECT *, (length(provider) + length(raw_region)) % 5 AS h FROM resolved) WHERE h <= 1
       UNION ALL
       SELECT provider, 'gone-' || raw_region, region_canonical, country, lat, lon, region_group
       FROM (SELECT *, (length(provider) + length(raw_region)) % 5 AS h FROM resolved) WHERE h = 2)"""


def _refresh(s, d):
    pairs, prules, crules = _region_inputs(s, d)
    existing = _source(s, d, "regions_existing",
                       lambda: fixtures.existing_dimension(regops.resolve_regions(pairs, prules, crules)))
    return regops.regions_refresh(pairs, existing, prules, crules)


register("regions_refresh", f1(_NR + _EXISTING + """
SELECT e.provider, e.raw_region, e.region_canonical, e.country, e.lat, e.lon, e.region_group
FROM ex e WHERE EXISTS (SELECT 1 FROM pv WHERE pv.provider = e.provider AND pv.raw_region = e.raw_region)
UNION ALL
SELECT r.provider, r.raw_region, r.region_canonical, r.country, round(r.lat, 4), round(r.lon, 4), r.region_group
FROM resolved r WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.provider = r.provider AND ex.raw_region = r.raw_region)"""))(
    _refresh)

register("enrich_regions", f1(f"""
SELECT timestamp, provider, instance_type, gpu_type, region, is_spot, region_canonical, country, region_lat,
       region_lon, region_group FROM prices"""))(
    lambda s, d: enrich_regions(
        L(s, d).prices.select("timestamp", "provider", "instance_type", "gpu_type", "region", "is_spot"),
        L(s, d).regions))


# ============================== ingest ======================================
from ..sources import catalogue, ingest  # noqa: E402

_ITEMS = """,
items AS (SELECT timestamp,
    CASE WHEN provider = 'aws' AND is_spot THEN 'AWS' WHEN provider = 'lambdalabs' AND gpu_count = 1 THEN 'Lambda'
         WHEN provider = 'azure' AND gpu_count = 7 THEN NULL ELSE provider END AS provider,
    CASE WHEN vcpus % 10 = 0 THEN NULL ELSE gpu_type END AS gpu_name, CASE WHEN vcpus % 20 = 0 THEN NULL ELSE gpu_type END AS name,
    CASE WHEN vcpus % 7 = 0 THEN NULL ELSE instance_type END AS instance_name,
    CASE WHEN gpu_count = 6 THEN NULL WHEN gpu_count = 4 AND is_spot THEN 1e18 ELSE CAST(gpu_count AS DOUBLE) END AS gpu_count,
    CASE WHEN gpu_memory_gb IS NULL THEN 0.0e0 ELSE gpu_memory_gb + 0.9e0 END AS gpu_memory,
    CASE WHEN gpu_count = 3 AND is_spot THEN 1e12 ELSE CAST(vcpus AS DOUBLE) END AS cpu, ram_gb AS memory,
    CASE WHEN vcpus % 26 = 0 THEN NULL ELSE region END AS location,
    CASE WHEN gpu_count = 5 AND is_spot THEN 'n/a' ELSE CAST(price_per_hour AS VARCHAR) END AS price,
    is_spot AS spot FROM prices),
parsed AS (SELECT *,
    CASE WHEN gpu_name IS NOT NULL AND gpu_name <> '' THEN gpu_name ELSE COALESCE(name, 'Unknown') END AS g,
    CASE WHEN instance_name IS NOT NULL AND instance_name <> '' THEN instance_name ELSE COALESCE(name, 'unknown') END AS inst,
    CASE WHEN gpu_count IS NOT NULL AND gpu_count <> 0 THEN TRY_CAST(trunc(gpu_count) AS INT) ELSE 0 END AS cnt,
    (gpu_memory <> 0 AND TRY_CAST(gpu_memory AS INT) IS NULL) OR (cpu <> 0 AND TRY_CAST(cpu AS INT) IS NULL) AS no_size,
    TRY_CAST(price AS DOUBLE) AS p FROM items),
fates AS (SELECT *, CASE WHEN provider IS NULL THEN 'rejected/provider' WHEN cnt IS NULL THEN 'rejected/gpu_count'
                         WHEN cnt <= 0 THEN 'dropped/no_gpu' WHEN no_size THEN 'rejected/size'
                         WHEN p IS NULL THEN 'rejected/price' ELSE 'accepted' END AS fate FROM parsed),
judged AS (SELECT * EXCLUDE (fate, no_size), split_part(fate, '/', 1) AS status, NULLIF(split_part(fate, '/', 2), '') AS reason
           FROM fates)"""
_PROV_MAP = ("CASE lower(provider) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PROVIDER_ALIASES.items())
             + " ELSE lower(provider) END")


def _items(s, d):
    return _source(s, d, "raw_items", lambda: fixtures.raw_catalogue_items(L(s, d).prices))


register("normalize_listings", f1(_ITEMS + f"""
SELECT timestamp, {_PROV_MAP} AS provider, inst AS instance_type, g AS gpu_type, cnt AS gpu_count,
       CASE WHEN gpu_memory IS NOT NULL AND gpu_memory <> 0 THEN CAST(trunc(gpu_memory) AS INT) END AS gpu_memory_gb,
       CASE WHEN cpu IS NOT NULL AND cpu <> 0 THEN CAST(trunc(cpu) AS INT) ELSE 0 END AS vcpus,
       CASE WHEN memory IS NOT NULL AND memory <> 0 THEN memory ELSE 0.0 END AS ram_gb, COALESCE(location, 'unknown') AS region,
       p AS price_per_hour, COALESCE(spot, FALSE) AS is_spot, TRUE AS available,
       CAST(NULL AS VARCHAR) AS availability_zone,
       CASE WHEN g IS NULL OR g = '' OR g = 'Unknown' THEN 'unknown_gpu'
            WHEN gpu_memory IS NULL OR gpu_memory = 0 THEN 'missing_memory' ELSE 'ok' END AS quality
FROM judged WHERE status = 'accepted'"""))(lambda s, d: ingest.normalize_listings(_items(s, d)))

register("ingest_report", f1(_ITEMS + """
SELECT provider AS source, status, reason, COUNT(*) AS items FROM judged GROUP BY 1, 2, 3"""))(
    lambda s, d: ingest.ingest_report(_items(s, d)))

register("normalize_provider", f1(_ITEMS + f"""
SELECT DISTINCT provider AS raw, {_PROV_MAP} AS provider FROM items WHERE provider IS NOT NULL"""))(
    lambda s, d: _items(s, d).filter("provider IS NOT NULL").select(
        F.col("provider").alias("raw"), normalize_provider("provider").alias("provider")).distinct())

register("quality_ingest", f1(_ITEMS + """
SELECT timestamp, provider, name, gpu_memory,
       CASE WHEN g IS NULL OR g = '' OR g = 'Unknown' THEN 'unknown_gpu'
            WHEN gpu_memory IS NULL OR gpu_memory = 0 THEN 'missing_memory' ELSE 'ok' END AS quality FROM parsed"""))(
    lambda s, d: ingest._parsed(_items(s, d)).select(
        "timestamp", "provider", "name", "gpu_memory", quality_at_ingest("_gpu", "gpu_memory").alias("quality")))

_QSRC = """,
q AS (SELECT timestamp, provider, instance_type, region, is_spot, gpu_type, gpu_memory_gb,
             CASE WHEN gpu_count = 6 THEN NULL ELSE gpu_count END AS gpu_count FROM prices)"""


def _qsrc(s, d):
    return L(s, d).prices.select("timestamp", "provider", "instance_type", "region", "is_spot", "gpu_type",
                                 "gpu_memory_gb", F.when(F.col("gpu_count") == 6, F.lit(None)).otherwise(
                                     F.col("gpu_count")).alias("gpu_count"))


register("quality_view", f1(_QSRC + """
SELECT timestamp, provider, instance_type, region, is_spot,
       CASE WHEN gpu_count <= 0 THEN 'cpu_only' WHEN gpu_type = 'Unknown' THEN 'unknown_gpu'
            WHEN gpu_memory_gb IS NULL THEN 'missing_memory' ELSE 'ok' END AS quality FROM q"""))(
    lambda s, d: _qsrc(s, d).select("timestamp", "provider", "instance_type", "region", "is_spot",
                                    quality_view().alias("quality")))
register("quality_backfill", f1(_QSRC + """
SELECT timestamp, provider, instance_type, region, is_spot,
       CASE WHEN gpu_count IS NULL OR gpu_count <= 0 THEN 'cpu_only' WHEN gpu_type = 'Unknown' THEN 'unknown_gpu'
            WHEN gpu_memory_gb IS NULL THEN 'missing_memory' ELSE 'ok' END AS quality FROM q"""))(
    lambda s, d: _qsrc(s, d).select("timestamp", "provider", "instance_type", "region", "is_spot",
                                    quality_backfill().alias("quality")))

register("filter_ingest", f1(_ITEMS + """
SELECT * EXCLUDE (g, inst, cnt, p, status, reason) FROM judged
WHERE gpu_memory >= 16 AND cpu >= 20 AND TRY_CAST(price AS DOUBLE) <= 40 AND lower(provider) = 'aws'"""))(
    lambda s, d: ingest.filter_ingest(_items(s, d), min_gpu_memory=16, min_cpu=20, max_price=40, provider="aws"))
register("filter_ingest_gpu", f1(_ITEMS + f"""
SELECT * EXCLUDE (g, inst, cnt, p, status, reason) FROM judged WHERE upper(COALESCE(gpu_name, name)) = '{GPU.upper()}'"""))(
    lambda s, d: ingest.filter_ingest(_items(s, d), gpu_name=GPU))

register("union_sources", f1(_ITEMS + """
SELECT timestamp, provider, gpu_name, price, CAST(NULL AS DOUBLE) AS disk_size FROM items
WHERE provider IN ('aws', 'AWS', 'gcp', 'azure', 'oci')
UNION ALL
SELECT timestamp, provider, gpu_name, price, 100.0 AS disk_size FROM items
WHERE provider IS NULL OR provider NOT IN ('aws', 'AWS', 'gcp', 'azure', 'oci')"""))(
    lambda s, d: _union_sources(_items(s, d)))


def _union_sources(items):
    offline = items.filter(F.col("provider").isin("aws", "AWS", "gcp", "azure", "oci")).select(
        "timestamp", "provider", "gpu_name", "price")
    online = items.filter(F.col("provider").isNull() | ~F.col("provider").isin("aws", "AWS", "gcp", "azure", "oci"))
    online = online.select("timestamp", "provider", "gpu_name", "price", F.lit(100.0).alias("disk_size"))
    return ingest.union_sources(offline, online)


def _payloads(s, d):
    return _source(s, d, "host_payloads", lambda: fixtures.host_payloads(L(s, d).prices))


_GOOD_HOST = "NOT (is_spot AND gpu_count IN (2, 3))"
register("flatten_host_offers", f1(f"""
SELECT concat_ws('/', provider, instance_type, region, lower(CAST(is_spot AS VARCHAR)), strftime(timestamp, '%Y%m%d'))
         AS instance_name,
       replace(lower(region), ' ', '') AS location,
       round(vcpus * 0.003 + ram_gb * 0.002 + 100.0 * 0.00005 + gpu_count * price_per_hour, 5) AS price,
       CAST(floor(vcpus / 2) * 2 AS DOUBLE) AS cpu, CAST(floor(ram_gb / 2) * 2 AS DOUBLE) AS memory,
       gpu_count, gpu_type AS gpu_name, CAST(gpu_memory_gb AS DOUBLE) AS gpu_memory, FALSE AS spot,
       100.0e0 AS disk_size
FROM prices WHERE {_GOOD_HOST} AND gpu_count <> 0"""))(lambda s, d: catalogue.flatten_host_offers(_payloads(s, d)))

register("ingest_quarantine", f1("""
SELECT provider AS source, CASE WHEN is_spot AND gpu_count = 2 THEN 'missing_key'
                                WHEN is_spot AND gpu_count = 3 THEN 'malformed' ELSE 'ok' END AS status,
       COUNT(*) AS payloads FROM prices GROUP BY 1, 2"""))(lambda s, d: catalogue.quarantine_report(_payloads(s, d)))

register("listing_json_roundtrip", f1(f"SELECT {CANON_COLS.replace('dt, ', '')} FROM prices"))(
    lambda s, d: ingest.listing_from_json(ingest.listing_to_json(L(s, d).prices.drop("dt"))))

register("price_per_gpu_hour", f1("""
SELECT timestamp, provider, instance_type, region, is_spot,
       CASE WHEN gpu_count > 0 THEN price_per_hour / gpu_count ELSE 0.0 END AS price_per_gpu_hour,
       price_per_hour / NULLIF(gpu_count, 0) AS ppgh FROM prices"""))(
    lambda s, d: L(s, d).prices.select("timestamp", "provider", "instance_type", "region", "is_spot",
                                       price_per_gpu_hour().alias("price_per_gpu_hour"), ppgh().alias("ppgh")))

register("snapshot_labels", f1("""
SELECT DISTINCT timestamp, CAST(timestamp AS DATE) AS day, 'dt=' || strftime(timestamp, '%Y-%m-%d') AS partition,
       'snapshot_' || strftime(timestamp, '%Y%m%dT%H%M%SZ') || '.parquet' AS file FROM prices"""))(
    lambda s, d: L(s, d).snapshots.select(
        "timestamp", day().alias("day"), F.concat(F.lit("dt="), F.date_format("timestamp", "yyyy-MM-dd")).alias(
            "partition"), snapshot_filename().alias("file")))


# ============================== lake maintenance ============================
from ..operators import lake as lakeops  # noqa: E402
from ..operators.canonical import canonical_prices, migrate_defaults  # noqa: E402
from ..schema import BASE_COLUMNS, LISTING_COLUMNS  # noqa: E402
from ..sources.lake import scan_prices, write_lake  # noqa: E402
from ..sources.regions_file import load_regions, write_regions  # noqa: E402

OLD_BEFORE = "1998-01-01"


register("scan_prices", f1(f"SELECT {CANON_COLS} FROM prices"))(
    lambda s, d: scan_prices(s, f"{_root(s, d)}/prices"))


def _mixed_tree(s, d) -> str:
    """A lake whose early snapshots are old-vintage files (13 columns), the rest v1.1."""
    root = _root(s, d)
    path = f"{root}/mixed"
    if not path_exists(s, f"{path}/_v11_done"):
        p = L(s, d).prices
        # the first write replaces whatever an interrupted run left
        (fixtures.old_vintage_rows(p, OLD_BEFORE).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("dt").parquet(path))
        new = p.filter(F.col("dt") >= F.lit(OLD_BEFORE).cast("date")).select(*LISTING_COLUMNS, "dt")
        new.write.mode("append").partitionBy("dt").parquet(path)
        s.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(f"{path}/_v11_done")
    return path


def _mixed(s, d):
    return scan_prices(s, _mixed_tree(s, d), merge_schema=True)


_MIXED = f""",
mixed AS (SELECT {', '.join(c if c != 'gpu_count' else 'CASE WHEN dt < DATE ' + repr(OLD_BEFORE) + ' AND gpu_count = 6 THEN NULL ELSE gpu_count END AS gpu_count' for c in BASE_COLUMNS)},
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE quality END AS quality,
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE region_canonical END AS region_canonical,
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE country END AS country,
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE region_lat END AS region_lat,
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE region_lon END AS region_lon,
                 CASE WHEN dt < DATE '{OLD_BEFORE}' THEN NULL ELSE region_group END AS region_group, dt
          FROM prices),
lk AS (SELECT m.*, r.region_canonical AS r_canon, r.country AS r_country, r.lat AS r_lat, r.lon AS r_lon,
              r.region_group AS r_group
       FROM mixed m LEFT JOIN regions r ON m.provider = r.provider AND m.region = r.raw_region)"""
_BASE_SEL = ", ".join(BASE_COLUMNS)

register("list_old_vintage", f1(f"SELECT DISTINCT dt FROM prices WHERE dt < DATE '{OLD_BEFORE}'"))(
    lambda s, d: lakeops.list_old_vintage(_mixed(s, d)))
register("canonical_prices_mixed", f1(_MIXED + f"""
SELECT {_BASE_SEL}, dt,
       COALESCE(quality, CASE WHEN gpu_count <= 0 THEN 'cpu_only' WHEN gpu_type = 'Unknown' THEN 'unknown_gpu'
                              WHEN gpu_memory_gb IS NULL THEN 'missing_memory' ELSE 'ok' END) AS quality,
       COALESCE(region_canonical, r_canon) AS region_canonical, COALESCE(country, r_country) AS country,
       COALESCE(region_lat, r_lat) AS region_lat, COALESCE(region_lon, r_lon) AS region_lon,
       COALESCE(region_group, r_group) AS region_group FROM lk"""))(
    lambda s, d: canonical_prices(_mixed(s, d), L(s, d).regions))
register("upgrade_schema", f1(_MIXED + f"""
SELECT {_BASE_SEL}, dt,
       CASE WHEN quality IS NOT NULL THEN quality WHEN gpu_count IS NULL OR gpu_count <= 0 THEN 'cpu_only'
            WHEN gpu_type = 'Unknown' THEN 'unknown_gpu' WHEN gpu_memory_gb IS NULL THEN 'missing_memory'
            ELSE 'ok' END AS quality,
       CASE WHEN quality IS NULL THEN r_canon ELSE region_canonical END AS region_canonical,
       CASE WHEN quality IS NULL THEN r_country ELSE country END AS country,
       CASE WHEN quality IS NULL THEN r_lat ELSE region_lat END AS region_lat,
       CASE WHEN quality IS NULL THEN r_lon ELSE region_lon END AS region_lon,
       CASE WHEN quality IS NULL THEN r_group ELSE region_group END AS region_group FROM lk"""))(
    lambda s, d: lakeops.upgrade_schema(_mixed(s, d), L(s, d).regions))

register("migrate_defaults", f1(f"""
SELECT timestamp, provider, instance_type, region, FALSE AS is_spot, 'ok' AS quality FROM prices"""))(
    lambda s, d: migrate_defaults(L(s, d).prices.select("timestamp", "provider", "instance_type", "region")))

register("snapshot_manifest", f1("""
, t AS (SELECT timestamp, dt, quality, COUNT(*) AS n FROM prices GROUP BY 1, 2, 3)
SELECT timestamp, dt, CAST(SUM(n) AS BIGINT) AS row_count,
       string_agg(quality || '=' || CAST(n AS VARCHAR), ',' ORDER BY quality || '=' || CAST(n AS VARCHAR))
         AS quality_summary, '1.1' AS schema_version
FROM t GROUP BY 1, 2"""))(
    lambda s, d: lakeops.snapshot_manifest(L(s, d).prices, emitted_at="2026-01-01 00:00:00").select(
        "timestamp", "dt", "row_count", "quality_summary", "schema_version"))

register("emit_latest", f1(f"SELECT {CANON_COLS} FROM prices WHERE {LATEST}"))(
    lambda s, d: lakeops.emit_latest(L(s, d).prices, L(s, d).snapshots))
register("recent_n_snapshots", f1(f"""
SELECT {CANON_COLS} FROM prices
WHERE timestamp IN (SELECT DISTINCT timestamp FROM prices ORDER BY timestamp DESC LIMIT 5)"""))(
    lambda s, d: lakeops.recent_n_snapshots(L(s, d).prices, 5, L(s, d).snapshots))
register("publish_new_snapshots", f1(f"""
SELECT {CANON_COLS} FROM prices
WHERE timestamp NOT IN (SELECT DISTINCT timestamp FROM prices WHERE timestamp < TIMESTAMP '2000-01-01 00:00:00')"""))(
    lambda s, d: lakeops.publish_new_snapshots(
        L(s, d).prices, L(s, d).snapshots.filter(F.col("timestamp") < F.lit("2000-01-01").cast("timestamp"))))


def _incoming(p):
    """A re-sent newest snapshot: every row, prices changed on even GPU counts, plus the
    whole snapshot again under new instance names (new keys)."""
    latest = p.latest()
    changed = latest.withColumn("price_per_hour", F.when(F.col("gpu_count") % 2 == 0, F.col("price_per_hour") * 1.1)
                                .otherwise(F.col("price_per_hour")))
    new = latest.withColumn("instance_type", F.concat("instance_type", F.lit("-new")))
    return changed.unionByName(new)


def _merge_lake(s, d, name: str, compacted: bool) -> str:
    """A copy of the lake that took the newest snapshot twice more: at wrong prices, then as it is re-sent."""
    path = f"{_root(s, d)}/{name}"
    if not is_committed(s, f"{path}/_done"):
        p = L(s, d)
        write_lake(p.prices, path, dynamic=False)
        lakeops.upsert_into_lake(s, path, p.latest().withColumn("price_per_hour", F.lit(-1.0)))
        lakeops.upsert_into_lake(s, path, _incoming(p))
        if compacted:
            lakeops.compact(s, path, "1992-01-01", "2999-01-01")
        s.range(1).write.mode("overwrite").parquet(f"{path}/_done")
    return path


def _touched(lake, p):
    return lake.filter(F.col("dt") == p.snapshots.select(F.max("dt")).scalar()).select(*LISTING_COLUMNS, "dt")


_LC = ", ".join(LISTING_COLUMNS)
register("upsert_latest_wins", f1(f""",
inc AS (SELECT {_LC.replace('price_per_hour', 'CASE WHEN gpu_count % 2 = 0 THEN price_per_hour * 1.1 ELSE price_per_hour END AS price_per_hour')}, dt
        FROM prices WHERE {LATEST}
        UNION ALL
        SELECT {_LC.replace('instance_type', "instance_type || '-new' AS instance_type")}, dt FROM prices
        WHERE {LATEST}),
old AS (SELECT {_LC}, dt FROM prices WHERE dt IN (SELECT DISTINCT dt FROM inc))
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.timestamp = old.timestamp
  AND inc.provider = old.provider AND inc.instance_type = old.instance_type AND inc.region = old.region
  AND inc.is_spot = old.is_spot)
UNION ALL SELECT * FROM inc"""))(
    lambda s, d: _touched(scan_prices(s, _merge_lake(s, d, "merge_lake", compacted=False)), L(s, d)))
register("upsert_compacted", ORACLES["upsert_latest_wins"])(
    lambda s, d: _touched(scan_prices(s, _merge_lake(s, d, "compacted_lake", compacted=True)), L(s, d)))
register("upsert_whole_lake", f1(f"""
SELECT {_LC.replace('price_per_hour', f'CASE WHEN {LATEST} AND gpu_count % 2 = 0 THEN price_per_hour * 1.1 ELSE price_per_hour END AS price_per_hour')}, dt
FROM prices
UNION ALL
SELECT {_LC.replace('instance_type', "instance_type || '-new' AS instance_type")}, dt FROM prices WHERE {LATEST}"""))(
    lambda s, d: scan_prices(s, _merge_lake(s, d, "merge_lake", compacted=False)))


def _regions_csv(s, d):
    root = _root(s, d)
    path = f"{root}/regions_csv"
    if not is_committed(s, path):
        write_regions(L(s, d).regions, path)
    return load_regions(s, path)


register("regions_lookup", f1("SELECT * FROM regions"))(_regions_csv)


# ============================== streaming ===================================
from ..streaming import snapshots as streams  # noqa: E402

STREAM_CUT = "2024-01-15 00:00:00"


def _stream_root(s, d) -> str:
    """Run the three streams once per input: land the events panel's snapshot files in
    two halves and process each half with availableNow triggers."""
    base = f"{_root(s, d, 'events')}/stream"
    if path_exists(s, f"{base}/_done"):  # names the finished run's folder: an interrupted one is not used again
        root = f"{base}/{s.read.parquet(f'{base}/_done').first().run}"
    else:
        run = uuid.uuid4().hex
        root = f"{base}/{run}"
        from ..sources.panel import events_panel_raw
        raw = events_panel_raw(s, d)
        regions = E(s, d).regions
        land = f"{root}/landing"
        runs = [
            lambda: streams.run_ingest_stream(s, land, f"{root}/target", f"{root}/ck_ingest",
                                              lambda b: streams.prepare_listings(b, regions), ["seq_a", "seq_b"],
                                              wait=False),
            lambda: streams.run_summary_stream(s, land, f"{root}/summary", f"{root}/ck_summary", wait=False),
            lambda: streams.run_dedupe_stream(s, land, f"{root}/dedupe", f"{root}/ck_dedupe", ["seq_a", "seq_b"],
                                              wait=False),
        ]
        streams.land_in_halves(s, raw, land, F.lit(STREAM_CUT).cast("timestamp"), runs)
        s.createDataFrame([(run,)], "run string").write.mode("overwrite").parquet(f"{base}/_done")
    return root


register("stream_ingest_result", f2(f"SELECT {CANON_COLS} FROM prices"))(
    lambda s, d: canonical_prices(streams.read_stream_target(s, f"{_stream_root(s, d)}/target"), E(s, d).regions))

register("stream_snapshot_summary", f2("""
, k AS (SELECT timestamp AS window_start, timestamp + INTERVAL 12 HOUR AS window_end, COUNT(*) AS total_instances,
               CAST(COUNT(DISTINCT provider) AS INTEGER) AS providers_count,
               CAST(COUNT(DISTINCT gpu_type) AS INTEGER) AS gpu_types_count,
               MIN(price_per_hour) AS min_price, MAX(price_per_hour) AS max_price,
               round(AVG(price_per_hour), 6) AS avg_price FROM raw GROUP BY timestamp)
SELECT * FROM k"""))(
    lambda s, d: streams.read_summary_sink(s, f"{_stream_root(s, d)}/summary"))

register("stream_dedupe", f2(f"SELECT {', '.join(BASE_COLUMNS)} FROM prices"))(
    lambda s, d: s.read.parquet(f"{_stream_root(s, d)}/dedupe").select(*BASE_COLUMNS))


# ============================== chart inputs (T2, P12) =======================
register("top_gpus_by_count", f1(f""", g AS ({_GS_SQL}), t AS (SELECT * FROM g ORDER BY count DESC, gpu_type LIMIT 25)
SELECT *, CAST(row_number() OVER (ORDER BY count DESC, gpu_type) AS INTEGER) AS count_rank FROM t"""))(
    lambda s, d: reports.top_gpus_by_count(reports.gpu_summary(L(s, d)), 25))
register("top_gpus_by_price", f1(f""", g AS ({_GS_SQL}), t AS (SELECT * FROM g ORDER BY count DESC, gpu_type LIMIT 25)
SELECT *, CAST(row_number() OVER (ORDER BY avg_price_per_gpu, gpu_type) AS INTEGER) AS price_rank FROM t"""))(
    lambda s, d: reports.top_gpus_by_price(reports.gpu_summary(L(s, d)), 25))
register("relative_scale", f1(f""", g AS ({_GS_SQL})
SELECT *, round(avg_price_per_gpu / (SELECT MAX(avg_price_per_gpu) FROM g), 6) AS avg_price_per_gpu_rel FROM g"""))(
    lambda s, d: reports.relative_scale(reports.gpu_summary(L(s, d)), "avg_price_per_gpu"))


# ============================== findings (K9) ================================
register("findings", f1(_SITES + f"""
, shares AS (SELECT provider, count(*) AS n FROM rated WHERE priced GROUP BY provider ORDER BY n DESC, provider LIMIT 8),
saved AS (SELECT gpu_type, median(rate) FILTER (NOT is_spot) AS listed, median(rate) FILTER (is_spot) AS spot
          FROM rated WHERE priced AND gpu_type IN ({_in(SAVINGS)}) GROUP BY gpu_type),
ranked AS (SELECT metro, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, metro) AS place FROM us GROUP BY metro)
SELECT 'headline' AS metric, 'gpu_listings' AS key, CAST(count(*) AS DOUBLE) AS value FROM rated WHERE priced
UNION ALL SELECT 'headline', 'days', count(DISTINCT dt) FROM rated WHERE priced
UNION ALL SELECT 'headline', 'providers', count(DISTINCT provider) FROM rated WHERE priced
UNION ALL SELECT 'headline', 'gpu_types', count(DISTINCT gpu_type) FROM rated WHERE priced
UNION ALL SELECT 'headline', 'total_rows', count(*) FROM rated
UNION ALL SELECT 'ladder', gpu_type, round(median(rate), 6) FROM rated
          WHERE priced AND NOT is_spot AND gpu_type IN ({_in(LADDER)}) GROUP BY gpu_type
UNION ALL SELECT 'spot_savings', gpu_type, round(100 * (1 - spot / listed), 6) FROM saved
          WHERE listed IS NOT NULL AND spot IS NOT NULL
UNION ALL SELECT 'provider_share', provider, n FROM shares
UNION ALL SELECT 'concentration', 'top3_share_pct', round(100 * sum(n) FILTER (place <= 3) / sum(n), 1) FROM ranked
UNION ALL SELECT 'concentration', 'n_metros', count(*) FROM ranked"""))(
    lambda s, d: market.findings(L(s, d), LADDER, SAVINGS, G(s, d)))


from . import extensions  # noqa: E402,F401  registers the queries built on the ones above
