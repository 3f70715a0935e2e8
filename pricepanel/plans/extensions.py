"""Registered queries of the stored forms and the finer modelling frames.

They extend the inventory's operators: bitmaps, verification, series outages,
provider pairs, frames on the clock, the payload quarantine.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bitmaps, features
from ..operators import lake as lakeops
from ..operators.canonical import migrate_defaults
from ..sources import catalogue
from ..sources.lake import is_committed
from .catalog import EG, L, _GAP, _payloads, _root, register
from .oracle import f1, f2_gaps


# ---- A1, A14 by bitmaps ------------------------------------------------------
def _bitmaps(s, d) -> str:
    """Bitmaps of all snapshots, written by two overlapping runs."""
    path = f"{_root(s, d)}/distinct"
    if not is_committed(s, f"{path}/_done"):
        p = L(s, d).prices
        bitmaps.write_bitmaps(s, p.filter(F.col("dt") < "1999-01-01"), path)
        bitmaps.write_bitmaps(s, p.filter(F.col("dt") >= "1998-06-01"), path)
        s.range(1).write.mode("overwrite").parquet(f"{path}/_done")
    return path


register("dataset_stats_bitmaps", f1("""
SELECT MIN(timestamp) AS first_snapshot, MAX(timestamp) AS last_snapshot, COUNT(DISTINCT timestamp) AS snapshots,
       COUNT(*) AS total_records, COUNT(DISTINCT provider) AS providers, COUNT(DISTINCT gpu_type) AS gpu_types
FROM prices"""))(lambda s, d: bitmaps.dataset_stats_from_bitmaps(s, _bitmaps(s, d)))

register("distinct_by_year", f1("""
SELECT CAST(year(timestamp) AS INTEGER) AS year, COUNT(*) AS listings, COUNT(DISTINCT provider) AS providers,
       COUNT(DISTINCT gpu_type) AS gpu_types, COUNT(DISTINCT region_group) AS region_groups FROM prices GROUP BY 1"""))(
    lambda s, d: bitmaps.distinct_counts(bitmaps.read_bitmaps(s, _bitmaps(s, d)), {"year": F.year("timestamp")}))

register("distinct_trailing_half_year", f1("""
, ends AS (SELECT DISTINCT timestamp AS window_end FROM prices)
SELECT window_end, COUNT(*) AS listings, COUNT(DISTINCT provider) AS providers, COUNT(DISTINCT gpu_type) AS gpu_types,
       COUNT(DISTINCT region_group) AS region_groups
FROM ends JOIN prices ON timestamp <= window_end AND timestamp > window_end - INTERVAL 6 MONTH GROUP BY 1"""))(
    lambda s, d: _trailing(bitmaps.read_bitmaps(s, _bitmaps(s, d))))


def _trailing(maps):
    """Every month's bitmaps count in the windows that end in it and in the five months after."""
    ends = F.explode(F.sequence("timestamp", F.add_months("timestamp", 5).cast("timestamp"), F.expr("INTERVAL 1 MONTH")))
    latest = maps.select(F.max("timestamp")).scalar()
    counts = bitmaps.distinct_counts(maps.withColumn("window_end", ends), {"window_end": F.col("window_end")})
    return counts.filter(F.col("window_end") <= latest).join(
        maps.select(F.col("timestamp").alias("window_end")).distinct(), "window_end", "left_semi")


# ---- K7: digests ---------------------------------------------------------------
ALTERED = "1996-05-01"


def _altered_lake(s, d) -> str:
    """A published lake of which one stored date was changed behind the manifest's back."""
    root = f"{_root(s, d)}/altered"
    if not is_committed(s, f"{root}/_done"):
        p = L(s, d).prices
        lakeops.publish_snapshots(s, p, root)
        folder = f"{root}/prices/_deltas/0000000001-rows"
        rows = s.read.schema(lakeops.LAKE_SCHEMA).parquet(folder).filter(F.col("dt") == F.lit(ALTERED).cast("date"))
        stage = f"{root}/_altered"
        rows.withColumn("gpu_count", F.col("gpu_count") + 1).drop("dt").write.mode("overwrite").parquet(stage)
        s.read.parquet(stage).write.mode("overwrite").parquet(f"{folder}/dt={ALTERED}")
        s.range(1).write.mode("overwrite").parquet(f"{root}/_done")
    return root


register("verify_lake", f1(f"""
SELECT timestamp, COUNT(*) AS row_count, COUNT(*) AS rows_now, dt <> DATE '{ALTERED}' AS intact FROM prices GROUP BY timestamp, dt"""))(
    lambda s, d: lakeops.verify_lake(s, _altered_lake(s, d)))


# ---- M3, M5, M6 ------------------------------------------------------------------
register("series_outages", f2_gaps(_GAP + """
, own AS (SELECT DISTINCT gpu_type, provider, slot FROM slotted WHERE quality = 'ok'),
runs AS (SELECT gpu_type, provider, slot + INTERVAL 12 HOUR AS outage_start,
                lead(slot) OVER (PARTITION BY gpu_type, provider ORDER BY slot) AS follows FROM own),
ends AS (SELECT gpu_type, provider, outage_start, COALESCE(follows, (SELECT hi FROM b) + INTERVAL 12 HOUR) AS outage_end,
                follows IS NOT NULL AS ended FROM runs)
SELECT gpu_type, provider, outage_start, outage_end, ended,
       CAST(epoch(outage_end - outage_start) // 43200 AS BIGINT) AS missing_slots
FROM ends WHERE outage_end - outage_start >= INTERVAL 24 HOUR"""))(lambda s, d: features.series_outages(EG(s, d)))

_PAIRS = """
, daily AS (SELECT gpu_type, provider, dt AS day, round(avg(price_per_hour / gpu_count), 9) AS p, count(*) AS n
            FROM prices WHERE quality = 'ok' GROUP BY ALL),
ranked AS (SELECT gpu_type, provider, row_number() OVER (PARTITION BY gpu_type ORDER BY sum(n) DESC, provider) AS place
           FROM daily GROUP BY gpu_type, provider),
chosen AS (SELECT * FROM daily SEMI JOIN (FROM ranked WHERE {only}) USING (gpu_type, provider)),
m AS (SELECT a.gpu_type, a.provider AS provider_a, b.provider AS provider_b, count(*) AS n_days,
             covar_samp(a.p, b.p) AS v, corr(a.p, b.p) AS c
      FROM chosen a JOIN chosen b ON a.gpu_type = b.gpu_type AND a.day = b.day AND a.provider < b.provider GROUP BY ALL)
SELECT gpu_type, provider_a, provider_b, n_days, round(v, 6) AS covariance,
       round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS correlation FROM m WHERE n_days >= 3"""
register("provider_pairs", f2_gaps(_PAIRS.format(only="place <= 3")))(
    lambda s, d: features.provider_pairs(EG(s, d), per_type=3))
register("provider_pairs_named", f1(_PAIRS.format(only="provider IN ('aws', 'gcp', 'oci')")))(
    lambda s, d: features.provider_pairs(L(s, d), named=["aws", "gcp", "oci"]))

register("feature_frame_hours", f2_gaps(_GAP + """
, snap AS (SELECT gpu_type, slot, AVG(price_per_hour / gpu_count) AS price, COUNT(*) AS listings
           FROM slotted WHERE quality = 'ok' GROUP BY ALL)
SELECT a.gpu_type, a.slot, round(any_value(a.price), 6) AS price, any_value(a.listings) AS listings,
       round(max(b.price) FILTER (b.slot = a.slot - INTERVAL 24 HOUR), 6) AS lag_price,
       max(b.listings) FILTER (b.slot = a.slot - INTERVAL 24 HOUR) AS lag_listings, COUNT(b.price) AS rolling_slots,
       round(AVG(b.price), 6) AS rolling_price, round(stddev_samp(b.price) / NULLIF(AVG(b.price), 0), 6) AS rolling_cv
FROM snap a JOIN snap b ON a.gpu_type = b.gpu_type AND b.slot BETWEEN a.slot - INTERVAL 48 HOUR AND a.slot
GROUP BY a.gpu_type, a.slot"""))(lambda s, d: features.feature_frame_hours(EG(s, d)))


# ---- S5, S6: the quarantine -------------------------------------------------------
register("host_quarantine", f1("""
SELECT provider AS source, CASE gpu_count WHEN 2 THEN 'missing_key' ELSE 'malformed' END AS status,
       CASE gpu_count WHEN 2 THEN '$.hostnodes' ELSE '$' END AS path, CASE gpu_count WHEN 2 THEN 'oops' END AS unknown,
       COUNT(*) AS payloads FROM prices WHERE is_spot AND gpu_count IN (2, 3) GROUP BY ALL"""))(
    lambda s, d: catalogue.quarantine(_payloads(s, d)).groupBy(
        "source", "status", "path", F.when(F.col("unknown").isNotNull(), F.array_join("unknown", ",")).alias("unknown")).agg(
        F.count(F.lit(1)).alias("payloads")))
register("quarantine_replay", f1("""
SELECT concat_ws('/', provider, instance_type, region, lower(CAST(is_spot AS VARCHAR)), strftime(timestamp, '%Y%m%d'))
         AS instance_name, gpu_type AS gpu_name, gpu_count,
       round(vcpus * 0.003 + ram_gb * 0.002 + 100.0 * 0.00005 + gpu_count * price_per_hour, 5) AS price
FROM prices WHERE is_spot AND gpu_count = 2"""))(
    lambda s, d: catalogue.replay(catalogue.quarantine(_payloads(s, d)).filter("status = 'missing_key'"), F.replace(
        F.col("payload"), F.lit('{"oops":'), F.lit('{"hostnodes":'))).select("instance_name", "gpu_name", "gpu_count", "price"))


# ---- F4, K11 with inputs that tell -------------------------------------------------
register("filter_all_snapshots", f1("""
SELECT timestamp, provider, instance_type, region, is_spot, price_per_hour / gpu_count AS price_per_gpu_hour FROM prices
WHERE quality = 'ok' AND provider IN ('aws', 'gcp', 'oci') AND region_group IN ('ASIA', 'EUROPE') AND is_spot = FALSE"""))(
    lambda s, d: _filter_all(L(s, d)))


def _filter_all(p):
    from ..functions.columns import ppgh
    from ..functions.predicates import all_of, listing_filters, ok
    df = ok(p.prices).filter(all_of(listing_filters((), ["aws", "gcp", "oci"], ["ASIA", "EUROPE"], False)))
    return df.select("timestamp", "provider", "instance_type", "region", "is_spot", ppgh().alias("price_per_gpu_hour"))


register("migrate_partly_filled", f1("""
SELECT timestamp, provider, instance_type, region, gpu_type,
       CASE WHEN gpu_count % 3 = 0 THEN FALSE ELSE is_spot END AS is_spot,
       CASE WHEN gpu_count % 2 = 0 THEN 'ok' ELSE quality END AS quality FROM prices"""))(
    lambda s, d: migrate_defaults(L(s, d).prices.select(
        "timestamp", "provider", "instance_type", "region", "gpu_type",
        F.when(F.col("gpu_count") % 3 != 0, F.col("is_spot")).alias("is_spot"),
        F.when(F.col("gpu_count") % 2 != 0, F.col("quality")).alias("quality"))))
