"""Lake maintenance operators (K1-K7, W4): dedupe, upsert, publish, manifest, upgrade, verify.

Lake, manifest and summary table are written as numbered deltas
(``sources.deltas``): a writer that fails between two of them leaves every
snapshot readable exactly once, and its next run finishes the work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import quality_backfill
from ..schema import (BASE_COLUMNS, LAKE_SCHEMA, LISTING_COLUMNS, LISTING_KEY, MANIFEST_SCHEMA, REGION_COLUMNS, SCHEMA_VERSION,
                      STORED_SUMMARY_SCHEMA)
from ..sources.deltas import DATES, ROWS, add_delta, fold, read_table
from ..sources.lake import CLUSTER_COLUMNS, path_exists, scan_prices, with_dt
from ..sources.scratch import scratch_table
from .canonical import enrich_regions


def _order(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in cols]


def dedupe_latest(df: DataFrame, order_by, key=LISTING_KEY) -> DataFrame:
    """Keep one row per ``key``, the one that sorts first by ``order_by``
    (descending, NULLs last), i.e. the last write wins.

    ``row_number() == 1`` lets Spark plan a partial per-key limit before the
    shuffle (WindowGroupLimit), so duplicates are dropped map-side.
    """
    w = Window.partitionBy(*key).orderBy(*_order(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def snapshot_summary(df: DataFrame) -> DataFrame:
    """K2: per snapshot totals, distinct providers/types, min/max/avg price and
    JSON metadata with the sorted sets. Computed from the frame as given (D5).

    Listings are first reduced to (timestamp, provider, gpu_type) cells with
    count/min/max/sum (map-side combined); the distinct counts and sets are
    taken over those cells.
    """
    cells = df.groupBy("timestamp", "provider", "gpu_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("price_per_hour").alias("lo"), F.max("price_per_hour").alias("hi"),
        F.sum("price_per_hour").alias("s"))
    return cells.groupBy("timestamp").agg(
        F.sum("n").alias("total_instances"),
        F.count_distinct("provider").alias("providers_count"),
        F.count_distinct("gpu_type").alias("gpu_types_count"),
        F.coalesce(F.min("lo"), F.lit(0.0)).alias("min_price"),
        F.coalesce(F.max("hi"), F.lit(0.0)).alias("max_price"),
        F.round(F.coalesce(F.sum("s") / F.sum("n"), F.lit(0.0)), 6).alias("avg_price"),
        F.to_json(F.struct(
            F.array_sort(F.collect_set("provider")).alias("providers"),
            F.array_sort(F.collect_set("gpu_type")).alias("gpu_types"))).alias("metadata"),
    )


def row_digest() -> Column:
    """A 64-bit hash of the observed columns of a listing, as a number that adds up exactly in any order."""
    return F.xxhash64(*[F.col(c) for c in BASE_COLUMNS]).cast("decimal(20,0)")


def snapshot_manifest(df: DataFrame, emitted_at=None, code_version: str = "", backfilled: bool = False) -> DataFrame:
    """K7: provenance per snapshot: row count, sorted ``quality=n`` summary, content digest, version.

    Two small aggregations: (timestamp, quality) counts, then one row per
    snapshot; the second works on at most |snapshots| x |tags| rows.
    """
    per_tag = with_dt(df).groupBy("timestamp", "dt", "quality").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_digest()).alias("d"))
    out = per_tag.groupBy("timestamp", "dt").agg(
        F.sum("n").alias("row_count"), F.sum("d").cast("string").alias("digest"),
        F.array_join(F.array_sort(F.collect_list(
            F.concat(F.coalesce(F.col("quality"), F.lit("null")), F.lit("="), F.col("n").cast("string")))), ",")
        .alias("quality_summary"),
    )
    return out.select(
        "timestamp", "dt", "row_count", "quality_summary", "digest",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        (F.lit(emitted_at).cast("timestamp") if emitted_at is not None else F.current_timestamp()).alias("emitted_at"),
        F.lit(code_version).alias("code_version"),
        F.lit(backfilled).alias("backfilled"),
    )


def publish_new_snapshots(new: DataFrame, published_snapshots: DataFrame) -> DataFrame:
    """Rows of snapshots not yet published (anti join on timestamp)."""
    return new.join(published_snapshots.select("timestamp").distinct(), "timestamp", "left_anti")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of the lake at ``root``: one row a snapshot, the newest that was written."""
    return read_table(spark, f"{root}/manifest", MANIFEST_SCHEMA, ["timestamp"])


def _note_snapshots(rows: DataFrame, root: str, **how) -> None:
    manifest = snapshot_manifest(rows, **how).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA])
    add_delta(manifest, f"{root}/manifest", ROWS)


def publish_snapshots(spark, new: DataFrame, root: str, code_version: str = "") -> int:
    """K3 sink: add the snapshots of ``new`` that the lake at ``root`` does not have yet.

    A snapshot is published once its manifest row is written, which comes
    last; publishing the same input twice changes nothing. Rows that a failed
    call left of these snapshots are replaced with their whole dates. Returns
    the number of snapshots published.
    """
    prices_path = f"{root}/prices"
    fresh = publish_new_snapshots(with_dt(new), read_manifest(spark, root)).select(*LISTING_COLUMNS, "dt")
    fresh = scratch_table(fresh, "publish")
    stamps = scratch_table(fresh.select("timestamp", "dt").distinct(), "publish-stamps")
    n = stamps.count()
    if n:
        there = scan_prices(spark, prices_path).join(stamps.select("dt").distinct(), "dt", "left_semi")
        if there.join(stamps.select("timestamp"), "timestamp", "left_semi").isEmpty():
            add_delta(fresh, prices_path, ROWS, CLUSTER_COLUMNS)
        else:
            other = there.join(stamps.select("timestamp"), "timestamp", "left_anti")
            add_delta(other.select(*LISTING_COLUMNS, "dt").unionByName(fresh), prices_path, DATES, CLUSTER_COLUMNS)
        _note_snapshots(fresh, root, code_version=code_version)
    return n


def verify_lake(spark, root: str) -> DataFrame:
    """K7: per snapshot of the manifest whether the lake still holds the rows it was written with.

    One aggregation over the observed columns; a snapshot that is gone counts as changed."""
    now = with_dt(scan_prices(spark, f"{root}/prices")).groupBy("timestamp").agg(
        F.count(F.lit(1)).alias("rows_now"), F.sum(row_digest()).cast("string").alias("digest_now"))
    return read_manifest(spark, root).join(now, "timestamp", "left").select(
        "timestamp", "row_count", F.coalesce("rows_now", F.lit(0)).alias("rows_now"),
        F.col("digest").eqNullSafe(F.col("digest_now")).alias("intact"))


def emit_latest(df: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """K4: only the newest snapshot of ``df``.

    With a snapshot index (the manifest) the maximum comes from it and a
    ``dt`` predicate prunes the scan to one partition.
    """
    mx = (snapshots if snapshots is not None else df).select(F.max("timestamp")).scalar()
    if "dt" in df.columns:
        df = df.filter(F.col("dt") == F.to_date(mx))
    return df.filter(F.col("timestamp") == mx)


def recent_n_snapshots(df: DataFrame, n: int, snapshots: DataFrame | None = None) -> DataFrame:
    """K5: rows of the ``n`` most recent distinct snapshots (semi join on <= n timestamps).

    With a snapshot index the recent list comes from it, and the oldest of
    them bounds ``dt`` so only those partitions are read.
    """
    src = snapshots if snapshots is not None else df
    recent = src.select("timestamp").distinct().orderBy(F.col("timestamp").desc()).limit(n)
    if "dt" in df.columns:
        df = df.filter(F.col("dt") >= F.to_date(recent.select(F.min("timestamp")).scalar()))
    return df.join(F.broadcast(recent), "timestamp", "left_semi")


def upsert_latest_wins(existing: DataFrame, incoming: DataFrame, sequence: str | None = None) -> DataFrame:
    """K1: merge ``incoming`` into the ``existing`` rows of the same ``dt``s.

    Returns the new content of the touched partitions only: for every key the
    incoming row wins over the stored one, and of several incoming rows the
    last: the greatest ``sequence`` column, or, without one, the last in the
    order of the frame. Untouched ``dt``s are not read.
    """
    order = F.col(sequence) if sequence else F.monotonically_increasing_id()
    inc = with_dt(incoming).select(*LISTING_COLUMNS, "dt", F.struct(F.lit(1).alias("new"), order.alias("at")).alias("_seq"))
    kind = inc.schema["_seq"].dataType["at"].dataType
    touched = inc.select("dt").distinct()
    old = with_dt(existing).join(touched, "dt", "left_semi").select(
        *LISTING_COLUMNS, "dt", F.struct(F.lit(0).alias("new"), F.lit(None).cast(kind).alias("at")).alias("_seq"))
    return dedupe_latest(old.unionByName(inc), ["_seq"]).drop("_seq")


def upsert_into_lake(spark, lake_path: str, incoming: DataFrame, sequence: str | None = None) -> int:
    """K1 sink: write ``incoming`` as one delta of the lake, of several rows of a key the last.

    Only the incoming rows are written: a late key costs a small file in its date, not the date. Readers let
    the newest delta win; ``compact`` folds deltas in. Returns the rows received (statements, not net rows: D6).
    """
    order = F.col(sequence) if sequence else F.monotonically_increasing_id()
    numbered = with_dt(incoming).select(*LISTING_COLUMNS, "dt", order.alias("_seq"))
    rows = scratch_table(numbered, "upsert")
    add_delta(dedupe_latest(rows, ["_seq"]).drop("_seq"), lake_path, ROWS, CLUSTER_COLUMNS)
    return rows.count()


def list_old_vintage(raw: DataFrame) -> DataFrame:
    """K6 dry run: the ``dt``s whose files predate schema v1.1 (no quality tag)."""
    if "quality" not in raw.columns:
        return raw.select("dt").distinct()
    return raw.groupBy("dt").agg(F.count_if(F.col("quality").isNull()).alias("untagged")).filter(
        "untagged > 0").select("dt")


def upgrade_schema(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """K6: rewrite old-vintage rows to v1.1: synthesize quality (backfill
    rule), re-enrich regions, cast to the declared schema. Rows already at
    v1.1 are returned unchanged, so a second run is a no-op."""
    r = raw
    for c in ("quality", *REGION_COLUMNS):
        if c not in raw.columns:
            r = r.withColumn(c, F.lit(None))
    # one pass: every row looks its region up, rows without a tag take what they found
    kept = [F.col(c).alias(f"_had_{c}") for c in REGION_COLUMNS]
    plain = [c for c in r.columns if c not in REGION_COLUMNS]
    r = enrich_regions(r.select(*plain, *kept), regions)
    old = F.col("quality").isNull()
    for c in REGION_COLUMNS:
        r = r.withColumn(c, F.when(old, F.col(c)).otherwise(F.col(f"_had_{c}")))
    r = r.withColumn("quality", F.when(old, quality_backfill()).otherwise(F.col("quality")))
    return r.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA.fields])


_RUN = "run string, dt date"


def _unfinished(spark, root: str) -> DataFrame:
    """(run, dt) of upgrades that began and did not get to the end."""
    begun, ended = f"{root}/_upgrades/begun", f"{root}/_upgrades/ended"
    runs = spark.read.schema(_RUN).parquet(begun) if path_exists(spark, begun) else spark.createDataFrame([], _RUN)
    if path_exists(spark, ended):
        runs = runs.join(spark.read.schema("run string").parquet(ended), "run", "left_anti")
    return runs


def upgrade_lake(spark, root: str, regions: DataFrame, dry_run: bool = False, code_version: str = "") -> list:
    """K6 sink: upgrade the old-vintage ``dt``s of the lake at ``root``.

    ``dry_run`` only lists them. Otherwise their rows are written at v1.1 as one
    delta of whole dates, then their manifest rows, marked ``backfilled``. The
    dates are noted before and ticked off after, so a failed upgrade is finished
    by the next run; a run after that finds nothing to do.
    """
    prices_path = f"{root}/prices"
    raw = scan_prices(spark, prices_path, merge_schema=True)
    left = _unfinished(spark, root).collect()  # a row a date, bounded by the calendar, like the report below
    old = sorted({r.dt for r in list_old_vintage(raw).collect()} | {r.dt for r in left})
    if dry_run or not old:
        return old
    run = uuid.uuid4().hex
    spark.createDataFrame([(run, d) for d in old], _RUN).write.mode("append").parquet(f"{root}/_upgrades/begun")
    dates = F.col("dt").isin([F.lit(d) for d in old])
    add_delta(upgrade_schema(raw.filter(dates), regions), prices_path, DATES, CLUSTER_COLUMNS)
    _note_snapshots(scan_prices(spark, prices_path).filter(dates), root, code_version=code_version, backfilled=True)
    done = {run} | {r.run for r in left}
    spark.createDataFrame([(x,) for x in sorted(done)], "run string").write.mode("append").parquet(f"{root}/_upgrades/ended")
    return old


def compact(spark, path: str, first: str, last: str) -> None:
    """Fold the deltas of the dates from ``first`` to ``last`` in, and write these dates in fewer, larger files."""
    fold(spark, path, LAKE_SCHEMA, LISTING_KEY, first, last, CLUSTER_COLUMNS)


def export_csv(df: DataFrame, path: str) -> None:
    """K8: the filtered listings as CSV with a header, cheapest $/GPU-h first (a folder of ordered part files)."""
    df.orderBy("price_per_gpu_hour").write.mode("overwrite").option("header", True).csv(path)


def write_snapshot_summary(spark, listings: DataFrame, path: str) -> int:
    """K2 sink: store one summary row per snapshot of ``listings``, replacing those of the same snapshots.

    Returns the snapshots written."""
    new = snapshot_summary(listings).withColumn("dt", F.to_date("timestamp"))
    new = scratch_table(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_SUMMARY_SCHEMA]), "summary")
    add_delta(new, path, ROWS)
    return new.count()


def read_snapshot_summary(spark, path: str) -> DataFrame:
    """The stored summaries, with their ``dt``."""
    return read_table(spark, path, STORED_SUMMARY_SCHEMA, ["timestamp"])
