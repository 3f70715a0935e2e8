"""Sinks and lake maintenance: idempotent upserts, vintage upgrade, sinks."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricepanel.operators import lake as K
from pricepanel.plans.pipeline import panel
from pricepanel.schema import LISTING_COLUMNS
from pricepanel.sources.lake import scan_prices, write_lake


def _content(df):
    return sorted((tuple(r) for r in df.select(*LISTING_COLUMNS).collect()), key=repr)


def test_upsert_twice_equals_once(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    lake = f"{tmpdir_path}/lake"
    base = p.prices.filter(F.col("dt") < F.lit("1996-01-01").cast("date"))
    write_lake(base, lake, dynamic=False)
    latest = p.prices.filter(F.col("dt") == F.lit("1995-12-01").cast("date"))
    incoming = latest.withColumn("price_per_hour", F.col("price_per_hour") * 2)
    n1 = K.upsert_into_lake(spark, lake, incoming)
    once = _content(scan_prices(spark, lake))
    n2 = K.upsert_into_lake(spark, lake, incoming)
    assert n1 == n2 == latest.count()
    assert _content(scan_prices(spark, lake)) == once
    # other partitions untouched, the touched one replaced
    assert scan_prices(spark, lake).count() == base.count()
    got = scan_prices(spark, lake).filter(F.col("dt") == F.lit("1995-12-01").cast("date")).agg(
        F.sum("price_per_hour")).first()[0]
    assert abs(got - 2 * latest.agg(F.sum("price_per_hour")).first()[0]) < 1e-6


def test_upsert_new_key_is_added(spark):
    p = panel(spark, SF_SMALL)
    latest = p.latest()
    new = latest.limit(1).withColumn("instance_type", F.lit("brand-new"))
    merged = K.upsert_latest_wins(p.prices, new)
    assert merged.count() == p.prices.filter(F.col("dt") == latest.select("dt").first()[0]).count() + 1


def test_upgrade_is_idempotent(spark, tmpdir_path):
    from pricepanel.sources.panel import old_vintage_rows
    p = panel(spark, SF_SMALL)
    tree = f"{tmpdir_path}/mixed"
    old_vintage_rows(p.prices, "1996-01-01").write.partitionBy("dt").parquet(tree)
    p.prices.filter(F.col("dt") >= F.lit("1996-01-01").cast("date")).select(*LISTING_COLUMNS, "dt") \
        .write.mode("append").partitionBy("dt").parquet(tree)
    raw = scan_prices(spark, tree, merge_schema=True)
    old = [r.dt for r in K.list_old_vintage(raw).collect()]
    assert old and all(d.year == 1995 for d in old)
    up1 = K.upgrade_schema(raw, p.regions)
    up2 = K.upgrade_schema(up1, p.regions)
    assert K.list_old_vintage(up1).count() == 0
    assert _content(up1) == _content(up2)


def test_publish_skips_existing_snapshots(spark):
    p = panel(spark, SF_SMALL)
    published = p.snapshots.limit(10)
    fresh = K.publish_new_snapshots(p.prices, published)
    assert fresh.join(published.select("timestamp"), "timestamp").count() == 0
    assert fresh.count() + p.prices.join(published.select("timestamp"), "timestamp").count() == p.prices.count()


def test_manifest_summary_format(spark):
    p = panel(spark, SF_SMALL)
    m = K.snapshot_manifest(p.prices, emitted_at="2026-01-01 00:00:00", code_version="abc").first()
    parts = m.quality_summary.split(",")
    assert parts == sorted(parts) and sum(int(x.split("=")[1]) for x in parts) == m.row_count
    assert m.schema_version == "1.1" and m.code_version == "abc"


def test_snapshot_summary_metadata_is_json(spark):
    p = panel(spark, SF_SMALL)
    r = K.snapshot_summary(p.latest()).first()
    meta = json.loads(r.metadata)
    assert meta["providers"] == sorted(meta["providers"]) and len(meta["gpu_types"]) == r.gpu_types_count


def test_csv_and_json_sinks(spark, tmpdir_path):
    from pricepanel.operators import market
    from pricepanel.sources.regions_file import load_regions, write_regions
    p = panel(spark, SF_SMALL)
    p.latest().write.option("header", True).csv(f"{tmpdir_path}/csv")              # K8
    market.headline(p).write.json(f"{tmpdir_path}/findings")                      # K9
    assert spark.read.json(f"{tmpdir_path}/findings").first().total_rows == p.prices.count()
    write_regions(p.regions, f"{tmpdir_path}/regions")                            # K10
    back = load_regions(spark, f"{tmpdir_path}/regions")
    assert back.count() == p.regions.count()
    assert load_regions(spark, f"{tmpdir_path}/missing").count() == 0             # S3 missing file


def test_dedupe_is_order_insensitive(spark):
    from pricepanel.sources.panel import F1_SEQUENCE, listing_panel_raw
    raw = listing_panel_raw(spark, SF_SMALL)
    a = K.dedupe_latest(raw, F1_SEQUENCE).drop("seq_a", "seq_b", "seq_c")
    b = K.dedupe_latest(raw.repartition(7).orderBy(F.rand(3)), F1_SEQUENCE).drop("seq_a", "seq_b", "seq_c")
    cols = [c for c in LISTING_COLUMNS if c in a.columns]
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_day_slices_union_equals_whole(spark):
    from pricepanel.operators.trends import trends_daily
    from pricepanel.panel import Panel
    p = panel(spark, SF_SMALL)
    whole = trends_daily(p, 365)
    cut = F.lit("2001-06-01").cast("date")
    early = Panel(p.prices.filter(F.col("dt") < cut), p.regions, p.snapshots)
    late = Panel(p.prices.filter(F.col("dt") >= cut), p.regions, p.snapshots)
    parts = trends_daily(early, 365).unionByName(trends_daily(late, 365))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))


def test_publish_skips_already_published(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/pub"
    early = p.prices.filter(F.col("dt") < F.lit("1996-01-01").cast("date"))
    n1 = K.publish_snapshots(spark, early, root)
    n2 = K.publish_snapshots(spark, early, root)                 # same input again: nothing new
    more = p.prices.filter(F.col("dt") < F.lit("1997-01-01").cast("date"))
    n3 = K.publish_snapshots(spark, more, root)                  # only the 1996 snapshots are new
    assert (n1, n2) == (12, 0) and n3 == 12
    assert _content(scan_prices(spark, f"{root}/prices")) == _content(more)
    assert K.read_manifest(spark, root).count() == 24


def test_upgrade_lake_in_place_marks_backfilled(spark, tmpdir_path):
    from pricepanel.sources.panel import old_vintage_rows
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/lake"
    old_vintage_rows(p.prices, "1995-04-01").write.partitionBy("dt").parquet(f"{root}/prices")
    K.publish_snapshots(spark, p.prices.filter(F.col("dt") >= F.lit("1995-04-01").cast("date"))
                        .filter(F.col("dt") < F.lit("1996-01-01").cast("date")), root)
    listed = K.upgrade_lake(spark, root, p.regions, dry_run=True)
    assert sorted(d.month for d in listed) == [1, 2, 3]
    assert K.upgrade_lake(spark, root, p.regions) == listed
    assert K.upgrade_lake(spark, root, p.regions) == []                      # idempotent
    lake = scan_prices(spark, f"{root}/prices")
    assert lake.filter(F.col("quality").isNull()).count() == 0
    man = K.read_manifest(spark, root)
    assert man.filter("backfilled").count() == 3 and man.count() == 12
    assert man.agg(F.sum("row_count")).first()[0] == lake.count()


def test_source_fingerprint_follows_rewritten_input(spark, tmpdir_path):
    """Derived tables are keyed by their inputs: rewriting an input table changes the key."""
    from pricepanel.sources.tables import source_fingerprint
    spark.range(10).write.parquet(f"{tmpdir_path}/t.parquet")
    first = source_fingerprint(spark, tmpdir_path, ["t"])
    assert first == source_fingerprint(spark, tmpdir_path, ["t"])
    spark.range(1000).write.mode("overwrite").parquet(f"{tmpdir_path}/t.parquet")
    assert source_fingerprint(spark, tmpdir_path, ["t"]) != first
    assert source_fingerprint(spark, tmpdir_path, ["absent"]).endswith(":?")


def _two(p, spark):
    """Two listings of one key with different prices, in this order, and a third key."""
    rows = p.latest().filter("is_spot = false").limit(2).select(*LISTING_COLUMNS).collect()
    first, other = rows[0].asDict(), rows[1].asDict()
    from pyspark.sql.types import StructType
    schema = StructType([p.prices.schema[c] for c in LISTING_COLUMNS])
    return spark.createDataFrame([first | {"price_per_hour": 1.0}, other, first | {"price_per_hour": 2.0}], schema).coalesce(1)


def test_first_upsert_keeps_the_last_row_of_a_key(spark, tmpdir_path):
    rows = _two(panel(spark, SF_SMALL), spark)
    assert K.upsert_into_lake(spark, f"{tmpdir_path}/lake", rows) == 3
    stored = scan_prices(spark, f"{tmpdir_path}/lake")
    assert stored.count() == 2 and stored.filter("price_per_hour = 2.0").count() == 1
    # an explicit sequence decides instead of the order of the frame
    numbered = rows.withColumn("at", -F.monotonically_increasing_id())
    K.upsert_into_lake(spark, f"{tmpdir_path}/lake", numbered, sequence="at")
    stored = scan_prices(spark, f"{tmpdir_path}/lake")
    assert stored.count() == 2 and stored.filter("price_per_hour = 1.0").count() == 1


def test_the_newest_of_several_upserts_wins(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    lake = f"{tmpdir_path}/lake"
    days = [F.lit(x).cast("date") for x in ("1995-05-01", "1995-06-01")]
    may, june = (p.prices.filter(F.col("dt") == x) for x in days)
    K.upsert_into_lake(spark, lake, may.withColumn("price_per_hour", F.lit(1.0)))
    K.upsert_into_lake(spark, lake, may.withColumn("price_per_hour", F.lit(5.0)))
    K.upsert_into_lake(spark, lake, june)
    got = scan_prices(spark, lake).filter(F.col("dt") == days[0])
    assert {r[0] for r in got.select("price_per_hour").distinct().collect()} == {5.0} and got.count() == may.count()


def test_publish_after_a_failure_between_the_writes_duplicates_nothing(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/pub"
    early = p.prices.filter(F.col("dt") < F.lit("1995-04-01").cast("date"))
    write_lake(early, f"{root}/prices", dynamic=False)             # prices written, manifest row absent
    assert K.publish_snapshots(spark, early, root) == 3
    assert scan_prices(spark, f"{root}/prices").count() == early.count()
    assert K.read_manifest(spark, root).count() == 3


def test_upgrade_after_a_failure_before_the_manifest_marks_backfilled(spark, tmpdir_path, monkeypatch):
    import pytest
    from pricepanel.sources.panel import old_vintage_rows
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/lake"
    old_vintage_rows(p.prices, "1995-03-01").write.partitionBy("dt").parquet(f"{root}/prices")
    manifest = K.snapshot_manifest
    monkeypatch.setattr(K, "snapshot_manifest", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        K.upgrade_lake(spark, root, p.regions)
    monkeypatch.setattr(K, "snapshot_manifest", manifest)
    assert len(K.upgrade_lake(spark, root, p.regions)) == 2
    assert K.read_manifest(spark, root).filter("backfilled").count() == 2
    assert K.upgrade_lake(spark, root, p.regions) == []


def test_summary_table_is_upserted_by_snapshot(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    early = p.prices.filter(F.col("dt") < F.lit("1995-06-01").cast("date"))
    path = f"{tmpdir_path}/summary"
    assert K.write_snapshot_summary(spark, early, path) == 5
    assert K.write_snapshot_summary(spark, early.filter("dt = '1995-03-01'").limit(1), path) == 1
    got = {r.dt.month: r.total_instances for r in K.read_snapshot_summary(spark, path).collect()}
    assert len(got) == 5 and got[3] == 1


def test_export_and_compact(spark, tmpdir_path):
    from pricepanel.operators.reports import latest_snapshot
    p = panel(spark, SF_SMALL)
    K.export_csv(latest_snapshot(p), f"{tmpdir_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/csv")
    assert back.count() == latest_snapshot(p).count() and "price_per_gpu_hour" in back.columns
    write_lake(p.prices, f"{tmpdir_path}/lake", dynamic=False)
    before = _content(scan_prices(spark, f"{tmpdir_path}/lake"))
    K.compact(spark, f"{tmpdir_path}/lake", "1995-01-01", "1996-01-01")
    assert _content(scan_prices(spark, f"{tmpdir_path}/lake")) == before


def test_gaps_on_stamps_some_minutes_into_the_slot(spark):
    from pricepanel.operators import features
    from pricepanel.panel import Panel
    stamps = ["2024-01-01 09:03:17", "2024-01-01 21:05:02", "2024-01-02 09:01:40", "2024-01-02 21:04:00", "2024-01-06 09:02:00"]
    rows = spark.createDataFrame([(s, "a", "H100", 1, float(i)) for i, s in enumerate(stamps)],
                                 "t string, provider string, gpu_type string, gpu_count int, price_per_hour double")
    rows = rows.select(F.col("t").cast("timestamp").alias("timestamp"), "*", F.lit("ok").alias("quality"))
    p = Panel(rows, None, rows.select("timestamp"))
    mask = features.gap_mask(p).orderBy("timestamp").collect()
    assert sum(r.observed for r in mask) == 5 and len(mask) == 11
    assert {str(r.day) for r in mask if r.outage} == {"2024-01-03", "2024-01-04", "2024-01-05"}
    filled = features.within_day_fill(p).orderBy("timestamp").collect()
    assert [r.price for r in filled if not r.was_missing] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_one_bad_number_rejects_its_item_only(spark):
    from pricepanel.sources import ingest
    rows = [("aws", "H100", float("nan"), 80.0, 1.0), ("aws", "H100", 1e18, 80.0, 1.0), ("aws", "H100", 1.0, float("inf"), 1.0),
            ("aws", None, 1.0, 80.0, 2.0), ("aws", "H100", 8.0, 80.0, 2.0)]
    items = spark.createDataFrame(rows, "provider string, name string, gpu_count double, gpu_memory double, memory double")
    items = items.select(F.lit("2024-01-01").cast("timestamp").alias("timestamp"), "*", *[
        F.lit(None).cast(t).alias(c) for c, t in (("gpu_name", "string"), ("instance_name", "string"), ("cpu", "double"),
                                                  ("location", "string"), ("spot", "boolean"))], F.lit("1.5").alias("price"))
    got = ingest.normalize_listings(items).collect()
    assert [(r.gpu_type, r.instance_type, r.region, r.gpu_count) for r in got] == [
        ("Unknown", "unknown", "unknown", 1), ("H100", "H100", "unknown", 8)]
    report = {(r.status, r.reason): r["items"] for r in ingest.ingest_report(items).collect()}
    assert report == {("rejected", "gpu_count"): 2, ("rejected", "size"): 1, ("accepted", None): 2}


def test_hub_is_named_by_its_largest_raw_coordinate(spark):
    from pricepanel.operators import geo
    rows = [("a", 1.001)] * 3 + [("a", 1.002)] * 3 + [("b", 1.003)] * 5
    df = spark.createDataFrame([(m, x, 2.0) for m, x in rows], "metro string, lat double, lon double")
    got = geo.top_hubs(df).first()
    assert (got.metro, got.listings) == ("b", 11)
