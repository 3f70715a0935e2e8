"""Bitmaps, quarantine, outages, pairs and frames on hand-written rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import bitmaps, features
from pricepanel.panel import Panel
from pricepanel.sources import catalogue


def _panel(spark, rows):
    """(stamp, provider, type, price) as a panel of one-GPU offers."""
    df = spark.createDataFrame(rows, "t string, provider string, gpu_type string, price_per_hour double").select(
        F.col("t").cast("timestamp").alias("timestamp"), "provider", "gpu_type", F.lit(1).alias("gpu_count"), "price_per_hour",
        F.lit("ok").alias("quality"))
    return Panel(df, None, df.select("timestamp"))


# --- bitmaps -------------------------------------------------------------------------------------


def test_bitmaps_over_many_buckets_equal_distinct_counts(spark, tmpdir_path):
    rows = spark.range(60_000).select(
        F.timestamp_seconds(1704067200 + (F.col("id") % 7) * 86400).alias("timestamp"),
        F.concat(F.lit("p"), F.col("id") % 40_001).alias("provider"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 11)).alias("gpu_type"), F.lit(None).cast("string").alias("region_group"))
    path = f"{tmpdir_path}/distinct"
    bitmaps.write_bitmaps(spark, rows.filter("timestamp < '2024-01-05'"), path)
    bitmaps.write_bitmaps(spark, rows.filter("timestamp >= '2024-01-03'"), path)  # two snapshots again, new names
    names = bitmaps.read_names(spark, path)
    assert names.count() == names.select("column", "name").distinct().count() == 40_001 + 11
    assert names.groupBy("column").agg((F.max("id") + 1 == F.count("id")).alias("dense")).filter("not dense").count() == 0
    maps = bitmaps.read_bitmaps(spark, path)
    assert maps.select("bucket").distinct().count() == 2
    for by in (F.col("timestamp"), F.lit("all")):
        got = bitmaps.distinct_counts(maps, {"k": by})
        want = rows.groupBy(by.alias("k")).agg(
            F.count("*").alias("listings"), F.count_distinct("provider").alias("providers"),
            F.count_distinct("gpu_type").alias("gpu_types"), F.count_distinct("region_group").alias("region_groups"))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_bitmaps_of_the_same_snapshot_are_replaced(spark, tmpdir_path):
    path = f"{tmpdir_path}/distinct"
    one = spark.createDataFrame([("2024-01-01", "a", "x", "r"), ("2024-01-01", "b", "x", "r")],
                                "t string, provider string, gpu_type string, region_group string").select(
        F.col("t").cast("timestamp").alias("timestamp"), "provider", "gpu_type", "region_group")
    bitmaps.write_bitmaps(spark, one, path)
    bitmaps.write_bitmaps(spark, one.filter("provider = 'b'").withColumn("gpu_type", F.lit("y")), path)
    r = bitmaps.dataset_stats_from_bitmaps(spark, path).first()
    assert (r.snapshots, r.total_records, r.providers, r.gpu_types) == (1, 1, 1, 1)
    assert {x.name: x.id for x in bitmaps.read_names(spark, path).filter("column = 'provider'").collect()} == {"a": 0, "b": 1}


# --- payloads ------------------------------------------------------------------------------------


def _host(**changes):
    r = lambda a, p: {"amount": a, "price": p}
    specs = {"cpu": r(9.0, 0.1), "ram": r(33, 0.01), "storage": r(100.0, 0.001),
             "gpu": {"h100": {"amount": 2, "price": 1.5, "vram": 80}, "none": {"amount": 0, "price": 1.0}}}
    specs |= changes
    return {"location": {"country": "New Zealand"}, "specs": specs}


def test_payloads_of_any_shape_are_told_apart_and_kept(spark):
    good = {"hostnodes": {"a": _host()}}
    cases = {
        json.dumps(good): ("ok", None, []),
        json.dumps(good | {"version": 3, "at": None}): ("ok", None, ["at", "version"]),
        json.dumps({"hostnodes": {}}): ("ok", None, []),
        json.dumps({"oops": {}}): ("missing_key", "$.hostnodes", ["oops"]),
        json.dumps({"hostnodes": [1, 2]}): ("bad_type", "$.hostnodes", []),
        json.dumps({"hostnodes": {"a": _host(), "b": _host(ram={"amount": "many", "price": 1})}}):
            ("bad_field", "$.hostnodes['b'].specs.ram.amount", []),
        json.dumps({"hostnodes": {"a": _host(gpu=[])}}): ("bad_field", "$.hostnodes['a'].specs.gpu", []),
        json.dumps({"hostnodes": {"a": 5}}): ("bad_field", "$.hostnodes['a'].specs.cpu.amount", []),
        "{bad": ("malformed", "$", None), "": ("malformed", "$", None), None: ("malformed", "$", None),
        "[1]": ("missing_key", "$.hostnodes", None), "null": ("missing_key", "$.hostnodes", None),
    }
    df = spark.createDataFrame([(f"s{i}", c) for i, c in enumerate(cases)], "source string, payload string")
    rows = {r.payload: (r.status, r.path, r.unknown) for r in catalogue.parsed_payloads(df).collect()}
    assert rows == cases
    kept = catalogue.quarantine(df)
    assert kept.columns == ["source", "payload", "status", "path", "unknown"] and kept.count() == 10
    offers = catalogue.flatten_host_offers(df.filter("source = 's0'")).collect()
    assert [(r.instance_name, r.location, r.price, r.cpu, r.memory, r.gpu_count, r.gpu_name, r.gpu_memory, r.disk_size)
            for r in offers] == [("a", "newzealand", pytest.approx(0.9 + 0.33 + 0.1 + 3.0), 8.0, 32.0, 2, "h100", 80.0, 100.0)]
    # a mended source: the quarantined payloads are read again, with the offers they always held
    mended = catalogue.replay(kept.filter("path LIKE '%ram.amount'"), F.replace(F.col("payload"), F.lit('"many"'), F.lit("4")))
    assert sorted((r.instance_name, r.memory) for r in mended.collect()) == [("a", 32.0), ("b", 4.0)]


def test_a_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("s", "{}")], "source string, payload string").filter("length(payload) > 0")
    for q in (catalogue.flatten_host_offers(df), catalogue.quarantine(df), catalogue.quarantine_report(df)):
        plan = q._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parse_json") + plan.count("parsejson") == 1, plan


# --- series --------------------------------------------------------------------------------------


def test_outages_of_each_series(spark):
    at = lambda d, h: f"2024-01-{d:02d} {h:02d}:03:17"
    rows = [(at(1, 9), "a", "x", 1.0), (at(1, 21), "a", "x", 1.0), (at(4, 9), "a", "x", 1.0), (at(4, 21), "a", "x", 1.0),
            (at(1, 9), "b", "x", 1.0), (at(2, 9), "b", "x", 1.0), (at(1, 21), "b", "y", 2.0), (at(4, 21), "b", "y", 2.0)]
    got = features.series_outages(_panel(spark, rows)).collect()
    d = lambda day, h: dt.datetime(2024, 1, day, h)
    assert sorted((r.provider, r.gpu_type, r.outage_start, r.outage_end, r.ended, r.missing_slots) for r in got) == [
        ("a", "x", d(2, 0), d(4, 0), True, 4), ("b", "x", d(2, 12), d(5, 0), False, 5), ("b", "y", d(2, 0), d(4, 12), True, 5)]
    assert features.series_outages(_panel(spark, rows), min_slots=5).count() == 2


def test_pairs_take_the_largest_providers_or_the_named(spark):
    rows = []
    for day in range(1, 7):
        for p, slope in (("a", 1), ("b", 2), ("c", -1), ("d", 5)):
            for _ in range({"a": 3, "b": 2, "c": 2, "d": 1}[p]):
                rows.append((f"2024-01-{day:02d}", p, "x", 10.0 + slope * day * (1 if day % 2 else 1.5)))
    p = _panel(spark, rows)
    top = {(r.provider_a, r.provider_b): (r.n_days, r.correlation) for r in features.provider_pairs(p, per_type=3).collect()}
    assert top == {("a", "b"): (6, 1.0), ("a", "c"): (6, -1.0), ("b", "c"): (6, -1.0)}
    named = features.provider_pairs(p, named=["d", "c"]).collect()
    assert [(r.provider_a, r.provider_b, r.correlation) for r in named] == [("c", "d", -1.0)]
    assert features.provider_pairs(p, per_type=3, min_days=7).count() == 0
    plan = features.provider_pairs(p, per_type=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" not in plan  # no series is joined with another


def test_frames_follow_hours_across_missing_snapshots(spark):
    rows = [(f"2024-01-{d:02d} {h}:05:00", "a", "x", float(v)) for d, h, v in
            [(1, "09", 1), (1, "21", 2), (2, "09", 3), (4, "09", 10), (4, "21", 20)]]
    got = features.feature_frame_hours(_panel(spark, rows)).orderBy("slot").collect()
    assert [r.lag_price for r in got] == [None, None, 1.0, None, None]
    assert [r.rolling_slots for r in got] == [1, 2, 3, 2, 2]
    assert [r.rolling_price for r in got] == [1.0, 1.5, 2.0, 6.5, 15.0]
