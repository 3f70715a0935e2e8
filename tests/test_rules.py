"""Hand-written edge rows for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.operators import regions as R
from pricepanel.sources import catalogue, ingest

TS = dt.datetime(2026, 1, 12, 9, 0, 0)


def _items(spark):
    rows = [
        ("AWS", "H100", None, None, 8.0, 80.0, 96.0, 1152.0, "us-east-1", "98.3", False),
        ("Lambda", None, "A10", None, 1.0, 24.0, 30.0, 200.0, "us-west-1", "0.75", False),
        ("lambdalabs", "H100", None, None, 1.0, 80.0, 26.0, 200.0, "us-west-1", "3.3", False),
        ("gcp", None, "Unknown", None, 1.0, 16.0, 8.0, 30.0, "us-central1", "1.0", False),
        ("gcp", "T4", None, None, 1.0, 0.0, 8.0, 30.0, "us-central1", "0.4", True),
        ("gcp", "T4", None, None, 1.0, 15.9, 8.0, 30.0, "us-central1", "0.4", False),
        ("gcp", "T4", None, None, 0.0, 16.0, 8.0, 30.0, "us-central1", "0.1", False),
        ("gcp", "T4", None, None, None, 16.0, 8.0, 30.0, "us-central1", "0.1", False),
        ("azure", "T4", None, None, 1.0, 16.0, 8.0, 30.0, "eastus", "n/a", False),
        (None, "T4", None, None, 1.0, 16.0, 8.0, 30.0, "eastus", "0.4", False),
    ]
    cols = ["provider", "gpu_name", "name", "instance_name", "gpu_count", "gpu_memory", "cpu", "memory",
            "location", "price", "spot"]
    return spark.createDataFrame(rows, ",".join(f"{c} {t}" for c, t in zip(cols, [
        "string", "string", "string", "string", "double", "double", "double", "double", "string", "string",
        "boolean"]))).withColumn("timestamp", F.lit(TS).cast("timestamp"))


def test_normalize_listings_f4(spark):
    out = ingest.normalize_listings(_items(spark)).orderBy("provider", "gpu_type", "gpu_memory_gb").collect()
    got = [(r.provider, r.gpu_type, r.gpu_memory_gb, r.quality) for r in out]
    assert ("aws", "H100", 80, "ok") in got
    assert ("lambda", "A10", 24, "ok") in got
    assert ("lambdalabs", "H100", 80, "ok") in got          # alias table has 'lambda', passthrough (D20)
    assert ("gcp", "Unknown", 16, "unknown_gpu") in got
    assert ("gcp", "T4", None, "missing_memory") in got     # memory 0 is missing at ingest (D1)
    assert ("gcp", "T4", 15, "ok") in got                   # 15.9 truncates (D10)
    assert len(got) == 6
    lam = [r for r in out if r.provider == "lambda"][0]
    assert lam.instance_type == "A10"                       # instance name falls back to the name


def test_ingest_report_counts_rejects(spark):
    rep = {(r.source, r.status, r.reason): r.items for r in ingest.ingest_report(_items(spark)).collect()}
    assert rep[("azure", "rejected", "price")] == 1
    assert rep[(None, "rejected", "provider")] == 1
    assert rep[("gcp", "dropped", "no_gpu")] == 2


def test_filter_ingest_falsy_options_are_no_filter(spark):
    items = _items(spark)
    assert ingest.filter_ingest(items, min_gpu_memory=0, max_price=None, gpu_name="").count() == items.count()
    assert ingest.filter_ingest(items, gpu_name="t4").count() == 6


def test_empty_snapshot_guard(spark):
    import pytest
    with pytest.raises(ingest.EmptySnapshotError):
        ingest.require_rows(ingest.normalize_listings(_items(spark).limit(0)))


def test_quality_rules_differ_on_null_count(spark):
    df = spark.createDataFrame([(None, "H100", 80), (0, "H100", 80), (1, "Unknown", None), (1, "T4", None)],
                               "gpu_count int, gpu_type string, gpu_memory_gb int")
    got = df.select(C.quality_view().alias("v"), C.quality_backfill().alias("b")).collect()
    assert [(r.v, r.b) for r in got] == [("ok", "cpu_only"), ("cpu_only", "cpu_only"),
                                         ("unknown_gpu", "unknown_gpu"), ("missing_memory", "missing_memory")]


def test_ppgh_zero_count_is_null_not_error(spark):
    df = spark.createDataFrame([(2.0, 0), (2.0, 2)], "price_per_hour double, gpu_count int")
    got = df.select(C.ppgh().alias("p"), C.price_per_gpu_hour().alias("r")).collect()
    assert [(r.p, r.r) for r in got] == [(None, 0.0), (1.0, 1.0)]


def test_title_case_matches_python(spark):
    words = ["gov:virginia", "ashburn", "saltlake", "a1b-c_d", "", "new-york-city"]
    df = spark.createDataFrame([(w,) for w in words], "m string")
    got = [r.t for r in df.select(C.title_case("m").alias("t")).collect()]
    assert got == [w.title() for w in words]


def test_metro_label(spark):
    df = spark.createDataFrame([("us-gov-virginia",), ("us-east-ashburn-att",), ("us-west-saltlakecity",)], "m string")
    got = [r.l for r in df.select(C.metro_label("m").alias("l")).collect()]
    assert got == ["Gov:Virginia", "Ashburn", "Saltlake"]


def test_freshness_and_provider_state(spark):
    df = spark.createDataFrame([(10.0, 1), (48.0, 0), (100.0, 0), (200.0, 0)], "h double, n long")
    got = df.select(C.freshness_state("h").alias("f"), C.provider_state("n", "h").alias("p")).collect()
    assert [(r.f, r.p) for r in got] == [("fresh", "green"), ("stale", "yellow"), ("outdated", "yellow"),
                                         ("outdated", "red")]


def _rules(spark):
    prules = spark.createDataFrame([
        ("aws", "north-one-1", "north-one", "NO", 1.0, 2.0, "north"),
        ("aws", "north-gov-one-1", "north-gov-one", "NO", 1.0, 2.0, "north"),
        ("gcp", "east1", "east", "EA", 3.0, 4.0, "east"),
        ("oci", "XX-CITY-1", "city", "CI", 5.0, 6.0, "city"),
    ], "provider string, key string, region_canonical string, country string, lat double, lon double, "
       "region_group string")
    crules = spark.createDataFrame([("JP", "JP", 35.0, 139.0, "asia"), ("GB", "GB", 51.0, 0.0, "europe"),
                                    ("IS", "IS", 64.0, -21.0, "europe"), ("UK", "GB", 51.0, 0.0, "europe")],
                                   "code string, country string, lat double, lon double, region_group string")
    return prules, crules


def test_region_cascade_f5(spark):
    cases = {
        ("aws", "north-one-1"): ("north-one", "NO"),
        ("aws", "NORTH-ONE-1"): ("north-one", "NO"),
        ("aws", "north-one-1-nyc-1"): ("north-one-zone", "NO"),
        ("aws", "north-gov-one-1-abc-1"): ("north-gov-one-zone", "NO"),
        ("gcp", "east1-a"): ("east", "EA"),
        ("gcp", "east1-aa"): (None, None),
        ("oci", "xx-city-1"): ("city", "CI"),
        ("vastai", "AP-JP-1"): (None, "JP"),
        ("runpod", "eu-west-uk-lo-1"): (None, "GB"),
        ("runpod", "EUR-IS-2"): (None, "IS"),
        ("vastai", ""): (None, None),
        ("vastai", "nowhere"): (None, None),
    }
    pairs = spark.createDataFrame(list(cases), "provider string, raw_region string")
    prules, crules = _rules(spark)
    got = {(r.provider, r.raw_region): (r.region_canonical, r.country)
           for r in R.resolve_regions(pairs, prules, crules).collect()}
    assert got == cases


def test_region_refresh_keeps_hand_edits_and_drops_gone(spark):
    prules, crules = _rules(spark)
    pairs = spark.createDataFrame([("aws", "north-one-1"), ("gcp", "east1-a")], "provider string, raw_region string")
    existing = spark.createDataFrame([
        ("aws", "north-one-1", None, None, None, None, None),          # blank hand edit wins
        ("aws", "old-region", "x", "X", 0.0, 0.0, "g"),                 # pair no longer seen
    ], "provider string, raw_region string, region_canonical string, country string, lat double, lon double, "
       "region_group string")
    got = {(r.provider, r.raw_region): r.region_canonical
           for r in R.regions_refresh(pairs, existing, prules, crules).collect()}
    assert got == {("aws", "north-one-1"): None, ("gcp", "east1-a"): "east"}
    cov = R.region_coverage(R.regions_refresh(pairs, existing, prules, crules)).first()
    assert (cov.pairs, cov.mapped, cov.unmapped) == (2, 1, 1)


def test_host_catalogue_f3(spark):
    good = ('{"hostnodes": {"h1": {"location": {"country": "United States"}, "specs": {'
            '"cpu": {"amount": 8, "price": 0.003}, "ram": {"amount": 32, "price": 0.002}, '
            '"storage": {"amount": 100, "price": 0.00005}, '
            '"gpu": {"rtx4090": {"amount": 2, "price": 1.2, "vram": 24}, "a100": {"amount": 0, "price": 2, "vram": 80}}}}}}')
    payloads = spark.createDataFrame([("td", good), ("td", '{"oops": {}}'), ("td", "{bad")],
                                     "source string, payload string")
    offers = catalogue.flatten_host_offers(payloads).collect()
    assert len(offers) == 1
    o = offers[0]
    assert (o.location, o.price, o.gpu_count, o.cpu, o.memory) == ("unitedstates", 2.493, 2, 8.0, 32.0)
    rep = {r.status: r.payloads for r in catalogue.quarantine_report(payloads).collect()}
    assert rep == {"ok": 1, "missing_key": 1, "malformed": 1}


def test_json_roundtrip_old_documents(spark):
    df = spark.createDataFrame([('{"timestamp": "2026-01-12T09:00:00Z", "provider": "aws", "instance_type": "p5", '
                                 '"gpu_type": "H100", "region": "us-east-1", "price_per_hour": 98.3}',)], "json string")
    r = ingest.listing_from_json(df).first()
    assert r.provider == "aws" and r.is_spot is None and r.quality is None


def _percentiles(df, groups, probs):
    return df.groupBy(*groups).agg(F.percentile("v", probs).alias("p"), F.count("v").alias("n")).filter("n > 0")


def test_exact_quantiles_equal_builtin_with_a_hot_group_over_many_ranges(spark):
    """One group holds 90 % of the rows; NULL groups and values, ties and groups of one row are there too."""
    from pyspark.sql import Window
    from pricepanel.operators.quantiles import exact_quantiles, value_ranges
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, F.concat(F.lit("g"), F.col("id") % 700))
        .when(F.col("id") % 30 == 10, "one value").alias("g"),
        F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 30 == 10, 4.5)
        .otherwise(F.round(F.rand(3) * F.rand(4) * 1000, 2)).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("alone", 7.25), ("empty", None)], "g string, v double"))
    df = spark.createDataFrame(rows.collect(), rows.schema)
    former = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = value_ranges(df, ["g"], "v")
        per = ranges.groupBy("g").agg(F.count_distinct("_part").alias("n")).filter("g = 'hot'").first().n
        assert per >= 4  # the hot group is shared by many tasks
        # ranges do not overlap: a greater range of a group holds greater values
        ends = ranges.groupBy("g", "_part").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        before = F.lag("hi").over(Window.partitionBy("g").orderBy("_part"))
        assert ends.withColumn("b", before).filter("b >= lo").count() == 0
        got = exact_quantiles(df, ["g"], "v", probs, names=list("abcdef"), count_name="n").collect()
    finally:
        for k, x in former.items():
            spark.conf.set(k, x)
    want = {r.g: (r.p, r.n) for r in _percentiles(df, ["g"], probs).collect()}
    assert {r.g: ([r[c] for c in "abcdef"], r.n) for r in got} == {k: (pytest.approx(p, rel=1e-12), n) for k, (p, n) in want.items()}
    assert None in want and "empty" not in want and len(got) == len(want)
    whole = exact_quantiles(df, [], "v", [0.5, 0.75], names=["m", "q"]).first()
    assert [whole.m, whole.q] == pytest.approx(_percentiles(df, [], [0.5, 0.75]).first().p)
    assert exact_quantiles(df.filter("g = 'empty'"), ["g"], "v", [0.5]).collect() == []
    two = df.withColumn("h", F.col("v") > 300)
    got = exact_quantiles(two, ["g", "h"], "v", [0.5], names=["m"]).collect()
    assert {(r.g, r.h): r.m for r in got} == {(r.g, r.h): pytest.approx(r.p[0]) for r in _percentiles(two, ["g", "h"], [0.5]).collect()}


def test_quantile_plan_counts_once_and_ranks_within_a_range(spark):
    from pricepanel.operators.quantiles import exact_quantiles
    df = spark.range(1000).selectExpr("id % 3 as g", "cast(id % 41 as double) as v")
    plan = exact_quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_v#") and "Aggregate [g#" in plan and "cartesian" not in plan.lower()
    windows = [line for line in plan.splitlines() if "Window [sum(_c#" in line]
    assert len(windows) == 1 and "_part#" in windows[0]
    assert "Range (0, 1000" not in plan  # the counts are read from their table, not made again


def test_old_scratch_tables_are_cleared(spark):
    import os
    import time
    from pricepanel.sources.scratch import clear_scratch, scratch_root, scratch_table
    clear_scratch(spark, 0)
    old, new = scratch_table(spark.range(3).toDF("a"), "old"), scratch_table(spark.range(4).toDF("a"), "new")
    folder = scratch_root(spark).removeprefix("file:")
    name = next(n for n in os.listdir(folder) if n.startswith("old-"))
    past = time.time() - 7200
    os.utime(f"{folder}/{name}", (past, past))
    assert clear_scratch(spark, 1) == 1 and new.count() == 4
    assert [n[:4] for n in os.listdir(folder) if not n.startswith(".")] == ["new-"] and old is not None
