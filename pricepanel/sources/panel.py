"""Listing panels derived from the driver tables (see FIXTURES.md).

* ``listing_panel_raw``: one offer per lineitem, snapshots are months (F1).
* ``events_panel_raw``: one offer per event, snapshots are half-days (F2).
* ``events_gap_raw``: the same with a collection outage, providers that start
  late or vanish, and snapshots stamped some minutes after the slot (F2g); only
  the gap queries read it.
* ``region_dimension``: the (provider, raw_region) lookup built from
  nation x region, some nations deliberately unmapped.

Each is an ordinary DataFrame whose size grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Provider names assigned by supplier key modulo 8, in this order.
FIXTURE_PROVIDERS = ["aws", "gcp", "azure", "oci", "lambdalabs", "runpod", "vastai", "nebius"]

# Event type -> provider, and user id modulo 5 -> GPU name (F2).
EVENT_PROVIDERS = {"view": "aws", "click": "gcp", "purchase": "vastai", "signup": "runpod"}
EVENT_GPUS = ["H100", "A100", "L40S", "T4", "A10"]

# Keys grow with the input: a shape of instance for so many parts, a SKU for so many users.
PARTS_PER_SHAPE = 500
USERS_PER_SKU = 15

# Ordering that decides which duplicate of a key wins (last write wins).
F1_SEQUENCE = ["seq_a", "seq_b", "seq_c", "price_per_hour", "gpu_count", "gpu_memory_gb"]
F2_SEQUENCE = ["seq_a", "seq_b"]


def _case_map(col, mapping: dict, default) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def listing_panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw offers before key dedupe, plus sequence columns ``seq_a..seq_c``.

    Each dimension is joined straight to lineitem so the planner sees its own
    size: supplier and part are broadcast only while their statistics are
    under the broadcast threshold (else the join shuffles, and AQE can still
    switch it at run time); nation has 25 rows by construction and is
    broadcast explicitly.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    # only what an offer needs goes through the joins
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.date_trunc("month", F.col("l_shipdate")).cast("timestamp").alias("timestamp"),
        (F.col("l_extendedprice") / F.lit(997.0)).alias("price_per_hour"),
        (F.col("l_returnflag") == "R").alias("is_spot"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("boolean")).otherwise(F.col("l_tax") < 0.06).alias("available"))
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")

    j = (li.join(supp, li.l_suppkey == supp.s_suppkey)
           .join(F.broadcast(nation), F.col("s_nationkey") == nation.n_nationkey)
           .join(part, li.l_partkey == part.p_partkey))

    prov_idx = F.col("l_suppkey").cast("int") % 8
    provider = _case_map(prov_idx, dict(enumerate(FIXTURE_PROVIDERS[:-1])), FIXTURE_PROVIDERS[-1])
    mem_slot = F.col("p_size") % 12
    return j.select(
        "timestamp",
        provider.alias("provider"),
        F.lower(F.concat(F.col("p_type"), F.lit("-"), F.floor(F.col("l_partkey") / PARTS_PER_SHAPE).cast("string")))
        .alias("instance_type"),
        F.when(F.col("p_size") == 50, "Unknown").otherwise(F.col("p_name")).alias("gpu_type"),
        (F.col("l_linenumber").cast("int") - 1).alias("gpu_count"),
        F.when(mem_slot == 0, F.lit(None).cast("int")).otherwise(mem_slot * 8).cast("int").alias("gpu_memory_gb"),
        (F.col("p_size") * 2).cast("int").alias("vcpus"),
        F.col("p_retailprice").alias("ram_gb"),
        F.col("n_name").alias("region"),
        "price_per_hour",
        "is_spot",
        "available",
        F.lit(None).cast("string").alias("availability_zone"),
        F.col("l_orderkey").alias("seq_a"),
        F.col("l_partkey").alias("seq_b"),
        F.col("l_suppkey").alias("seq_c"),
    )


def events_panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-day snapshots from the event stream, before key dedupe (F2)."""
    return _half_days(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value"))


def events_gap_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with gaps: an outage, late and lost providers, and stamps some minutes into the slot."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    ts = F.col("ts")
    keep = (~F.dayofmonth(ts).between(12, 20)
            & ~((F.col("event_type") == "purchase") & (ts < F.lit("2024-01-04 00:00:00").cast("timestamp_ntz")))
            & ~((F.col("event_type") == "error") & (ts >= F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")))
            & ~((F.col("event_type") == "signup") & (ts >= F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))))
    out = _half_days(ev.filter(keep))
    return out.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(
        mins=(F.dayofmonth("timestamp") * 7 + F.hour("timestamp")) % 23, secs=F.lit(17)))


def _half_days(ev: DataFrame) -> DataFrame:
    ts = F.col("ts")
    half = F.when(F.hour(ts) >= 12, F.expr("INTERVAL 12 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    gpu_idx = F.col("user_id") % 5
    gpu_count = (F.lit(1) + F.col("event_id") % 4).cast("int")
    return ev.select(
        (F.date_trunc("day", ts) + half).cast("timestamp").alias("timestamp"),
        _case_map(F.col("event_type"), EVENT_PROVIDERS, "azure").alias("provider"),
        F.concat(F.lit("sku-"), F.floor(F.col("user_id") / USERS_PER_SKU).cast("string")).alias("instance_type"),
        _case_map(gpu_idx, dict(enumerate(EVENT_GPUS[:-1])), EVENT_GPUS[-1]).alias("gpu_type"),
        gpu_count.alias("gpu_count"),
        F.lit(24).cast("int").alias("gpu_memory_gb"),
        (gpu_count * 8).alias("vcpus"),
        (gpu_count * F.lit(32.0)).alias("ram_gb"),
        F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")).alias("region"),
        (F.col("value") / F.lit(97.0)).alias("price_per_hour"),
        (F.col("event_id") % 3 == 0).alias("is_spot"),
        F.lit(None).cast("boolean").alias("available"),
        F.lit(None).cast("string").alias("availability_zone"),
        F.col("ts").alias("seq_a"),
        F.col("event_id").alias("seq_b"),
    )


def region_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(provider, raw_region) lookup: nation x region x providers, minus nations with key % 7 = 3.

    Its size is 8 x |nation| rows, fixed by the schema of the input.
    """
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nr = nation.filter(F.col("n_nationkey") % 7 != 3).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    # two nations share a site; providers measure it a little differently (less than the rounding of the maps)
    odd = F.col("n_nationkey") % 2
    key = (F.col("n_nationkey") - odd).cast("double")
    per_provider = nr.select("*", F.posexplode(F.array(*[F.lit(p) for p in FIXTURE_PROVIDERS])).alias("at", "provider"))
    shift = odd * F.lit(0.001) + F.col("at") * F.lit(0.0004)
    return per_provider.select(
        "provider",
        F.col("n_name").alias("raw_region"),
        F.lower(F.concat(F.col("r_name"), F.lit("-"), F.col("n_name"),
                         F.when(F.col("n_nationkey") % 5 == 1, "-zone").otherwise(""))).alias("region_canonical"),
        F.col("n_name").alias("country"),
        (key * 1.5 + 20 + shift).alias("lat"),
        (key * -2.5 - 70 + shift).alias("lon"),
        F.col("r_name").alias("region_group"),
    )


# ---- region-resolution inputs derived from nation x region -------------------

def _nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    k = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        k.alias("k"), "n_name", "r_name",
        F.lower(F.regexp_replace("r_name", " ", "")).alias("rg"),
        F.lower(F.regexp_replace("n_name", "_", "")).alias("nn"),
        F.lower(F.concat("r_name", F.lit("-"), "n_name")).alias("canon"),
        (k.cast("double") * 1.5 + 20).alias("lat"), (k.cast("double") * -2.5 - 70).alias("lon"),
        F.concat(F.char(F.lit(65) + F.floor(k / 5)), F.char(F.lit(65) + k % 5)).alias("code"))


def region_rule_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Per-provider name tables and the country-code table, one entry per nation.

    aws names have 3 or 4 dash segments (so both parent lengths occur), oci
    names are upper case, gcp and azure lower case.
    """
    nr = _nation_regions(spark, sf_dir)
    rg, nn, k = F.col("rg"), F.col("nn"), F.col("k")
    keys = {
        "aws": F.when(k % 2 == 0, F.concat(rg, F.lit("-"), nn, F.lit("-1")))
                .otherwise(F.concat(rg, F.lit("-x-"), nn, F.lit("-1"))),
        "gcp": F.concat(rg, F.lit("-"), nn),
        "oci": F.upper(F.concat(rg, F.lit("-"), nn, F.lit("-1"))),
        "azure": F.concat(rg, nn),
    }
    per = F.array(*[F.struct(F.lit(p).alias("provider"), key.alias("key")) for p, key in keys.items()])
    provider_rules = nr.select(F.inline(per), F.col("canon").alias("region_canonical"),
                               F.col("n_name").alias("country"), "lat", "lon", F.col("r_name").alias("region_group"))
    alias = nr.filter(k % 5 == 2).select(F.concat(F.lit("Y"), F.char(F.lit(65) + F.floor(k / 5))).alias("code"),
                                         "n_name", "lat", "lon", "r_name")
    country_rules = nr.select("code", "n_name", "lat", "lon", "r_name").unionByName(alias).select(
        "code", F.col("n_name").alias("country"), "lat", "lon", F.col("r_name").alias("region_group"))
    return provider_rules, country_rules


def raw_region_variants(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """Distinct (provider, raw_region) names as collectors emit them: for each pair seen
    in the listings, a spelling chosen by (provider, nation) that exercises one rule
    of the cascade (exact, case, zone suffix, local zone, country code, unknown)."""
    nr = _nation_regions(spark, sf_dir)
    p = pairs.join(F.broadcast(nr), pairs.raw_region == nr.n_name)
    rg, nn, k, code, v = F.col("rg"), F.col("nn"), F.col("k"), F.col("code"), F.col("k") % 4
    aws_key = F.when(k % 2 == 0, F.concat(rg, F.lit("-"), nn, F.lit("-1"))).otherwise(
        F.concat(rg, F.lit("-x-"), nn, F.lit("-1")))
    gcp_key = F.concat(rg, F.lit("-"), nn)
    oci_key = F.upper(F.concat(rg, F.lit("-"), nn, F.lit("-1")))
    az_key = F.concat(rg, nn)
    prov = F.col("provider")

    def pick(*opts):
        e = F.when(v == 0, opts[0])
        for i, o in enumerate(opts[1:], start=1):
            e = e.when(v == i, o)
        return e

    raw = (F.when(prov == "aws", pick(aws_key, F.upper(aws_key), F.concat(aws_key, F.lit("-nyc-1")),
                                      F.concat(F.lit("ap-"), code, F.lit("-1"))))
            .when(prov == "gcp", pick(gcp_key, F.concat(gcp_key, F.lit("-b")), F.concat(gcp_key, F.lit("-bb")),
                                      F.upper(gcp_key)))
            .when(prov == "oci", pick(F.lower(oci_key), oci_key, F.concat(F.lit("xx-"), F.lower(code)),
                                      F.lit("nowhere")))
            .when(prov == "azure", pick(az_key, F.concat(az_key, F.lit("-zz")), F.lit(""),
                                        F.concat(F.lit("eur-"), code, F.lit("-2"))))
            .otherwise(pick(F.concat(F.lit("eu-"), code, F.lit("-1")), F.concat(F.lower(code), F.lit("-"), nn),
                            F.concat(F.lit("nowhere-"), k.cast("string")), F.col("n_name"))))
    return p.select("provider", raw.alias("raw_region")).distinct()


def existing_dimension(resolved: DataFrame) -> DataFrame:
    """A previously written dimension: some rows hand-edited (blank or renamed) and some
    rows for pairs that are no longer collected."""
    h = (F.length("provider") + F.length("raw_region")) % 5
    edited = resolved.filter(h <= 1).select(
        "provider", "raw_region",
        F.when(h == 0, F.lit(None)).otherwise(F.concat(F.lit("hand-"), F.col("raw_region"))).alias("region_canonical"),
        F.when(h == 0, F.lit(None)).otherwise(F.col("country")).alias("country"),
        F.when(h == 0, F.lit(None)).otherwise(F.col("lat")).alias("lat"),
        F.when(h == 0, F.lit(None)).otherwise(F.col("lon")).alias("lon"),
        F.when(h == 0, F.lit(None)).otherwise(F.col("region_group")).alias("region_group"))
    gone = resolved.filter(h == 2).select("provider", F.concat(F.lit("gone-"), F.col("raw_region")).alias("raw_region"),
                                          "region_canonical", "country", "lat", "lon", "region_group")
    return edited.unionByName(gone)


# ---- raw catalogue items and host payloads derived from listings ------------

def raw_catalogue_items(prices: DataFrame) -> DataFrame:
    """Listings re-expressed as loosely typed collector items, with the defects the
    normaliser must handle: aliased/mixed-case providers, missing names, fractional
    or zero memory, missing or zero GPU counts, unparseable prices, no provider."""
    g, sp, v = F.col("gpu_count"), F.col("is_spot"), F.col("vcpus")
    provider = (F.when((F.col("provider") == "aws") & sp, F.lit("AWS"))
                 .when((F.col("provider") == "lambdalabs") & (g == 1), F.lit("Lambda"))
                 .when((F.col("provider") == "azure") & (g == 7), F.lit(None).cast("string"))
                 .otherwise(F.col("provider")))
    return prices.select(
        "timestamp",
        provider.alias("provider"),
        F.when(v % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("gpu_type")).alias("gpu_name"),
        F.when(v % 20 == 0, F.lit(None).cast("string")).otherwise(F.col("gpu_type")).alias("name"),
        F.when(v % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("instance_type")).alias("instance_name"),
        F.when(g == 6, F.lit(None).cast("double")).when((g == 4) & sp, F.lit(1e18)).otherwise(g.cast("double"))
         .alias("gpu_count"),
        F.when(F.col("gpu_memory_gb").isNull(), F.lit(0.0)).otherwise(F.col("gpu_memory_gb") + 0.9).alias("gpu_memory"),
        F.when((g == 3) & sp, F.lit(1e12)).otherwise(v.cast("double")).alias("cpu"),
        F.col("ram_gb").alias("memory"),
        F.when(v % 26 == 0, F.lit(None).cast("string")).otherwise(F.col("region")).alias("location"),
        F.when((g == 5) & sp, F.lit("n/a")).otherwise(F.col("price_per_hour").cast("string")).alias("price"),
        sp.alias("spot"))


def host_payloads(prices: DataFrame) -> DataFrame:
    """One JSON payload per listing in the host-catalogue shape; some payloads lack the
    ``hostnodes`` key and some are not JSON at all."""
    host = F.concat_ws("/", "provider", "instance_type", "region", F.col("is_spot").cast("string"),
                       F.date_format("timestamp", "yyyyMMdd"))
    res = lambda amount, price: F.struct(amount.cast("double").alias("amount"), F.lit(price).alias("price"))
    spec = F.struct(
        F.struct(F.col("region").alias("country")).alias("location"),
        F.struct(res(F.col("vcpus"), 0.003).alias("cpu"), res(F.col("ram_gb"), 0.002).alias("ram"),
                 res(F.lit(100.0), 0.00005).alias("storage"),
                 F.create_map(F.col("gpu_type"), F.struct(F.col("gpu_count").alias("amount"),
                                                          F.col("price_per_hour").alias("price"),
                                                          F.col("gpu_memory_gb").cast("double").alias("vram")))
                 .alias("gpu")).alias("specs"))
    good = F.to_json(F.struct(F.create_map(host, spec).alias("hostnodes")))
    missing = F.to_json(F.struct(F.create_map(host, spec).alias("oops")))
    g, sp = F.col("gpu_count"), F.col("is_spot")
    payload = (F.when(sp & (g == 2), missing)
                .when(sp & (g == 3), F.concat(F.lit("{bad "), host))
                .otherwise(good))
    return prices.select(F.col("provider").alias("source"), payload.alias("payload"))


def old_vintage_rows(prices: DataFrame, before: str = "1998-01-01") -> DataFrame:
    """Rows of the snapshots before ``before`` as the first published vintage stored them:
    the 13 base columns only, and the GPU count unknown where it was 6."""
    from ..schema import BASE_COLUMNS
    old = prices.filter(F.col("dt") < F.lit(before).cast("date"))
    cols = [F.when(F.col("gpu_count") == 6, F.lit(None).cast("int")).otherwise(F.col("gpu_count")).alias("gpu_count")
            if c == "gpu_count" else F.col(c) for c in BASE_COLUMNS]
    return old.select(*cols, "dt")
