"""Nested host catalogue (S5, S6): JSON payloads of hosts -> specs -> GPUs.

A payload is parsed once, to a VARIANT; every field is a path into it. So a
payload of another shape is not an error of the job: it goes to a quarantine
with the path that failed and the fields that nobody asked for, as it came, and
can be replayed once the source or the paths are mended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOSTS = "$.hostnodes"
# What an offer needs of a host, beside its GPUs.
HOST_PATHS = ["$.specs.cpu.amount", "$.specs.cpu.price", "$.specs.ram.amount", "$.specs.ram.price",
              "$.specs.storage.amount", "$.specs.storage.price"]
KNOWN = ["hostnodes"]
_OBJECT = "map<string,variant>"


def _number(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "double")


def parsed_payloads(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """The payloads with their hosts, ``status``, failing ``path`` and ``unknown`` top-level fields.

    ``status`` is ok, malformed (no JSON), missing_key (no ``hostnodes``), bad_type (it is no object) or bad_field
    (a field of a host, or its ``gpu`` object, is absent or of another type)."""
    # as a generator's output the parsed payload is not computed again in filters that are moved down
    p = payloads.select("*", F.explode(F.array(F.try_parse_json(F.col(col)))).alias("_v"))
    p = p.withColumns({"_top": F.try_variant_get("_v", "$", _OBJECT), "hostnodes": F.try_variant_get("_v", HOSTS, _OBJECT)})
    # of every host the first path that does not hold, as hostnodes['host'].specs...
    def failing(host: Column, d: Column) -> Column:
        at = [F.when(_number(d, x).isNull(), F.lit(x[1:])) for x in HOST_PATHS]
        at.append(F.when(F.try_variant_get(d, "$.specs.gpu", _OBJECT).isNull(), F.lit(".specs.gpu")))
        return F.concat(F.lit(f"{HOSTS}['"), host, F.lit("']"), F.coalesce(*at))

    bad = F.array_min(F.filter(F.transform(F.map_entries("hostnodes"), lambda e: failing(e["key"], e["value"])),
                               lambda x: x.isNotNull()))
    there = F.try_variant_get("_v", HOSTS, "variant")
    status = (F.when(F.col("_v").isNull(), "malformed").when(there.isNull(), "missing_key")
              .when(F.col("hostnodes").isNull(), "bad_type").when(bad.isNotNull(), "bad_field").otherwise("ok"))
    path = (F.when(F.col("_v").isNull(), "$").when(F.col("hostnodes").isNull(), HOSTS).otherwise(bad))
    unknown = F.array_sort(F.filter(F.map_keys("_top"), lambda k: ~k.isin(*KNOWN)))
    return p.select(*payloads.columns, "hostnodes", status.alias("status"), path.alias("path"), unknown.alias("unknown"))


def classify_payloads(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """The payloads with their status; hosts are kept as variants."""
    return parsed_payloads(payloads, col).drop("path", "unknown")


def quarantine(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """The payloads that are not ok, as they came, with status, failing path and unknown fields."""
    return parsed_payloads(payloads, col).filter("status <> 'ok'").drop("hostnodes")


def quarantine_report(payloads: DataFrame, source_col: str = "source", col: str = "payload") -> DataFrame:
    """Payloads per source and status; a bad payload never stops the others."""
    return classify_payloads(payloads, col).groupBy(F.col(source_col).alias("source"), "status").agg(
        F.count(F.lit(1)).alias("payloads"))


def replay(quarantined: DataFrame, repaired: Column, col: str = "payload") -> DataFrame:
    """The offers of quarantined payloads once ``repaired`` (an expression over them) has mended them."""
    return flatten_host_offers(quarantined.withColumn(col, repaired), col)


def flatten_host_offers(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """One offer per (host, GPU kind) with a non-zero amount.

    price = cpu + ram + storage (price x amount each) + gpu amount x price,
    rounded to 5 places; cpu and ram rounded down to a multiple of 2; the
    country lower-cased with spaces removed. A field that is absent is NULL and
    makes what is computed from it NULL; payloads without hosts yield no row.
    """
    # the generator parses a payload once and hands its hosts on as variants
    hosts = payloads.select(F.explode(F.try_variant_get(F.try_parse_json(F.col(col)), HOSTS, _OBJECT)).alias("host", "d"))
    fields = {x: _number(F.col("d"), x) for x in HOST_PATHS}
    gpus = hosts.select("host", F.try_variant_get("d", "$.location.country", "string").alias("country"),
                        *[c.alias(x.removeprefix("$.specs.").replace(".", "_")) for x, c in fields.items()],
                        F.explode(F.try_variant_get("d", "$.specs.gpu", _OBJECT)).alias("gpu_name", "g"))
    gpus = gpus.withColumn("gpu_count", F.try_variant_get("g", "$.amount", "int")).filter("gpu_count <> 0")
    base = (F.col("cpu_price") * F.col("cpu_amount") + F.col("ram_price") * F.col("ram_amount")
            + F.col("storage_price") * F.col("storage_amount"))
    return gpus.select(
        F.col("host").alias("instance_name"),
        F.replace(F.lower("country"), F.lit(" "), F.lit("")).alias("location"),
        F.round(base + F.col("gpu_count") * _number(F.col("g"), "$.price"), 5).alias("price"),
        (F.floor(F.col("cpu_amount") / 2) * 2).cast("double").alias("cpu"),
        (F.floor(F.col("ram_amount") / 2) * 2).cast("double").alias("memory"),
        "gpu_count", "gpu_name", _number(F.col("g"), "$.vram").alias("gpu_memory"), F.lit(False).alias("spot"),
        F.col("storage_amount").alias("disk_size"))
