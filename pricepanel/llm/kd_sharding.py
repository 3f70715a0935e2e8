"""Sharding by a k-d tree over metadata, in DataFrame functions only.

A node that stands for k shards is cut along its widest metadata dimension at
the weighted median (for odd k: at the share of the left k/2 shards), weights
being bytes, until every leaf is one shard; so shards hold nearly equal bytes
(law ``bytes``). Dimensions are scaled to [0, 1] over the table: log size, id,
and the hashes of language and source.

A cut is found over all rows by radix refinement: a row's place along a
dimension is a 62-bit key (20 bits of the value, then 42 bits of text checksum
and id, so that rows of equal value are cut too). Per pass one aggregation sums
the bytes of 2**16 key ranges a node, and only the range with the median is
refined. What reaches the driver is one row a node, at most the number of shards,
and goes back as a table of that many rows; a row's node is written after each
level.

Equal texts have one place in every dimension, that of their least id, language
and source, so a cut leaves them together. The law sets the limit: a group that
stays whole can put a cut off by half its bytes, which the shards of one side
share; where that is over 1/(2 * WHOLE) of a shard for each of them, the cut goes
through the group. So the fewer shards a node has, the smaller the groups that it
must keep whole: 1/WHOLE of a shard at the last cuts, k/(2 * WHOLE) at a node of k.

Slots are numbered by id within a shard without gathering it: rows are written in
ranges of shard and id whose bounds come from the data, and a row's slot is its
place in the range beside the running counts of the ranges before.

Defined results: null text has no bytes (size 1, checksum 0); a null language or
source is a value of its own; null ids come first; rows equal in id and text stay
together; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, in_ranges, kept_table, scratch

SHARDS = 16
DIMS = ("size", "id", "lang", "source")
_VALUE_BITS, _TIE_BITS = 20, 42
WHOLE = 32
SALTS = 32  # parts of a group of equal texts in the join with its place
_PASSES = (46, 30, 15, 0)  # right shifts; each pass refines 16 bits or less


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the raw dimensions (0 to 1 for hashes) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = lambda c: F.coalesce((F.crc32(F.col(c).cast("string")) + 1) / F.lit(float(1 << 32)), F.lit(0.0))
    return docs.select(F.col("doc_id"), F.xxhash64(text, F.md5(text.cast("binary"))).alias("copies"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       hashed("lang").alias("lang"), hashed("source").alias("source"))


def grouped(meta: DataFrame, folder: str) -> DataFrame:
    """``meta`` with the least id (``place_id``), lang and source of equal texts, and the bytes of the group.

    Groups are summed map-side and merged with their rows in SALTS parts, so that a group may hold any share of the
    rows; the table of groups grows with the rows and is never broadcast."""
    groups = meta.groupBy("copies", "size").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("g_id"), F.min("lang").alias("g_lang"),
        F.min("source").alias("g_source")).where("n > 1")
    parts = kept_table(groups, folder, "groups").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = meta.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
        parts.hint("merge"), ["copies", "size", "salt"], "left")
    copy = F.col("n").isNotNull()
    return rows.select("doc_id", "size", "text_crc32", F.when(copy, F.col("g_id")).otherwise(F.col("doc_id")).alias("place_id"),
                       (F.coalesce("n", F.lit(1)) * F.col("size")).alias("group_bytes"),
                       *[F.coalesce(f"g_{d}", d).alias(d) for d in ("lang", "source")])


def keyed(meta: DataFrame) -> tuple[DataFrame, dict]:
    """The value code of every dimension, and the tie-breaks of a row with its group and of the row alone."""
    span = meta.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("size").alias("top"),
                    F.count("*").alias("n"), F.sum("size").alias("bytes")).first().asDict()
    low, high = span["lo"] or 0, span["hi"] or 0
    scaled = {"size": F.log2(F.col("size").cast("double")) / max(1e-9, float(_log2(span["top"] or 1))),
              "id": F.coalesce((F.col("place_id") - F.lit(low)) / F.lit(float(max(1, high - low))), F.lit(0.0)),
              "lang": F.col("lang"), "source": F.col("source")}

    def tie(of: str) -> Column:
        return (F.shiftleft(F.shiftright(F.col("text_crc32"), 8), 18)
                + F.pmod(F.xxhash64(of, "text_crc32"), F.lit(1 << 18)))

    code = lambda c: F.least(F.greatest(F.floor(c * ((1 << _VALUE_BITS) - 1)), F.lit(0)),
                             F.lit((1 << _VALUE_BITS) - 1)).cast("long")
    return meta.select("doc_id", "size", "text_crc32", "group_bytes", tie("place_id").alias("tie"), tie("doc_id").alias("own_tie"),
                       *[code(scaled[d]).alias(f"v_{d}") for d in DIMS]), span


def _log2(x: int) -> float:
    import math
    return math.log2(max(2, x))


def _table(rows: DataFrame, columns: list[str], values: list[tuple]) -> DataFrame:
    """A table of whole numbers, one row a node: at most the number of shards, so it may be broadcast."""
    rows_ = [F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(columns, v)]) for v in values]
    return F.broadcast(rows.sparkSession.range(1).select(F.inline(F.array(*rows_))))


def split(table: DataFrame, goals: dict[int, tuple[int, int]], share: float) -> DataFrame | None:
    """``table`` (rows with their ``node``) with the child of each node in ``goals`` (node -> (left, all) shards)."""
    box = table.groupBy("node").agg(F.sum("size").alias("bytes"), *[
        (F.max(f"v_{d}") - F.min(f"v_{d}")).alias(d) for d in DIMS]).collect()  # a row a node
    box = [r for r in box if r["node"] in goals]
    if not box:
        return None
    dims = {r["node"]: max(range(len(DIMS)), key=lambda i, r=r: r[DIMS[i]]) for r in box}
    want = {r["node"]: r["bytes"] * goals[r["node"]][0] // goals[r["node"]][1] for r in box}
    whole = {n: int(share * goals[n][1] / (2 * WHOLE)) for n in dims}  # bytes of the largest group kept whole
    cut = _table(table, ["node", "dim", "whole"], [(n, d, whole[n]) for n, d in dims.items()])
    value = F.element_at(F.array(*[F.col(f"v_{d}") for d in DIMS]), (F.col("dim") + 1).cast("int"))
    key = F.shiftleft(value, _TIE_BITS) + F.when(F.col("group_bytes") <= F.col("whole"), F.col("tie")).otherwise(F.col("own_tie"))
    keyed_rows = table.join(cut, "node").select("node", "size", key.alias("key"))
    prefix, above = dict.fromkeys(dims, 0), 62
    cuts = {}
    for shift in _PASSES:
        at = _table(table, ["node", "prefix", "want"], [(n, prefix[n], want[n]) for n in dims])
        inside = keyed_rows.join(at, "node").where(F.shiftright("key", above) == F.col("prefix"))
        sums = inside.groupBy("node", "want", F.shiftright("key", shift).alias("range")).agg(F.sum("size").alias("w"))
        run = sums.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("range")))
        found = (run.where(F.col("upto") >= F.col("want"))
                 .groupBy("node").agg(F.min(F.struct("range", "w", "upto")).alias("r")).select("node", "r.*").collect())
        for r in found:
            prefix[r["node"]] = r["range"]
            if shift:
                want[r["node"]] -= r["upto"] - r["w"]
            else:  # the median row goes to the side that ends nearer to the goal
                over, under = r["upto"] - want[r["node"]], want[r["node"]] - (r["upto"] - r["w"])
                cuts[r["node"]] = r["range"] if over <= under else r["range"] - 1
        above = shift
    last = _table(table, ["node", "dim", "whole", "cut"], [(n, dims[n], whole[n], cuts.get(n, -1)) for n in dims])
    child = F.col("node") * 2 + F.when(key <= F.col("cut"), 0).otherwise(1)
    return table.join(last, "node", "left").withColumn("node", F.when(F.col("cut").isNull(), F.col("node")).otherwise(child)).select(
        *table.columns)


def assign(table: DataFrame, shards: int, share: float, folder: str) -> DataFrame:
    """``keyed`` rows with their ``shard``; the node of a row is written after each level."""
    table = table.withColumn("node", F.lit(1).cast("long"))
    leaves, final, first = {1: shards}, {}, {1: 0}  # shards below a node; children of n are 2n and 2n + 1
    level = 0
    while any(k > 1 for k in leaves.values()):
        goals = {n: (k // 2, k) for n, k in leaves.items() if k > 1}
        below = split(table, goals, share)
        if below is not None:
            table = kept_table(below, folder, f"level{level}")
        final |= {n: first[n] for n, k in leaves.items() if k == 1}
        children = {}
        for n, (left, k) in goals.items():
            children |= {2 * n: left, 2 * n + 1: k - left}
            first |= {2 * n: first[n], 2 * n + 1: first[n] + left}
        leaves, level = children, level + 1
    final |= {n: first[n] for n in leaves}
    return table.join(_table(table, ["node", "shard"], list(final.items())), "node").withColumn("shard", F.col("shard").cast("int"))


def with_slots(rows: DataFrame, folder: str) -> DataFrame:
    """Number the rows of each shard from 0 by id, then checksum."""
    rows = in_ranges(rows, ["shard", "doc_id", "text_crc32", "size"], folder, "ranges")
    counts = rows.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = counts.select("part", "shard", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("part")) - F.col("n") - F.col("first")).alias("before"))
    return rows.join(before, ["part", "shard"]).withColumn("slot", F.col("before") + F.col("place"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    folder = folder or scratch(docs.sparkSession, "kd")
    meta = kept_table(metadata(docs), folder, "metadata")
    keys, span = keyed(kept_table(grouped(meta, folder), folder, "grouped"))
    keys = kept_table(keys, folder, "keys")
    placed = assign(keys, shards, (span["bytes"] or 0) / shards, folder).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(placed, folder).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Put all documents into 16 shards of nearly equal bytes."""
    return shard_documents(documents(spark, sf_dir))
