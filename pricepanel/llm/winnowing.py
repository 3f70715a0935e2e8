"""Document fingerprints by winnowing, in DataFrame functions only.

Units of a text are its words; a word longer than ``LONG_WORD`` code points (text
written without spaces) counts code point by code point. Every ``K`` consecutive
units are hashed, in every window of ``W`` such hashes the least is chosen, of
equal ones the rightmost, and each chosen hash is kept with its position. So two
texts that share ``K + W - 1`` consecutive units share a fingerprint entry; a
shorter text is one gram, and fewer grams than a window are one window.

A code packs hash and position into one long, so that the least code of a window
is the least hash at the rightmost place: 40 bits of hash above 23 bits that fall
with the position (longer texts are hashed all the same; positions count modulo
2**23).

``neighbours`` finds the next row by ascending id: rows are written once in ranges
whose bounds come from the data, and a range is cut into blocks of ``BLOCK_ROWS``
rows, whatever the ids are. The first row of a block is also dealt to the block
before, behind its last row, so the next row of every row comes from a window over
one block and no text is joined.

Defined results: null text is empty and has no entries (fingerprint ""); a
likeness with an empty fingerprint is 0, of two empty ones 1; equal texts have
equal fingerprints; rows of equal id are ordered by the first ``ORDER_CHARS`` code
points of the text, then by a hash of it; null ids come first;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from .common import documents, in_ranges, scratch

K = 4
W = 4
LONG_WORD = 40
BLOCK_ROWS = 64
ORDER_CHARS = 64
_BLOCK_BITS = 27  # blocks of a range
_PLACES = 1 << 23
_HASHES = 1 << 40


def units(text: Column) -> Column:
    """Words; words of more than LONG_WORD code points as single code points."""
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    cut = F.flatten(F.transform(words, lambda w: F.when(
        F.length(w) > LONG_WORD, F.filter(F.split(w, ""), lambda c: c != "")).otherwise(F.array(w))))
    return F.when(text.rlike(r"[^ \t\n\x0B\f\r]{%d}" % (LONG_WORD + 1)), cut).otherwise(words)


def entries(text: Column) -> Column:
    """The chosen codes of a text, in order of position."""
    u = units(text)

    def grams(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (K - 1), F.lit(1))),
                           lambda i: F.pmod(F.xxhash64(F.slice(words, i, K)), F.lit(_HASHES)) * _PLACES
                           + F.pmod(-i, F.lit(_PLACES)))

    def least(codes: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(codes) - (W - 1), F.lit(1))),
                                            lambda i: F.array_min(F.slice(codes, i, W))))

    # one element each: names the intermediate array, so that it is computed once
    per_text = F.transform(F.array(u), lambda words: F.when(F.size(words) == 0, F.array().cast("array<bigint>"))
                           .otherwise(F.flatten(F.transform(F.array(grams(words)), least))))
    return F.element_at(per_text, 1)


def hashes(codes: Column) -> Column:
    return F.array_distinct(F.transform(codes, lambda c: F.shiftright(c, 23)))


def shown(codes: Column) -> Column:
    """``hash:position`` of every entry, in hexadecimal; positions count units from 0."""
    return F.array_join(F.transform(codes, lambda c: F.concat_ws(
        ":", F.hex(F.shiftright(c, 23)), F.hex(F.pmod(-1 - c, F.lit(_PLACES))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def neighbours(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, text and ``next_text`` by ascending doc_id (after the last row: the first), with ``block`` and ``place``.

    Rows marked ``guest`` stand for the first row of the next block."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"_head": F.substring("text", 1, ORDER_CHARS), "_hash": F.xxhash64("text")})
    rows = in_ranges(rows, ["doc_id", "_head", "_hash"], folder, "ranges").drop("_head", "_hash")
    block = lambda part, place: F.shiftleft(part, _BLOCK_BITS) + F.floor(place / BLOCK_ROWS)
    rows = rows.withColumn("block", block(F.col("part"), F.col("place")))

    in_order = Window.orderBy("part")  # one row a range
    last = rows.groupBy("part").agg(F.max("place").alias("place")).select(
        "part", block(F.col("part"), F.col("place")).alias("last"))
    before = last.select("part", F.coalesce(F.lag("last").over(in_order), F.last("last").over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    heads = (rows.where(F.col("place") % BLOCK_ROWS == 0).join(before, "part")
             .withColumn("block", F.when(F.col("place") == 0, F.col("before")).otherwise(F.col("block") - 1)).drop("before"))
    return (rows.withColumn("guest", F.lit(False)).unionByName(heads.withColumn("guest", F.lit(True)))
            .withColumn("next_text", F.lead("text").over(_in_block())))


def _in_block() -> WindowSpec:
    return Window.partitionBy("block").orderBy("guest", "place")


def fingerprints(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = neighbours(docs, folder or scratch(docs.sparkSession, "winnowing"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", "block", "place", "guest", F.length("text").cast("long").alias("n_chars"),
                       F.sha2(edited, 256).alias("edited_sha256"), entries(F.col("text")).alias("own"),
                       F.when(~F.col("guest"), entries(edited)).alias("changed"))
    rows = rows.withColumn("next_own", F.lead("own").over(_in_block())).where(~F.col("guest"))
    h = {c: hashes(F.col(c)) for c in ("own", "changed", "next_own")}
    rows = rows.select("doc_id", "n_chars", "edited_sha256", shown(F.col("own")).alias("fingerprint"),
                       shown(F.col("changed")).alias("edited_fingerprint"),
                       *[x.alias(f"h_{c}") for c, x in h.items()])
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("h_own"), F.col("h_changed")).alias("near_edited"),
                       likeness(F.col("h_own"), F.col("h_next_own")).alias("near_next"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every whole text of ``documents`` and its edited text."""
    return fingerprints(documents(spark, sf_dir))
