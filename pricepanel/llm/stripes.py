"""Phrase collocation mining with the stripes pattern.

A stripe is the counter of the words that follow one prefix. A task builds the
stripes of its texts, packed into blocks for each key range; Spark shuffles the
blocks, and the task of a range merges equal stripes element by element. Level k
has prefixes of k - 1 words. One structure gives it all: an entry of a stripe is
f(prefix + word), the extensions of a prefix; the entries of level k are the
totals of the prefixes of level k + 1; and the greatest entry that holds a
phrase, as prefix or as rest, is its subsumption maximum (a longer phrase is
never more frequent than the parts of it that are one word longer than the
phrase, so longer ones need not be looked at).

A phrase can be a candidate only if its two parts of one word less are
frequent, so level k counts only pairs of frequent (k - 1)-grams. Tasks know
them from a bit map of their hashes, 1/16 full and never over ``FILTER_BITS``
bits: a wrong hit adds an entry that the exact count then drops, so the results
do not depend on its size. A stripe is cut into ``SEGMENTS`` by the next word:
the tasks of several ranges share a hot prefix.

Words and phrases are 64-bit hashes while they are counted (10**7 distinct
phrases: a chance of 3 in a million that any two are equal); words are taken back
from the counted words of each language. Languages are counted apart. Scores
are decimals of 38 digits, so products may pass 64 bits.

Defined results: null text is empty; null lang is ``und``; an empty table or a
language without candidates gives no rows; ties are ranked by the UTF-8 bytes of
the phrase; repeated rows count as often as they are there; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _BASE, Words, arrow_batches, byte_texts, documents, kept_table, mixed, release, scratch

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
FILTER_BITS = 1 << 27
SEGMENTS = 64
PART_TOKENS = 2_000_000
RUN_BYTES = 4 << 20
_HELD = 1_000_000
_MAP_BITS = 1 << 15
# A-Z lower-cased; what ends a piece becomes a line feed
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


class _Run:
    """Words of some texts with their pieces; ``key(k)`` are the hashes of all k words in a row, language included."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.words = w = Words([t.translate(_FOLD) for t in texts])
        names, self.lang = np.unique(np.array(langs, dtype=object), return_inverse=True)
        self.names = names.tolist()
        seed = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.names],
                        dtype=np.uint64)
        self.keys = [mixed(seed[self.lang[w.doc]] * _BASE + w.hash)]
        ends = np.searchsorted(np.flatnonzero(w.buffer == 10), w.start)  # ends of pieces before each word
        new = (w.doc[1:] != w.doc[:-1]) | (ends[1:] != ends[:-1])
        self.piece = np.concatenate([[0], np.cumsum(new)])[:len(w.hash)]

    def key(self, k: int) -> np.ndarray:
        while len(self.keys) < k:
            last = self.keys[-1]
            self.keys.append(extended(last[:-1], self.keys[0][len(self.keys):]) if len(last) else last)
        return self.keys[k - 1]


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a prefix and one more word."""
    return mixed(prefix * _BASE + word)


def _runs(batches):
    """The texts of a task, about RUN_BYTES at a time."""
    langs, texts, size = [], [], 0
    for b in batches:
        for lang, t in zip(b.column(0).to_pylist(), byte_texts(b.column(1))):
            if texts and size + len(t) > RUN_BYTES:
                yield _Run(langs, texts)
                langs, texts, size = [], [], 0
            langs.append(lang)
            texts.append(t)
            size += len(t)
    if texts:
        yield _Run(langs, texts)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text"))


# --- the first level: words, kept as strings ----------------------------------------------------


def _word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, key, f of every word, and one row a language without phrase: all its words."""

    def run(batches):
        import pyarrow as pa
        for r in _runs(batches):
            w = r.words
            if not len(w.hash):
                continue
            kinds, first, count = np.unique(r.keys[0], return_index=True, return_counts=True)
            total = np.bincount(r.lang[w.doc], minlength=len(r.names))
            words = pa.array([w.bytes_of(i) for i in first.tolist()], pa.binary()).cast(pa.string())
            none = pa.nulls(len(r.names))
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([r.names[i] for i in r.lang[w.doc[first]].tolist()] + r.names, pa.string()),
                "phrase": pa.concat_arrays([words, none.cast(pa.string())]),
                "key": pa.concat_arrays([pa.array(kinds.view(np.int64)), none.cast(pa.int64())]),
                "f": pa.array(np.concatenate([count, total]), pa.int64())})
        release()

    return (_texts(docs).mapInArrow(run, "lang string, phrase string, key long, f long")
            .groupBy("lang", "phrase", "key").agg(F.sum("f").alias("f")))


# --- the bit map of frequent phrases -------------------------------------------------------------


class _Filter:
    """Whether a hash may be that of a frequent phrase."""

    def __init__(self, bits: int, maps: dict[int, bytes]):
        self.mask = np.uint64(bits - 1)
        self.bytes = np.zeros(bits // 8, dtype=np.uint8)
        for bucket, data in maps.items():
            at = bucket * (_MAP_BITS // 8)
            self.bytes[at:at + len(data)] = np.frombuffer(data, dtype=np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filter(level: DataFrame, size: int, most: int) -> _Filter:
    """At most ``most`` bits reach the driver, whatever the size of the level."""
    bits = min(most, max(_MAP_BITS, 1 << math.ceil(math.log2(16 * size))))
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    maps = level.select(F.shiftright(at, 15).alias("bucket"), at.bitwiseAND(F.lit(_MAP_BITS - 1)).alias("bit")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
    return _Filter(bits, {r.bucket: bytes(r.map) for r in maps})


# --- stripes of longer prefixes --------------------------------------------------------------------


def _packed(arrays: list[np.ndarray]) -> bytes:
    """64-bit numbers byte by byte (high bytes of gaps and counts are zeros)."""
    import pyarrow as pa
    planes = [np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(block: bytes, sizes: list[int]) -> list[np.ndarray]:
    import pyarrow as pa
    data = np.frombuffer(pa.decompress(block, decompressed_size=8 * sum(sizes), codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(data[at:at + 8 * n].reshape(8, n).T).reshape(-1).view(np.uint64))
        at += 8 * n
    return out


class _Stripes:
    """Stripes as three columns (prefix, next word, count); equal entries are added up."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.whole = 0  # entries, and entries after the last merge

    def add(self, prefix: np.ndarray, word: np.ndarray, count: np.ndarray) -> None:
        self.parts.append((prefix, word, count))
        self.held += len(prefix)

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Element by element; kept in this form."""
        if len(self.parts) != 1:
            columns = [np.concatenate(x) for x in zip(*self.parts)] if self.parts else [np.empty(0, np.uint64)] * 3
            self.parts = [_added(*columns)]
            self.held = self.whole = len(self.parts[0][0])
        return self.parts[0]


def _added(prefix: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = extended(prefix, word)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    own = order[first]
    return prefix[own], word[own], np.add.reduceat(count[order], first) if len(first) else count


def _part(prefix: np.ndarray, word: np.ndarray, parts: int) -> np.ndarray:
    segment = word & np.uint64(SEGMENTS - 1)
    return (mixed(prefix * _BASE + segment) % np.uint64(parts)).astype(np.int64)


def _blocks(stripes: _Stripes, parts: int):
    """One row for each range: its stripes, prefix by prefix."""
    import pyarrow as pa
    prefix, word, count = stripes.merged()
    stripes.parts, stripes.held = [], 0
    if not len(prefix):
        return
    part = _part(prefix, word, parts)
    order = np.lexsort((word, prefix, part))
    prefix, word, count, part = prefix[order], word[order], count[order], part[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    rows = []
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        kinds, size = np.unique(prefix[lo:hi], return_counts=True)
        rows.append((len(kinds), hi - lo, _packed([np.diff(kinds, prepend=np.uint64(0)), size, word[lo:hi], count[lo:hi]])))
    stripe, entries, block = zip(*rows)
    yield pa.RecordBatch.from_pydict({
        "part": pa.array(part[cut[:-1]], pa.int64()), "stripes": pa.array(stripe, pa.int64()),
        "entries": pa.array(entries, pa.int64()), "block": pa.array(block, pa.binary())})


def _count_level(docs: DataFrame, k: int, frequent, parts: int) -> DataFrame:
    """Blocks of the stripes of prefixes of k - 1 words, over all texts."""

    def run(batches):
        seen, stripes = frequent.value, _Stripes()
        for r in _runs(batches):
            if len(r.words.hash) < k:
                continue
            part = r.key(k - 1)
            may = seen(part)
            at = np.flatnonzero((r.piece[:len(part) - 1] == r.piece[k - 1:]) & may[:-1] & may[1:])
            _, first, count = np.unique(r.key(k)[at], return_index=True, return_counts=True)
            first = at[first]
            stripes.add(part[first], r.keys[0][first + k - 1], count)
            if stripes.held > _HELD:
                stripes.merged()
                if stripes.held > _HELD // 2:
                    yield from _blocks(stripes, parts)
        yield from _blocks(stripes, parts)
        release()

    return _texts(docs).mapInArrow(run, "part long, stripes long, entries long, block binary")


def _merge_level(blocks: DataFrame, parts: int, least: int) -> DataFrame:
    """prefix, next, key, f of the entries that occur ``least`` times."""

    def run(batches):
        import pyarrow as pa

        def frequent(stripes):
            prefix, word, count = stripes.merged()
            keep = count >= least
            prefix, word = prefix[keep], word[keep]
            return pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (prefix, word, extended(prefix, word))]
                + [pa.array(count[keep].astype(np.int64))], ["prefix", "next", "key", "f"])

        current, stripes = None, _Stripes()
        for b in batches:
            for part, kinds, entries, block in zip(*(c.to_pylist() for c in b.columns)):
                if part != current and current is not None:
                    yield frequent(stripes)
                    stripes = _Stripes()
                current = part
                gap, size, word, count = _unpacked(block, [kinds, kinds, entries, entries])
                stripes.add(np.repeat(np.cumsum(gap, dtype=np.uint64), size.astype(np.int64)), word, count.astype(np.int64))
                if stripes.held > _HELD + 2 * stripes.whole:  # as often as the merged stripes double
                    stripes.merged()
        if current is not None:
            yield frequent(stripes)
        release()

    return (blocks.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(run, "prefix long, next long, key long, f long"))


def frequent_phrases(docs: DataFrame, folder: str, least: int = MIN_COUNT, longest: int = LONGEST,
                     filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases up to ``longest`` words that occur ``least`` times in a language, and
    (lang, n) of its word occurrences."""
    spark = docs.sparkSession
    counted = kept_table(_word_counts(docs).where(F.col("phrase").isNull() | (F.col("f") >= least)), folder, "level1")
    totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    words = counted.where(F.col("phrase").isNotNull())
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(tokens / PART_TOKENS))
    level, out = words, words.withColumn("words", F.lit(1))
    for k in range(2, longest + 1):
        size = level.count()
        if not size:
            break
        seen = spark.sparkContext.broadcast(_filter(level, size, filter_bits))
        found = kept_table(_merge_level(_count_level(docs, k, seen, parts), parts, least), folder, f"stripes{k}")
        seen.unpersist()
        named = found.join(level.select(F.col("key").alias("prefix"), "lang", "phrase"), "prefix").join(
            words.select(F.col("key").alias("next"), F.col("phrase").alias("word")), "next")
        level = kept_table(named.select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "key", "f"),
                           folder, f"level{k}")
        out = out.unionByName(level.withColumn("words", F.lit(k)))
    return out.select("lang", "phrase", "words", "f"), totals


# --- collocations ------------------------------------------------------------------------------------


def _some(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases of two words and more that no longer one subsumes.

    ``phrases`` holds the parts of every phrase, as ``frequent_phrases`` gives them."""
    f = phrases.select("lang", "phrase", "f")
    longer = phrases.where(F.col("words") > 1).withColumn("w", F.split("phrase", " "))
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", _some(F.col("w"), 1, F.col("k")).alias("left"),
        _some(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cuts = (cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    cuts = cuts.withColumn("both", _wide("l") + _wide("r")).withColumn(
        "score", F.expr("cast(cast(a as decimal(20, 0)) * 2000000 div both as bigint)"))
    least = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    held = longer.where(F.col("words") > 2).select("lang", "f", F.explode(F.array(
        _some(F.col("w"), 1, F.col("words") - 1), _some(F.col("w"), 2, F.col("words") - 1))).alias("phrase"))
    most = held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return least.join(most, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (_wide("most") * 100 < _wide("a") * 80)).drop("most")


def op11_stripes_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language of ``documents``."""
    arrow_batches(spark)
    phrases, totals = frequent_phrases(documents(spark, sf_dir), scratch(spark, "stripes"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = collocations(phrases).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
cut AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM cut, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
n AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 30),
words AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.w, c.f AS a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM words) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')),
least_cut AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(generate_series(1, m - s + 1)) AS i
        FROM (SELECT *, unnest(generate_series(2, m - 1)) AS s FROM words WHERE m > 2))
  GROUP BY ALL),
kept AS (
  SELECT c.* FROM least_cut c LEFT JOIN inside USING (lang, phrase)
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
