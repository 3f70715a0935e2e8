"""Benchmark decontamination with an FM-index per training shard.

A window is ``WINDOW`` consecutive words of a benchmark text, or the whole of a
shorter one. The windows are written once as a trie of their ends: a node of
level j is the last j words of a window, so a backward search walks each shared
end once. Scanning tasks cut their documents into shards of ``SHARD_BYTES`` of
text, build an FM-index of each (``fm_index``), walk the trie level by level
through wavelet-tree ranks, drop what no longer occurs, locate the occurrences
of whole windows by sampled suffix positions, and merge the words they cover
into spans. No row of the corpus is shuffled.

Blocks of the trie (about ``BLOCK_BYTES`` of benchmark text each) lie in the
shared folder and are read one at a time, so that a task's memory depends on
neither table. A text over ``SHARD_WORDS`` words is cut into parts that overlap
by ``WINDOW - 1`` words. Words are compared as 64-bit hashes.

Defined results: a null text has no words, no hits and no spans; a benchmark
text without words has no window; repeated items of one item_id count once,
items without id mark words but are not counted; equal texts get equal results;
empty tables give no rows or no hits; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, arrow_batches, byte_texts, chunks, documents, release, scratch
from .elias_fano import load_array, save_array
from .fm_index import FMIndex

WINDOW = 10
SHARD_BYTES = 6 << 20
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 1 << 20
_MOST_ROWS = 1 << 20
# A-Z lower-cased; every other byte below 128 that is neither digit nor letter parts words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


# --- the trie of the windows' ends -----------------------------------------------------------


def _trie(w: Words, items: int) -> dict[str, np.ndarray]:
    """Levels (parent node and word before it) and ends (level, node, item) of the windows of some items."""
    size = np.bincount(w.doc, minlength=items)
    first = np.cumsum(size) - size
    width = np.minimum(size, WINDOW)
    many = np.where(size > 0, size - width + 1, 0)
    item = np.repeat(np.arange(items), many)
    start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[item]
    last, width = start + width[item] - 1, width[item]
    out, ends = {}, []
    node = np.zeros(len(start), dtype=np.int64)
    live = np.arange(len(start))
    kinds, number = np.unique(w.hash, return_inverse=True)
    for level in range(1, WINDOW + 1):
        live = live[width[live] >= level]
        if not len(live):
            break
        word = number[last[live] - level + 1]
        pair, at, node_of = np.unique(node[live] * len(kinds) + word, return_index=True, return_inverse=True)
        out[f"parent{level}"], out[f"word{level}"] = pair // len(kinds), kinds[word[at]]
        node[live] = node_of
        done = live[width[live] == level]
        ends.append(np.unique(np.stack([np.full(len(done), level), node[done], item[done]]), axis=1))
    out["ends"] = np.concatenate(ends, axis=1) if ends else np.zeros((3, 0), dtype=np.int64)
    return out


def _write_windows(benchmark: DataFrame, folder: str) -> list[str]:
    """The trie blocks of all items under ``folder``; their names, one for each ``BLOCK_BYTES`` of benchmark text."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids, texts = b.column(0).cast(pa.binary()).to_pylist(), byte_texts(b.column(1))
            for lo, hi in chunks(texts, BLOCK_BYTES):
                name = uuid.uuid4().hex
                for k, v in _trie(Words([t.translate(_FOLD) for t in texts[lo:hi]]), hi - lo).items():
                    save_array(f"{folder}/{name}", k, v)
                own = [x if x is not None else b"" for x in ids[lo:hi]]
                save_array(f"{folder}/{name}", "ids", np.frombuffer(b"".join(own), dtype=np.uint8))
                save_array(f"{folder}/{name}", "id_size", np.array(
                    [-1 if x is None else len(x) for x in ids[lo:hi]], dtype=np.int64))
                yield pa.RecordBatch.from_pydict({"block": [name]})

    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return [r.block for r in texts.mapInArrow(run, "block string").collect()]


class _Block:
    """A trie block as a task holds it."""

    def __init__(self, folder: str):
        ends = load_array(folder, "ends")
        levels = int(ends[0].max()) if ends.shape[1] else 0
        self.levels = [(np.array(load_array(folder, f"parent{k}")), np.array(load_array(folder, f"word{k}")))
                       for k in range(1, levels + 1)]
        # each distinct window once, with the range of its items
        order = np.lexsort(ends[::-1])
        level, node, self.item = ends[:, order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(level) != 0) | (np.diff(node) != 0)])) if len(order) else order
        self.level, self.node = level[new], node[new]
        self.first = np.append(new, len(order))
        size, flat = load_array(folder, "id_size"), load_array(folder, "ids").tobytes()
        end = np.cumsum(np.maximum(size, 0))
        self.ids = [None if n < 0 else flat[e - n:e] for n, e in zip(size.tolist(), end.tolist())]

    def occurrences(self, index: FMIndex) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window, text and first word of all occurrences, a bounded number at a time."""
        low = high = np.zeros(1, dtype=np.int64)
        found_low, found_high = np.zeros(len(self.node), np.int64), np.zeros(len(self.node), np.int64)
        for k, (parent, words) in enumerate(self.levels, 1):
            symbol = index.symbol(words)
            live = np.flatnonzero((symbol > 0) & ((high[parent] > low[parent]) if k > 1 else True))
            was_low, was_high = low[parent[live]], high[parent[live]]
            low, high = np.zeros(len(parent), dtype=np.int64), np.zeros(len(parent), dtype=np.int64)
            low[live], high[live] = (index.extend(symbol[live], was_low, was_high) if k > 1 else index.whole(symbol[live]))
            at = self.level == k
            found_low[at], found_high[at] = low[self.node[at]], high[self.node[at]]
        many = found_high - found_low
        window, lo = np.flatnonzero(many > 0), 0
        upto = np.cumsum(many[window])
        while lo < len(window):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _MOST_ROWS, side="right")))
            own, n = window[lo:hi], many[window[lo:hi]]
            rows = np.arange(n.sum()) + np.repeat(found_low[own] - (np.cumsum(n) - n), n)
            yield (np.repeat(own, n), *index.locate(rows))
            lo = hi


# --- scanning the documents ------------------------------------------------------------------


def _parts(size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shards of at most about SHARD_WORDS words: text, first word (of all) and words of each of their parts."""
    first = np.cumsum(size) - size
    text, start, many, held = [], [], [], 0
    for t in np.flatnonzero(size):
        at, n = int(first[t]), int(size[t])
        while True:
            own = min(n, SHARD_WORDS)
            text.append(t), start.append(at), many.append(own)
            held += own
            if held >= SHARD_WORDS:
                yield np.array(text), np.array(start), np.array(many)
                text, start, many, held = [], [], [], 0
            if own == n:
                break
            at, n = at + own - (WINDOW - 1), n - own + (WINDOW - 1)
    if text:
        yield np.array(text), np.array(start), np.array(many)


def _scan(texts: list[bytes], blocks: Iterator[_Block] | list[_Block]) -> tuple[Words, np.ndarray, list[set[bytes]]]:
    """Words, which of them are hit, and the items found in each text."""
    w = Words([t.translate(_FOLD) for t in texts])
    change = np.zeros(len(w.hash) + 1, dtype=np.int64)
    items: list[set[bytes]] = [set() for _ in texts]
    for text, start, many in _parts(np.bincount(w.doc, minlength=len(texts))):
        place = np.arange(many.sum()) + np.repeat(start - (np.cumsum(many) - many), many)
        index = FMIndex(w.hash[place], many)
        for block in blocks():
            for window, part, at in block.occurrences(index):
                first = start[part] + at
                np.add.at(change, first, 1)
                np.add.at(change, first + block.level[window], -1)
                for t, k in np.unique(np.stack([text[part], window], axis=1), axis=0).tolist():
                    items[t].update(x for x in (block.ids[i] for i in block.item[block.first[k]:block.first[k + 1]])
                                    if x is not None)
    return w, np.cumsum(change[:-1]) > 0, items


_FOUND = ("n_words long, n_hit long, items array<string>, "
          "spans array<struct<first: long, last: long, from_byte: long, to_byte: long>>")


def removal_spans(docs: DataFrame, benchmark: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids, sorted as strings) and spans of every document.

    A span is a run of hit words: their first and last word number and the bytes of the UTF-8 text they take, from
    the first byte of the first word to the byte after the last."""
    folder = folder or scratch(docs.sparkSession, "fm")
    names = _write_windows(benchmark, folder)

    def run(batches):
        import pyarrow as pa
        held: list[_Block] = []

        def blocks():
            for name in names:
                if len(names) > 1 or not held:
                    held[:] = [_Block(f"{folder}/{name}")]
                yield held[0]

        def answer(ids, texts):
            w, hit, items = _scan(texts, blocks)
            edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
            joint = np.concatenate([[False], hit[1:] & hit[:-1] & (w.doc[1:] != w.doc[:-1])]) if len(hit) else hit
            first = np.flatnonzero((edge[:-1] == 1) | joint)
            last = np.flatnonzero((edge[1:] == -1) | np.append(joint[1:], False)) if len(hit) else first
            size = np.bincount(w.doc, minlength=len(texts))
            begin = (np.cumsum(size) - size)[w.doc[first]]
            many = np.bincount(w.doc[first], minlength=len(texts))
            offset = w.doc_start[w.doc[first]]
            spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (
                first - begin, last - begin, w.start[first] - offset, w.end[last] - offset)],
                ["first", "last", "from_byte", "to_byte"])
            ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            sorted_items = [x.decode() for own in items for x in sorted(own)]
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(size, pa.int64()),
                pa.array(np.bincount(w.doc[hit], minlength=len(texts)), pa.int64()),
                pa.ListArray.from_arrays(ends([len(x) for x in items]), pa.array(sorted_items, pa.string())),
                pa.ListArray.from_arrays(ends(many), spans)], ["doc_id", "n_words", "n_hit", "items", "spans"])

        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), byte_texts(b.column(1))):
                if texts and size + len(t) > SHARD_BYTES:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield answer(ids, texts)
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, {_FOUND}")


def without_spans(text: str | None, spans) -> str | None:
    """The text without the bytes of its spans."""
    if text is None or not spans:
        return text
    data, kept, at = text.encode(), [], 0
    for s in spans:
        kept.append(data[at:s["from_byte"]])
        at = s["to_byte"]
    return b"".join([*kept, data[at:]]).decode()


def op12_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items found in every whole text of ``documents``."""
    arrow_batches(spark)
    found = removal_spans(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS m FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT item_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM sized)),
places AS (
  SELECT r, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
found AS (SELECT r, i, p.m, item_id FROM places p JOIN windows USING (m, g)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (
  SELECT r, unnest(generate_series(i, i + m - 1)) AS k FROM found) GROUP BY r),
own AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN own USING (r)
"""
