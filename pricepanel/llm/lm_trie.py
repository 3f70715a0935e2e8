"""Language-model scoring with an Elias-Fano n-gram trie.

Level k of the trie holds the k-grams of the training texts in the order of
their context and last word. A context is the place of the (k-1)-gram in the
level above; Elias-Fano pointers give the range of its followers. Within the
range the words are an Elias-Fano sequence relative to the context: word w of a
context with m followers from place b on is stored as b + w * m / words, with
enough binary places to tell all words apart, so that the whole level rises
evenly, however many followers a context has, and the successor search of a
query looks at a few numbers. Per k-gram there is a 16-bit code of its smoothed
probability, per context one of its back-off weight. Words are numbered by the
rank of a 63-bit hash; level 1 is the Elias-Fano sequence of these hashes. Levels are shards, a file each, in the shared
folder, memory-mapped by the scoring tasks: what a task keeps in its own memory
does not grow with the model. A look-up costs something for each shard it meets, so a task
looks up what its texts need in few batches, and words, far fewer than tokens, are joined to full shards.

Probabilities are interpolated absolute discounting: (c - D) / c(context) plus
the mass left over times the lower order; at order 1 the mass left over is that
of any unknown word. All k-grams of all training texts are counted and kept; were
``MIN_COUNTS`` raised, those under it would be pruned (their mass is in the back-off). A
k-gram can only reach its threshold if its parts do, so each level is counted
over the tokens whose parts are in the level above.

Counting: a task sums the k-grams of its texts and packs them, sorted and
delta-coded, into one block for each key range; Spark shuffles the blocks by
range, and the task of a range merges them into a shard. Word numbers are ranks
of hashes, so ranges of equal width are about equally full, and a hot word is
one entry a block.

Defined results: null text is empty: one token, the end; rows without id are
held out from training and scored; without training texts every token is
unknown with probability 1; copies get equal scores; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, arrow_batches, byte_texts, chunks, documents, fold, kept_table, release, scratch, shuffles_dropped
from .elias_fano import Arrays, EliasFano, save_arrays

FOLDS, HELD_OUT = 7, 2
ORDER = 3
MIN_COUNTS = (1, 1, 1)  # nothing is pruned
DISCOUNT = 0.7
PART_TOKENS = 2_000_000
OPEN_ARRAYS = 4096  # files of arrays a task keeps open
_KEY_BITS = 63
_END = 0x3C6EF372FE94F82A  # key of the end token: a constant of its own
_STEP = 4096  # codes a unit of log10
_HELD = 2_000_000
_LOOKED_UP = 20 << 20  # bytes of word numbers that are looked up together: repeats once, and enough for each shard
_STRETCH = 1 << 20  # look-ups, in the order of the trie, whose numbers are held at a time
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _code(p: np.ndarray) -> np.ndarray:
    """Quantised log10 of probabilities."""
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) * _STEP), 0, 65534).astype(np.uint16)


def _log(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (-1.0 / _STEP)


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(counts.max()))


@dataclass
class Model:
    """Where the levels are; the arrays themselves are opened by the tasks."""

    folder: str
    tokens: int = 0  # N
    kinds: int = 0  # V, the end included
    texts: int = 0
    parts: list[int] = field(default_factory=list)  # shards of each level
    spans: list[int] = field(default_factory=list)  # key range of a shard
    sizes: list[list[int]] = field(default_factory=list)  # k-grams of each shard

    @property
    def stride(self) -> int:
        return self.kinds + 1

    @property
    def start(self) -> int:  # number of the context before the first word
        return self.kinds

    @property
    def unknown(self) -> int:
        return self.kinds + 1


def _bits(stride: int) -> int:
    return stride.bit_length()


def _relative(words: np.ndarray, begin: np.ndarray, many: np.ndarray, stride: int) -> np.ndarray:
    """begin + words * many / stride, with ``_bits`` binary places: rises with the word, never the same for two."""
    product = words * many
    whole = product // stride
    return ((begin + whole) << _bits(stride)) + ((product - whole * stride) << _bits(stride)) // stride


def _word_of(value: np.ndarray, begin: np.ndarray, many: np.ndarray, stride: int) -> np.ndarray:
    """The word that ``_relative`` gave that value."""
    t = _bits(stride)
    whole, part = (value >> t) - begin, value & ((1 << t) - 1)
    rest = (part * stride + (1 << t) - 1) >> t
    return (whole * stride + rest) // many


class Trie:
    """The levels of a model, opened on demand."""

    def __init__(self, model: Model):
        self.model = model
        self.first = [np.concatenate([[0], np.cumsum(n)]) for n in model.sizes]
        self.open: dict[tuple[int, int], tuple[Arrays, dict[str, EliasFano]]] = {}  # least recently used first

    def _opened(self, level: int, shard: int) -> tuple[Arrays, dict[str, EliasFano]]:
        key = (level, shard)
        got = self.open.pop(key, None)
        if got is None:
            while len(self.open) >= OPEN_ARRAYS:  # maps of a process, and memory where arrays are fetched, are bounded
                self.open.pop(next(iter(self.open)))
            got = Arrays(f"{self.model.folder}/level{level}", str(shard)), {}
        self.open[key] = got
        return got

    def _array(self, level: int, shard: int, name: str) -> np.ndarray:
        return self._opened(level, shard)[0][name]

    def _ef(self, level: int, shard: int, name: str) -> EliasFano:
        arrays, sequences = self._opened(level, shard)
        if name not in sequences:
            sequences[name] = EliasFano.kept(arrays.__getitem__, name)
        return sequences[name]

    @staticmethod
    def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice]]:
        """Each shard and its entries; where these lie in a row, as a slice."""
        if not len(shard):
            return
        order = None
        if (shard[1:] < shard[:-1]).any():
            order = np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")  # 16 bits: by radix
            shard = shard[order]
        cut = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield int(shard[lo]), slice(lo, hi) if order is None else order[lo:hi]

    def find(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Places of the keys in a level, -1 where absent."""
        out = np.full(len(keys), -1, dtype=np.int64)
        span = self.model.spans[level - 1]
        shard = keys // span
        for s, at in self._by_shard(shard):
            if self.model.sizes[level - 1][s]:
                got = self._ef(level, s, "keys").find(keys[at] - s * span)
                out[at] = np.where(got >= 0, got + self.first[level - 1][s], -1)
        return out

    def value(self, level: int, places: np.ndarray, name: str) -> np.ndarray:
        """Entries of a per-k-gram array (counts, code) at the places."""
        if not len(places):
            return np.zeros(0, dtype=np.int64)
        out = None
        shard = np.searchsorted(self.first[level - 1], places, side="right") - 1
        for s, at in self._by_shard(shard):
            got = self._array(level, s, name)[places[at] - self.first[level - 1][s]]
            if out is None:
                out = np.zeros(len(places), dtype=got.dtype)
            elif out.dtype != got.dtype:  # each shard's are as wide as its largest
                out = out.astype(np.promote_types(out.dtype, got.dtype), copy=False)
            out[at] = got
        return out

    def last_word(self, level: int, places: np.ndarray) -> np.ndarray:
        """The last words of the k-grams at the places (opens all pointers of a shard)."""
        out = np.zeros(len(places), dtype=np.int64)
        shard = np.searchsorted(self.first[level - 1], places, side="right") - 1
        for s, at in self._by_shard(shard):
            pointers = self._ef(level, s, "pointers")
            begin = pointers.get(np.arange(pointers.size)).astype(np.int64)
            own = places[at] - self.first[level - 1][s]
            context = np.searchsorted(begin, own, side="right") - 1
            out[at] = _word_of(self._ef(level, s, "keys").get(own).astype(np.int64), begin[context],
                               begin[context + 1] - begin[context], self.model.stride)
        return out

    def _follow(self, level: int, shard: int, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Place in its shard of each context's follower, -1 where absent; contexts counted from the shard's first."""
        begin, end = (x.view(np.int64) for x in self._ef(level, shard, "pointers").neighbours(contexts))
        many = end - begin
        got = self._ef(level, shard, "keys").find(_relative(words, begin, many, self.model.stride))
        got[many == 0] = -1
        return got

    def follow(self, level: int, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Place of each context's follower, -1 where absent."""
        place = np.full(len(contexts), -1, dtype=np.int64)
        wide = self.model.spans[level - 1] // self.model.stride
        for s, at in self._by_shard(contexts // wide):
            if self.model.sizes[level - 1][s]:
                got = self._follow(level, s, contexts[at] - s * wide, words[at])
                place[at] = np.where(got >= 0, got + self.first[level - 1][s], -1)
        return place

    def _step(self, level: int, contexts: np.ndarray, words: np.ndarray, lower) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(word | context) and the follower's place; ``lower`` gives the lower order's for absent followers."""
        score = np.empty(len(contexts), dtype=np.float64)
        place = np.full(len(contexts), -1, dtype=np.int64)
        weight = np.zeros(len(contexts), dtype=np.int64)  # code + 1 of the back-off weight, 0 without followers
        wide = self.model.spans[level - 1] // self.model.stride
        for s, at in self._by_shard(contexts // wide):
            if not self.model.sizes[level - 1][s]:
                continue
            own = contexts[at] - s * wide
            got = self._follow(level, s, own, words[at])
            score[at] = _log(self._array(level, s, "code")[np.maximum(got, 0)])
            place[at] = np.where(got >= 0, got + self.first[level - 1][s], -1)
            miss = got < 0
            if miss.any():
                left = np.zeros(len(own), dtype=np.int64)
                left[miss] = self._array(level, s, "backoff")[own[miss]]
                weight[at] = left
        miss = np.flatnonzero(place < 0)
        score[miss] = lower(miss)
        backed = miss[weight[miss] > 0]
        score[backed] += _log(weight[backed] - 1)
        return score, place

    def unigram(self, words: np.ndarray) -> np.ndarray:
        """log10 probability of word numbers."""
        m = self.model
        left = DISCOUNT * m.kinds / m.tokens if m.tokens else 1.0
        out = np.full(len(words), math.log10(left))
        known = np.flatnonzero(words < m.kinds)
        out[known] = _log(self.value(1, words[known], "code"))
        return out

    def bigram(self, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(word | word before), and the place of the pair in level 2 (-1: absent)."""
        if len(self.model.parts) < 2:
            return self.unigram(words), np.full(len(words), -1, dtype=np.int64)
        known = np.flatnonzero(before <= self.model.start)
        if len(known) < len(words):
            score, place = self.unigram(words), np.full(len(words), -1, dtype=np.int64)
            score[known], place[known] = self.bigram(before[known], words[known])
            return score, place
        return self._step(2, before, np.minimum(words, self.model.start), lambda miss: self.unigram(words[miss]))

    def trigram(self, pair: np.ndarray, words: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 p(word | the pair at that place of level 2), given the lower order's."""
        score = lower.copy()
        at = np.flatnonzero(pair >= 0)
        score[at] = self._step(3, pair[at], np.minimum(words[at], self.model.start), lambda miss: lower[at[miss]])[0]
        return score


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys, each once and in order, and the number of each entry's key."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    which = np.empty(len(keys), dtype=np.int32 if len(keys) >> 31 == 0 else np.int64)
    which[order] = np.cumsum(new, dtype=which.dtype) - 1
    return keys[new], which


def _pairs(keys: np.ndarray, wide: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Stretches of keys first * wide + second (second below ``wide``), taken apart."""
    for lo in range(0, len(keys), _STRETCH):
        at = slice(lo, min(lo + _STRETCH, len(keys)))
        first = keys[at] // wide
        yield at, first, keys[at] - first * wide


# --- counting: packed blocks of (key, entry) for each key range -----------------------------------
# An entry is count << 16 | code: the code of the lower order's probability, one for all of a key (0 where it isn't counted).


def _summed(keys: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, entries = keys[order], entries[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(entries & -65536, first) | entries[first] & 65535 if len(first) else entries


def _pack(keys: np.ndarray, entries: np.ndarray) -> bytes:
    """Sorted keys as gaps, byte by byte (the high bytes are zeros), with the entries."""
    import pyarrow as pa
    gaps = np.diff(keys, prepend=0).astype(np.uint64)
    planes = np.concatenate([gaps, entries.astype(np.uint64)]).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack(block: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa
    planes = np.frombuffer(pa.decompress(block, decompressed_size=n * 16, codec="zstd", asbytes=True), dtype=np.uint8)
    both = np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64)
    return np.cumsum(both[:n].astype(np.int64)), both[n:].astype(np.int64)


class _Counter:
    """Sums keys of a task; gives blocks for each range when it holds too many, and at the end."""

    def __init__(self, span: int):
        self.span, self.keys, self.entries, self.held = span, [], [], 0

    def add(self, keys: np.ndarray, codes: np.ndarray | None = None) -> None:
        if codes is None:
            keys, counts = np.unique(keys, return_counts=True)
            self._hold(keys, counts << 16)
        else:
            self._hold(*_summed(keys, np.add(codes, 1 << 16, dtype=np.int64)))

    def add_counted(self, key: int, count: int) -> None:
        self._hold(np.array([key], dtype=np.int64), np.array([count << 16], dtype=np.int64))

    def _hold(self, keys: np.ndarray, entries: np.ndarray) -> None:
        if len(keys):
            self.keys.append(keys)
            self.entries.append(entries)
            self.held += len(keys)

    def blocks(self, last: bool = False):
        import pyarrow as pa
        if not self.held or self.held < _HELD and not last:
            return
        if len(self.keys) > 1:  # each is in order and has a key once
            self.keys, self.entries = map(list, zip(_summed(np.concatenate(self.keys), np.concatenate(self.entries))))
        keys, entries = self.keys[0], self.entries[0]
        self.held = len(keys)
        if len(keys) < _HELD // 2 and not last:
            return
        self.keys, self.entries, self.held = [], [], 0
        part = keys // self.span
        cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]])
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part[cut[:-1]], pa.int64()), "n": pa.array(np.diff(cut), pa.int64()),
            "block": pa.array([_pack(keys[i:j], entries[i:j]) for i, j in zip(cut[:-1], cut[1:])], pa.binary())})


_BLOCKS = "part long, n long, block binary"


def _shards(blocks: DataFrame, build, parts: int) -> list[int]:
    """Merge the blocks of each range and ``build`` its shard; the number of k-grams kept in each."""

    def run(batches):
        import pyarrow as pa
        current, keys, entries, held, done, sizes = None, [], [], 0, [], []

        def finish():
            done.append(current)
            k, e = _summed(np.concatenate(keys), np.concatenate(entries))
            sizes.append(build(current, k, e >> 16, e & 65535))

        for b in batches:
            for part, n, block in zip(*(c.to_pylist() for c in b.columns)):
                if part != current and current is not None:
                    finish()
                    keys, entries, held = [], [], 0
                current = part
                k, e = _unpack(block, n)
                keys.append(k)
                entries.append(e)
                held += len(k)
                if held > 2 * _HELD:
                    k, e = _summed(np.concatenate(keys), np.concatenate(entries))
                    keys, entries, held = [k], [e], len(k)
        if current is not None:
            finish()
        keys, entries = [], []
        release()
        yield pa.RecordBatch.from_pydict({"part": pa.array(done, pa.int64()), "size": pa.array(sizes, pa.int64())})

    with shuffles_dropped(blocks.sparkSession):
        got = (blocks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, "part long, size long")
               .collect())  # one row a shard
    sizes = [0] * parts
    for part, size in got:
        sizes[part] = size
    return sizes


# --- the levels --------------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(fold("doc_id", FOLDS) != HELD_OUT, F.lit(False)).alias("train"))


def _range(parts: int) -> int:
    """Width of the key ranges that cut the word hashes in ``parts`` (and a few last keys beyond them)."""
    return ((1 << _KEY_BITS) - 1) // parts


def _word_keys(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    w = Words([t.translate(_LOWER) for t in texts])
    return w, (w.hash >> np.uint64(1)).astype(np.int64)


def _count_words(docs: DataFrame, parts: int) -> DataFrame:
    span = _range(parts)

    def run(batches):
        counter = _Counter(span)
        for b in batches:
            train = b.column(2).to_numpy(zero_copy_only=False)
            texts = [t for t, use in zip(byte_texts(b.column(1)), train) if use]
            counter.add_counted(_END, len(texts))
            for lo, hi in chunks(texts):
                counter.add(_word_keys(texts[lo:hi])[1])
            yield from counter.blocks()
        yield from counter.blocks(last=True)
        release()

    return _texts(docs).where("train").mapInArrow(run, _BLOCKS)


def _build_words(folder: str, span: int):
    def build(part: int, keys: np.ndarray, counts: np.ndarray, _: np.ndarray) -> int:
        save_arrays(f"{folder}/words", str(part), {"keys": keys - part * span, "counts": _narrow(counts)})
        return len(keys)

    return build


def _join_words(spark: SparkSession, model: Model) -> None:
    """Level 1 from the ranges of words: as many together as make a full shard, with log10 of (c - D) / N, once N is known."""
    folder, tokens, sizes, span = model.folder, model.tokens, model.sizes[0], model.spans[0]
    ranges = len(sizes) - 1
    many = min(ranges, max(1, ranges * PART_TOKENS // model.kinds))

    def run(batches):
        for b in batches:
            for shard in b.column(0).to_pylist():
                parts = [i for i in range(shard * many, min((shard + 1) * many, len(sizes))) if sizes[i]]
                if not parts:
                    continue
                words = [Arrays(f"{folder}/words", str(i)) for i in parts]
                keys = np.concatenate([w["keys"] + (i - shard * many) * span for i, w in zip(parts, words)])
                counts = np.concatenate([w["counts"].astype(np.int64) for w in words])
                save_arrays(f"{folder}/level1", str(shard), EliasFano.of(keys, many * span).arrays("keys", get=False)
                            | {"counts": counts, "code": _code((counts - DISCOUNT) / tokens)})
            yield b

    model.parts[0], model.spans[0] = math.ceil(len(sizes) / many), many * span
    model.sizes[0] = [sum(sizes[i:i + many]) for i in range(0, len(sizes), many)]
    spark.range(model.parts[0]).mapInArrow(run, "id long").count()


def _tokenised(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, ids (word numbers, 8 bytes each) of every text."""

    def run(batches):
        import pyarrow as pa
        trie = Trie(model)
        for b in batches:
            texts = byte_texts(b.column(1))
            n_tokens, n_known, base, ids = [], [], [], []
            for lo, hi in chunks(texts):
                w, keys = _word_keys(texts[lo:hi])
                kinds, which = np.unique(np.append(keys, _END), return_inverse=True)
                place = trie.find(1, kinds)
                count = np.zeros(len(kinds), dtype=np.int64)
                known = place >= 0
                count[known] = trie.value(1, place[known], "counts")
                number = np.where(known, place, model.unknown)
                share = np.log10((count + 1) / (model.tokens + model.kinds + 1))
                end = which[-1]
                which = which[:-1]
                size = np.bincount(w.doc, minlength=hi - lo)
                n_tokens.append(size + 1)
                n_known.append(np.bincount(w.doc, weights=known[which], minlength=hi - lo).astype(np.int64) + int(known[end]))
                base.append(np.bincount(w.doc, weights=share[which], minlength=hi - lo) + share[end])
                flat = number[which]
                for piece in np.split(flat, np.cumsum(size)[:-1]):
                    ids.append(np.append(piece, number[end]).astype(np.int64 if model.unknown >> 32 else np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "train": b.column(2), "n_tokens": pa.array(np.concatenate(n_tokens), pa.int64()),
                "n_known": pa.array(np.concatenate(n_known), pa.int64()),
                "base_score": pa.array(np.concatenate(base), pa.float64()), "ids": pa.array(ids, pa.binary())})

    return _texts(docs).mapInArrow(
        run, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, ids binary")


def _gathered(batches: Iterator, column: int) -> Iterator:
    """Batches put together as far as the word numbers of that column can be looked up together."""
    import pyarrow as pa

    def whole(held: list) -> list:
        return held if len(held) < 2 else pa.Table.from_batches(held).combine_chunks().to_batches()

    held, size = [], 0
    for b in batches:
        if held and size + b.column(column).nbytes > _LOOKED_UP:
            yield from whole(held)
            held, size = [], 0
        held.append(b)
        size += b.column(column).nbytes
    yield from whole(held)


def _sequences(column, model: Model) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their word numbers in a row, the start mark before each text; and each one's text."""
    kind = np.int64 if model.unknown >> 32 else np.uint32
    blobs = column.to_pylist()
    for lo, hi in chunks(blobs, _LOOKED_UP):
        size = np.fromiter((len(x) // np.dtype(kind).itemsize for x in blobs[lo:hi]), dtype=np.int64, count=hi - lo)
        doc = np.repeat(np.arange(hi - lo, dtype=np.int32), size + 1)
        ids = np.full(len(doc), model.start, dtype=np.int64)
        inside = np.ones(len(doc), dtype=bool)
        inside[np.cumsum(size + 1) - (size + 1)] = False
        ids[inside] = np.frombuffer(b"".join(blobs[lo:hi]), dtype=kind)
        del inside
        yield lo, hi, ids, doc


def _count_grams(tokens: DataFrame, model: Model, level: int, span: int) -> DataFrame:
    """Blocks of the counts of ``level``-grams whose parts are frequent enough, over all training texts."""

    def run(batches):
        trie, counter = Trie(model), _Counter(span)
        least = MIN_COUNTS[level - 1]
        for b in _gathered(batches, 0):
            for _, _, ids, doc in _sequences(b.column(0), model):
                same = doc[1:] == doc[:-1]
                if level == 2:
                    often = np.full(len(ids), model.texts >= least)
                    word = ids != model.start
                    often[word] = trie.value(1, ids[word], "counts") >= least
                    at = np.flatnonzero(same & often[1:] & often[:-1])
                    counter.add(ids[at] * model.stride + ids[at + 1])
                else:
                    pair = np.full(len(ids), -1, dtype=np.int64)  # of a word and the one before
                    at = np.flatnonzero(same) + 1
                    kinds, which = _distinct(ids[at - 1] * model.stride + ids[at])
                    place = np.empty(len(kinds), dtype=np.int64)
                    lower = np.empty(len(kinds), dtype=np.uint16)  # the shard is at hand here: building looks nothing up
                    for some, before, word in _pairs(kinds, model.stride):
                        score, place[some] = trie.bigram(before, word)
                        lower[some] = np.minimum(np.rint(score * -_STEP), 65535)
                    pair[at] = place[which]
                    code = np.zeros(len(ids), dtype=np.uint16)
                    code[at] = lower[which]
                    del kinds, which, place, lower
                    at = np.flatnonzero(same & (pair[:-1] >= 0) & (pair[1:] >= 0))
                    pair = pair[at] * model.stride
                    pair += ids[at + 1]
                    counter.add(pair, code[at + 1])
            yield from counter.blocks()
        yield from counter.blocks(last=True)
        release()

    return tokens.where("train").select("ids").mapInArrow(run, _BLOCKS)


def _build_grams(model: Model, level: int, span: int):
    wide = span // model.stride
    least = MIN_COUNTS[level - 1]

    def build(part: int, keys: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> int:
        trie = Trie(model)
        keep = counts >= least
        keys, counts, codes = keys[keep], counts[keep], codes[keep]
        if not len(keys):
            return 0
        context, word = keys // model.stride, keys % model.stride
        kinds, first, size = np.unique(context, return_index=True, return_counts=True)
        if level == 2:
            total = np.full(len(kinds), model.texts, dtype=np.int64)
            own = kinds < model.start
            total[own] = trie.value(1, kinds[own], "counts")
            lower = trie.unigram(word)
        else:
            total = trie.value(2, kinds, "counts").astype(np.int64)
            lower = _log(codes)
        share = (counts - DISCOUNT) / np.repeat(total, size)
        left = np.maximum(1.0 - np.add.reduceat(share, first), 1e-9)
        relative = _relative(word, np.repeat(first, size), np.repeat(size, size), model.stride)
        arrays = EliasFano.of(relative, len(keys) << _bits(model.stride)).arrays("keys", get=level < ORDER)
        begin = np.zeros(wide + 1, dtype=np.int64)
        begin[kinds - part * wide + 1] = size
        arrays |= EliasFano.of(np.cumsum(begin), len(keys) + 1).arrays("pointers", find=False)
        arrays["backoff"] = np.zeros(wide, dtype=np.uint16)
        arrays["backoff"][kinds - part * wide] = _code(left) + 1
        if level < ORDER:  # the totals of the next level
            arrays["counts"] = _narrow(counts)
        arrays["code"] = _code(share + np.repeat(left, size) * 10.0 ** lower)
        save_arrays(f"{model.folder}/level{level}", str(part), arrays)
        return len(keys)

    return build


def train(docs: DataFrame, folder: str, order: int = ORDER) -> tuple[Model, DataFrame]:
    """The model in ``folder``, and the tokenised texts of all rows."""
    spark = docs.sparkSession
    size = _texts(docs).where("train").agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    model = Model(f"{folder}/model")
    parts = max(1, math.ceil(size / 6 / PART_TOKENS))
    span = _range(parts)
    parts += 1  # the last keys, beyond parts * span
    blocks = _count_words(docs, parts - 1)
    model.parts, model.spans = [parts], [span]
    model.sizes = [_shards(blocks, _build_words(model.folder, span), parts)]
    model.kinds = sum(model.sizes[0])
    model.tokens = _tokens(spark, model)
    if model.kinds:
        _join_words(spark, model)
    model.texts = _trained(model)
    tokens = kept_table(_tokenised(docs, model), folder, "tokens")
    contexts = model.kinds + 1
    for level in range(2, order + 1):
        if not model.kinds or not contexts:
            break
        if contexts * model.stride >= 1 << 63:  # a key is context * stride + word
            raise ValueError(f"{contexts} contexts of {model.kinds} words do not fit 63-bit keys of level {level}")
        parts = max(1, math.ceil(model.tokens / PART_TOKENS))
        wide = math.ceil(contexts / parts)
        span = wide * model.stride
        blocks = _count_grams(tokens, model, level, span)
        sizes = _shards(blocks, _build_grams(model, level, span), parts)
        model.parts.append(parts)
        model.spans.append(span)
        model.sizes.append(sizes)
        contexts = sum(sizes)
    return model, tokens


def _tokens(spark: SparkSession, model: Model) -> int:
    """Training tokens, summed over the ranges of words."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            tokens = [int(Arrays(f"{model.folder}/words", str(p))["counts"].sum(dtype=np.int64)) if model.sizes[0][p] else 0
                      for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"tokens": pa.array(tokens, pa.int64())})

    return spark.range(model.parts[0]).mapInArrow(run, "tokens long").agg(F.sum("tokens")).first()[0] or 0


def _trained(model: Model) -> int:
    """Training texts: the ends of texts that were counted."""
    trie = Trie(model)
    end = trie.find(1, np.array([_END], dtype=np.int64)) if model.kinds else np.array([-1])
    return int(trie.value(1, end, "counts")[0]) if end[0] >= 0 else 0


def scored(tokens: DataFrame, model: Model) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score of the tokenised texts."""
    names = ["doc_id", "train", "n_tokens", "n_known", "base_score"]

    def run(batches):
        import pyarrow as pa
        trie = Trie(model)
        for b in _gathered(batches, 5):
            score = np.zeros(b.num_rows)
            for lo, hi, ids, doc in _sequences(b.column(5), model):
                at = np.flatnonzero(ids != model.start)
                kinds, which = _distinct(ids[at - 1] * (model.unknown + 1) + ids[at])  # each pair is looked up once
                one = np.empty(len(kinds), dtype=np.float64)
                place = np.empty(len(kinds), dtype=np.int64)
                for some, before, word in _pairs(kinds, model.unknown + 1):
                    one[some], place[some] = trie.bigram(before, word)
                value, pair = one[which], np.full(len(ids), -1, dtype=np.int64)
                pair[at] = place[which]
                del kinds, which, one, place
                if len(model.parts) > 2:
                    pair = pair[at - 1]  # of the two words before
                    live = np.flatnonzero(pair >= 0)
                    pair = pair[live] * model.stride
                    pair += np.minimum(ids[at[live]], model.start)
                    kinds, which = _distinct(pair)
                    one = np.empty(len(kinds), dtype=np.float64)
                    one[which] = value[live]  # the same for all of a kind: a pair's place tells its last word
                    for some, before, word in _pairs(kinds, model.stride):
                        one[some] = trie.trigram(before, word, one[some])
                    value[live] = one[which]
                    del kinds, which, one
                score[lo:hi] = np.bincount(doc[at], weights=value, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(score)], names=[*names, "score"])

    return tokens.select(*names, "ids").mapInArrow(
        run, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def op10_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and trigram score of every whole text of ``documents``."""
    arrow_batches(spark)
    model, tokens = train(documents(spark, sf_dir), scratch(spark, "lm"))
    return scored(tokens, model).select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
