"""BPE encoding and decoding by prefix-sharing trie traversal.

Every distinct pre-token is a path in a trie of byte prefixes. A node keeps the
last token of the BPE encoding of its prefix. For a prefix that is the one
vocabulary token ``t``, a suffix of the prefix, for which the encoding of the
rest (an ancestor's state) may stand before ``t``: two tokens are compatible if
merging their joined bytes gives just these two tokens. So a node needs its
ancestors only, a prefix shared by many words is encoded once, and a word's
ids are read off by stepping back from its node to the root. New words are
inserted in byte order, which is the depth-first order of the trie.

A pre-token over ``LONG_WORD`` bytes shares no path worth keeping: it is walked by
itself with the same states, of which only those within the longest token matter
for the next, and one number a byte is kept to read the ids off. A text over
``TEXT_PART`` characters is taken a bounded number of pre-tokens at a time.

Null text is the empty text: no tokens, and the empty text decoded. Repeated
rows and empty tables need no special case; a row is encoded by itself, and
columns of the input other than id and text are not read.
A trie is bounded by its nodes, looked at with every word, and by the words it knows, and starts anew beyond them. A Python worker may keep a large one
from task to task (``keep``); in a job of several stages a small one is made for each task, so that idle
workers hold no memory.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, documents, release

MAX_NODES = 1_400_000
MAX_WORDS = 450_000
MAX_PAIRS = 500_000
SMALL_TRIE = (150_000, 40_000)
LONG_WORD = 1024
TEXT_PART = 1 << 20
_PART_WORDS = 50_000
_SHORT = (2, 1)
NEVER = float("inf")

# The byte-level pre-tokenisation pattern of the public vocabulary, with the
# Unicode White_Space characters spelled out.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE
           + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeTrie:
    def __init__(self, path: str, max_nodes: int = MAX_NODES, max_words: int = MAX_WORDS):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_of_char()
        raw = lambda s: bytes(byte_of[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.id_of = {raw(s): i for s, i in vocab.items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        self.merges, self.halves, self.edges = {}, {}, ({}, {})
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
            self.halves.setdefault(vocab[a + b], (vocab[a], vocab[b]))
        # lengths of the tokens that end in these three bytes, longest first, then those of two bytes and one
        ends: dict[bytes, set[int]] = {}
        for data in self.id_of:
            if len(data) > 2:
                ends.setdefault(data[-3:], set()).add(len(data))
        self.sizes = {end: (*sorted(n, reverse=True), 2, 1) for end, n in ends.items()}
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.fits: dict[int, bool] = {}
        self.max_nodes, self.max_words = max_nodes, max_words
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.last = [-1]

    def merged(self, data: bytes) -> list[int]:
        """The merges applied in rank order to a short byte string."""
        ids = [self.id_of[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.merges.get(p, (1 << 30, -1)) for p in zip(ids, ids[1:])))
            if best[1] < 0:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merges.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at the left (0) or right (1) end of ``token`` while it is merged from bytes, in order,
        each with the rank of the merge that takes it up."""
        known = self.edges[side].get(token)
        if known is None:
            known = [(token, NEVER)]
            while (parts := self.halves.get(known[-1][0])) is not None:
                known.append((parts[side], self.merges[parts][0]))
            known = self.edges[side][token] = known[::-1]
        return known

    def compatible(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: nothing) in an encoding.

        Followed through time: the two tokens stand side by side in the end unless a merge across their
        border comes up before both of its sides are taken up by merges inside. Of equal ranks the left one
        goes first."""
        if before < 0:
            return self.merged(self.bytes_of[token]) == [token]
        left, right = self.edge(before, 1), self.edge(token, 0)
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = left[i], right[j]
            across = self.merges.get((a, b))
            if across is not None and across[0] < until_a and across[0] <= until_b:
                return False
            if until_a == until_b == NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def insert(self, word: bytes) -> list[int]:
        """Walk or extend the word's path, then read its ids off the states on it."""
        child, last, id_of, fits, sizes = self.child, self.last, self.id_of, self.fits, self.sizes
        node, path = 0, [0]
        for depth in range(1, len(word) + 1):
            key = node << 8 | word[depth - 1]
            found = child.get(key)
            if found is None:
                for n in sizes.get(word[depth - 3:depth], _SHORT) if depth > 2 else _SHORT[2 - depth:]:
                    if n > depth:
                        continue
                    token = id_of.get(word[depth - n:depth])
                    if token is not None:
                        before = last[path[depth - n]]
                        pair = before << 16 | token
                        fit = fits.get(pair)
                        if fit is None:
                            if len(fits) >= MAX_PAIRS:
                                fits.clear()
                            fit = fits[pair] = self.compatible(before, token)
                        if fit:
                            break
                else:
                    raise ValueError("the vocabulary lacks single bytes")
                found = len(last)
                child[key] = found
                last.append(token)
            node = found
            path.append(node)
        ids, depth = [], len(word)
        while depth:
            token = last[path[depth]]
            ids.append(token)
            depth -= len(self.bytes_of[token])
        return ids[::-1]

    def fit(self, before: int, token: int) -> bool:
        pair = before << 16 | token
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= MAX_PAIRS:
                self.fits.clear()
            known = self.fits[pair] = self.compatible(before, token)
        return known

    def walk(self, word: bytes) -> bytes:
        """The ids of one long word, as little-endian unsigned 32-bit integers, without a trie."""
        id_of, sizes, fit = self.id_of, self.sizes, self.fit
        last = array("i", [-1])  # last token of each prefix
        for depth in range(1, len(word) + 1):
            for n in sizes.get(word[depth - 3:depth], _SHORT) if depth > 2 else _SHORT[2 - depth:]:
                if n <= depth:
                    token = id_of.get(word[depth - n:depth])
                    if token is not None and fit(last[depth - n], token):
                        break
            else:
                raise ValueError("the vocabulary lacks single bytes")
            last.append(token)
        ids, depth = array("I"), len(word)
        while depth:
            token = last[depth]
            ids.append(token)
            depth -= len(self.bytes_of[token])
        ids.reverse()
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode the words not met yet, in the order of a depth-first walk."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > self.max_words:
            self.words = {}
            new = list(words)
        for data, w in sorted((w.encode("utf-8"), w) for w in new):
            if len(self.last) > self.max_nodes:
                self.clear()
            ids = self.insert(data)
            self.words[w] = (struct.pack(f"<{len(ids)}I", *ids), b"".join(map(self.bytes_of.__getitem__, ids)))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens in it stand for themselves."""
        if self.special is None or not any(s in text for s in self.specials):
            return self.split.findall(text)
        return list(self.stream(text))

    def stream(self, text: str) -> Iterator[str]:
        """The same, one at a time."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from (m[0] for m in self.split.finditer(text[at:found.start()]))
            yield found[0]
            at = found.end()
        yield from (m[0] for m in self.split.finditer(text[at:]))

    def _known(self, todo: list[list[str]]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded bytes of the pre-tokens of some texts; those of long ones are not kept."""
        words = {w for p in todo for w in p} - self.specials.keys()
        long = {w for w in words if len(w) > LONG_WORD}
        self.learn(words - long)
        for s, i in self.specials.items():
            self.words[s] = (struct.pack("<I", i), s.encode())
        if not long:
            return self.words
        own = {w: self.words[w] for p in todo for w in p if w not in long}
        for w in long:
            data = w.encode("utf-8")
            own[w] = (self.walk(data), data)  # the tokens of a word are its bytes
        return own

    def encode_decode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids as little-endian unsigned 32-bit integers, and the bytes they decode to, of each text."""
        if len(texts) == 1 and len(texts[0]) > TEXT_PART:
            ids, plain = bytearray(), bytearray()
            pieces = self.stream(texts[0])
            while part := list(islice(pieces, _PART_WORDS)):
                known = self._known([part])
                for w in part:
                    ids += known[w][0]
                    plain += known[w][1]
            yield bytes(ids), bytes(plain)
            return
        todo = list(map(self.pieces, texts))
        known = self._known(todo)
        for p in todo:
            both = [known[w] for w in p]
            yield b"".join([x[0] for x in both]), b"".join([x[1] for x in both])


_TRIES: dict[str, BpeTrie] = {}


def trie_of(path: str) -> BpeTrie:
    """This process's trie for a vocabulary file."""
    if path not in _TRIES:
        _TRIES[path] = BpeTrie(path)
    return _TRIES[path]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = True,
                     keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and on demand the ids themselves (``ids``, array<int>).

    ``keep``: each Python worker keeps a large trie for its next tasks, which takes memory and saves time."""
    path = vocabulary or vocabulary_path()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        import pyarrow as pa
        trie = trie_of(path) if keep else BpeTrie(path, *SMALL_TRIE)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, offsets, n, sha, back = [], [0], [], [], []
            lo = 0
            while lo < len(texts):  # a bounded amount of text at a time
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= TEXT_PART):
                    size += len(texts[hi])
                    hi += 1
                for code, plain in trie.encode_decode(texts[lo:hi]):
                    if with_ids:
                        ids.append(code)
                    offsets.append(offsets[-1] + len(code) // 4)
                    n.append(len(code) // 4)
                    sha.append(hashlib.sha256(code).hexdigest())
                    back.append(hashlib.sha256(plain.decode("utf-8", "replace").encode()).hexdigest())
                lo = hi
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha, pa.string()),
                   "decoded_sha256": pa.array(back, pa.string())}
            if with_ids:
                values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                out["ids"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_pydict(out)
        del trie
        release()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, schema))


def op8_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents`` with the public byte-level vocabulary."""
    arrow_batches(spark)
    return encode_documents(documents(spark, sf_dir), with_ids=False, keep=True)
