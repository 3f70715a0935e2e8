"""An FM-index over word numbers, queried a batch at a time.

The texts of a shard are one sequence of words with a separator after each
text. The suffix array comes from prefix doubling (the first ``63 // bits``
words of a suffix are one sort key, then only suffixes that are still tied are
sorted on); separators differ from one another, so that no tie reaches beyond
a text. Kept are the Burrows-Wheeler transform as a wavelet tree, level by
level in bit vectors with counts before every 64-bit word, and the position of
every ``SAMPLE``-th word of a text (its first included) for locating.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16
_ONE = np.uint64(1)


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; ``sequence`` holds numbers from 0, the last one nowhere else."""
    n = len(sequence)
    bits = max(1, int(sequence.max()).bit_length())
    depth = max(1, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(min(depth, n)):
        key <<= bits
        key[:n - j] |= sequence[j:]
    order = np.argsort(key)
    head = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slot = _tied(head, np.arange(n))
    while len(slot):
        start = order[slot]
        # tied suffixes are longer than depth: no place beyond the end is looked up
        key = rank[start] * n + rank[start + depth]
        by = np.argsort(key)
        start, key = start[by], key[by]
        order[slot] = start
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[start] = np.maximum.accumulate(np.where(head, slot, 0))
        slot = _tied(head, slot)
        depth *= 2
    return order


def _tied(head: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The slots of groups with more than one suffix."""
    alone = head & np.concatenate([head[1:], [True]])
    return slot[~alone]


class Bits:
    """A bit vector with rank."""

    __slots__ = ("words", "before")

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE == _ONE


class WaveletTree:
    """Rank and access over a sequence of symbols, one bit vector a level (zeros of a level before its ones)."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.shifts = range(max(1, (kinds - 1).bit_length()) - 1, -1, -1)
        self.levels, self.zeros = [], []
        for shift in self.shifts:
            one = (symbols >> shift) & 1 == 1
            self.levels.append(Bits(one))
            symbols = np.concatenate([symbols[~one], symbols[one]])
            self.zeros.append(len(symbols) - int(one.sum()))
        # where each symbol begins below the last level
        self.first = np.zeros(kinds, dtype=np.int64)
        self.first = self.rank(np.arange(kinds), np.zeros(kinds, dtype=np.int64))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        for shift, level, zeros in zip(self.shifts, self.levels, self.zeros):
            ones = level.rank(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at - self.first[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one, ones = level.get(at), level.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol = symbol * 2 + one
        return symbol, at - self.first[symbol]


class FMIndex:
    """Words (any 64-bit numbers) of texts one after another; ``sizes`` are the words of each text."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        n, texts = len(words), len(sizes)
        self.kinds, rank = np.unique(words, return_inverse=True)
        self.text_start = np.cumsum(sizes + 1) - (sizes + 1)  # in the sequence with separators
        place = np.arange(n) + np.repeat(np.arange(texts), sizes)
        sequence = np.empty(n + texts, dtype=np.int64)
        sequence[place] = rank + texts
        sequence[self.text_start + sizes] = np.arange(texts)
        order = suffix_array(sequence)
        before = sequence[order - 1]  # of the first word: the last separator
        symbols = np.maximum(before - texts + 1, 0)  # separators are symbol 0
        counts = np.bincount(symbols, minlength=len(self.kinds) + 1)
        self.begin = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletTree(symbols, len(self.kinds) + 1)
        text = np.repeat(np.arange(texts), sizes + 1)
        sampled = (np.arange(n + texts) - self.text_start[text]) % SAMPLE == 0
        hit = sampled[order]
        self.marked, self.samples = Bits(hit), order[hit]

    def symbol(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for words that the shard does not hold."""
        if not len(self.kinds):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.kinds, words), len(self.kinds) - 1)
        return np.where(self.kinds[at] == words, at + 1, 0)

    def whole(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffixes that begin with each symbol."""
        return self.begin[symbol], self.begin[symbol + 1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: ranges of each symbol followed by what the former ranges begin with."""
        return (self.begin[symbol] + self.tree.rank(symbol, low), self.begin[symbol] + self.tree.rank(symbol, high))

    def locate(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and word number in it of the suffixes in the given rows."""
        rows = rows.copy()
        steps = np.zeros(len(rows), dtype=np.int64)
        live = np.arange(len(rows))
        while len(live := live[~self.marked.get(rows[live])]):
            symbol, nth = self.tree.access(rows[live])
            rows[live] = self.begin[symbol] + nth
            steps[live] += 1
        place = self.samples[self.marked.rank(rows)] + steps
        text = np.searchsorted(self.text_start, place, side="right") - 1
        return text, place - self.text_start[text]
