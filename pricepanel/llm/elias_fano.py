"""Elias-Fano sequences as plain arrays that are memory-mapped, queried a batch at a time.

A non-decreasing sequence of n numbers below u is kept as n packed low parts of
l = log2(u / n) bits, and its high parts in unary in a bit vector of about 2n
bits; a count of ones before every 64-bit word serves rank and select. Arrays
are ``.npy`` files, or lie together in one ``.arrays`` file: mapped from a mounted
folder, or fetched through ``pyarrow.fs`` from any other store.
"""

from __future__ import annotations

import io
import json
import mmap
import os
import sys
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

import numpy as np

_ONE = np.uint64(1)
_SIX = np.uint64(6)
_LOW6 = np.uint64(63)
_ALIGNED = 64
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}  # a map needs no open file


def _local(uri: str) -> str | None:
    """The path of a folder that is mounted on this machine, None for another store."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return parts.path if parts.scheme else uri
    return None


def save_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write one array; it appears whole or not at all, so a task may be tried again."""
    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, values)
        os.replace(part, f"{path}/{name}.npy")
        return
    import pyarrow.fs as fs
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    data = io.BytesIO()
    np.save(data, values)
    with store.open_output_stream(f"{path}/{name}.npy") as f:
        f.write(data.getvalue())


def load_array(folder: str, name: str) -> np.ndarray:
    path = _local(folder)
    if path is not None:
        return np.asarray(np.load(f"{path}/{name}.npy", mmap_mode="r"))
    import pyarrow.fs as fs
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}.npy") as f:
        return np.load(io.BytesIO(f.read()))


def _padded(size: int) -> int:
    return -(-size // _ALIGNED) * _ALIGNED


def save_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write some arrays as one file; it appears whole or not at all, so a task may be tried again."""
    shapes, at = {}, 0
    for key, v in arrays.items():
        shapes[key] = v.dtype.str, len(v), at
        at += _padded(v.nbytes)
    head = json.dumps(shapes).encode()
    first = _padded(8 + len(head))
    head = first.to_bytes(8, "little") + head.ljust(first - 8)

    def write(f) -> None:
        f.write(head)
        for v in arrays.values():
            f.write(memoryview(np.ascontiguousarray(v)).cast("B") if len(v) else b"")
            f.write(bytes(_padded(v.nbytes) - v.nbytes))

    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            write(f)
        os.replace(part, f"{path}/{name}.arrays")
        return
    import pyarrow.fs as fs
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}.arrays") as f:
        write(f)


class Arrays:
    """The arrays of one file by name: mapped together, or each fetched from another store when it is asked for."""

    def __init__(self, folder: str, name: str):
        path = _local(folder)
        if path is not None:
            with open(f"{path}/{name}.arrays", "rb") as f:
                whole = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED))
            self._read = lambda at, size: whole[at:at + size]
        else:
            import pyarrow.fs as fs
            store, path = fs.FileSystem.from_uri(folder)

            def read(at: int, size: int) -> bytes:
                with store.open_input_file(f"{path}/{name}.arrays") as f:
                    return f.read_at(size, at)

            self._read = read
        self._first = int.from_bytes(self._read(0, 8), "little")
        self._shapes = json.loads(bytes(self._read(8, self._first - 8)))
        self._got: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        got = self._got.get(name)
        if got is None:
            kind, n, at = self._shapes[name]
            kind = np.dtype(kind)
            got = np.frombuffer(self._read(self._first + at, n * kind.itemsize), dtype=kind) if n else np.empty(0, kind)
            self._got[name] = got
        return got


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width``-bit numbers, one after another, in 64-bit words (and one word to spare)."""
    words = np.zeros(len(values) * width // 64 + 2, dtype=np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> _SIX).astype(np.int64), at & _LOW6
        np.bitwise_or.at(words, word, values << shift)
        over = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpack(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), dtype=np.uint64)
    at = index * width
    word, shift = at >> 6, (at & 63).view(np.uint64)
    low = words[word] >> shift
    # a shift by 64 is not defined: shift by 63 and then by one
    high = (words[word + 1] << (_LOW6 - shift)) << _ONE
    return (low | high) & np.uint64((1 << width) - 1)


# place of the k-th one of a byte at [byte * 8 + k]
_IN_BYTE = np.zeros(256 * 8, dtype=np.int64)
for _byte in range(256):
    for _k, _bit in enumerate([i for i in range(8) if _byte >> i & 1]):
        _IN_BYTE[_byte * 8 + _k] = _bit
_EACH = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_HINT_BITS = 4  # a select hint has an entry for every 16th one (or zero)
_STEPS = 4  # words looked at after a hint before a binary search


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each 64-bit word: by sums over its bytes, then a table."""
    k = k.view(np.uint64)
    two = np.uint64(0x3333333333333333)
    upto = word - ((word >> _ONE) & np.uint64(0x5555555555555555))
    upto = (upto & two) + ((upto >> np.uint64(2)) & two)
    upto = ((upto + (upto >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH  # byte i: ones in bytes 0 to i
    # bytes whose ones all come before the k-th
    shift = np.bitwise_count((((k * _EACH) | _TOP) - upto) & _TOP).astype(np.uint64) << np.uint64(3)
    before = ((upto << np.uint64(8)) >> shift) & np.uint64(255)
    byte = (word >> shift) & np.uint64(255)
    return shift.view(np.int64) + _IN_BYTE[((byte << np.uint64(3)) | (k - before)).view(np.int64)]


def _least(values: np.ndarray) -> np.ndarray:
    """Non-negative numbers in 32 bits where they fit: half the bytes to keep and to look up."""
    return values.astype(np.uint32) if not len(values) or int(values.max()) >> 32 == 0 else values


def _hints(before: np.ndarray, total: int) -> np.ndarray:
    """The word that holds every 16th one, by the ones before each word (the last entry closes)."""
    return _least(np.searchsorted(before, np.arange(0, total, 1 << _HINT_BITS), side="right") - 1)


def _word_with(ones: np.ndarray, hint: np.ndarray, k: np.ndarray, zeros: bool = False) -> np.ndarray:
    """The word that holds the k-th one (or zero): from its hint on, and by binary search where that is far.

    ``ones`` counts the ones before each word; the zeros before it are the other bits."""
    word = hint[k >> _HINT_BITS].astype(np.int64)

    def passed(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        after = word + 1  # there is one: the last word is to spare
        return np.flatnonzero((after << 6) - ones[after] <= k if zeros else ones[after] <= k)

    live = passed(word, k)
    for _ in range(_STEPS):
        if not len(live):
            return word
        word[live] += 1
        live = live[passed(word[live], k[live])]
    if len(live):
        before = np.arange(len(ones), dtype=np.int64) * 64 - ones if zeros else ones
        word[live] = np.searchsorted(before, k[live], side="right") - 1
    return word


class EliasFano:
    """``size`` non-decreasing numbers below ``universe``."""

    def __init__(self, size: int, universe: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray,
                 one_at: np.ndarray | None, zero_at: np.ndarray | None):
        self.size, self.universe = size, universe
        self.width = self._width(size, universe)
        self.low, self.high, self.ones, self.one_at, self.zero_at = low, high, ones, one_at, zero_at

    @staticmethod
    def _width(size: int, universe: int) -> int:
        return max(0, (max(1, universe) // max(1, size)).bit_length() - 1)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        width = cls._width(len(values), universe)
        top = (max(1, universe) >> width) + 1
        bits = np.zeros((len(values) + top) // 64 + 2, dtype=np.uint64)
        at = (values >> np.uint64(width)) + np.arange(len(values), dtype=np.uint64)
        np.bitwise_or.at(bits, (at >> _SIX).astype(np.int64), _ONE << (at & _LOW6))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)[:-1]])
        low = _pack(values & np.uint64((1 << width) - 1), width)
        zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones
        return cls(len(values), universe, low, bits, _least(ones), _hints(ones, len(values)), _hints(zeros, 64 * len(bits) - len(values)))

    def arrays(self, name: str, get: bool = True, find: bool = True) -> dict[str, np.ndarray]:
        """What is kept of the sequence, with the hints for ``get`` (and ``neighbours``), for ``find``, or for both."""
        return ({f"{name}_low": self.low, f"{name}_high": self.high, f"{name}_ones": self.ones}
                | ({f"{name}_one_at": self.one_at} if get else {}) | ({f"{name}_zero_at": self.zero_at} if find else {})
                | {f"{name}_shape": np.array([self.size, self.universe, get, find], dtype=np.uint64)})

    def save(self, folder: str, name: str, get: bool = True, find: bool = True) -> None:
        for key, values in self.arrays(name, get, find).items():
            save_array(folder, key, values)

    @classmethod
    def kept(cls, array: Callable[[str], np.ndarray], name: str) -> EliasFano:
        """The sequence whose ``arrays`` are given by name."""
        size, universe, get, find = map(int, array(f"{name}_shape"))
        low, high, ones = (array(f"{name}_{x}") for x in ("low", "high", "ones"))
        return cls(size, universe, low, high, ones, array(f"{name}_one_at") if get else None,
                   array(f"{name}_zero_at") if find else None)

    @classmethod
    def load(cls, folder: str, name: str) -> EliasFano:
        return cls.kept(lambda key: load_array(folder, key), name)

    def _place(self, index: np.ndarray) -> np.ndarray:
        """Bits of the ones of the numbers at the given places."""
        word = _word_with(self.ones, self.one_at, index)
        return (word << 6) + _select_in_word(self.high[word], index - self.ones[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        return self._value(index, self._place(index))

    def _value(self, index: np.ndarray, place: np.ndarray) -> np.ndarray:
        return ((place - index).view(np.uint64) << np.uint64(self.width)) | _unpack(self.low, index, self.width)

    def neighbours(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at the given places and at the places after them."""
        place = self._place(index)
        # the next one mostly lies in the same word
        rest = (self.high[place >> 6] >> (place & 63).view(np.uint64)) >> _ONE
        after = place + 1 + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        far = np.flatnonzero(rest == 0)
        after[far] = self._place(index[far] + 1)
        return self._value(index, place), self._value(index + 1, after)

    def _bucket(self, top: np.ndarray) -> np.ndarray:
        """Bit after the zero that closes the numbers with high parts below ``top``."""
        k = np.maximum(top - 1, 0)
        word = _word_with(self.ones, self.zero_at, k, zeros=True)
        place = (word << 6) + _select_in_word(~self.high[word], k - ((word << 6) - self.ones[word]))
        return np.where(top > 0, place + 1, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number equal to each value, -1 where there is none."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not self.size:
            return out
        values = values.astype(np.uint64, copy=False)
        live = np.flatnonzero(values < np.uint64(min(self.universe, 2**64 - 1)))
        if len(live) < len(values):
            values = values[live]
        top = (values >> np.uint64(self.width)).view(np.int64)
        low = values & np.uint64((1 << self.width) - 1)
        place = self._bucket(top)
        index = place - top
        while len(live):  # successor search among the numbers of equal high part; no ones follow the last number
            on = np.flatnonzero((self.high[place >> 6] >> (place & 63).view(np.uint64)) & _ONE)
            if len(on) < len(live):
                live, place, index, low = live[on], place[on], index[on], low[on]
            have = _unpack(self.low, index, self.width)
            same = np.flatnonzero(have == low)
            out[live[same]] = index[same]
            on = np.flatnonzero(have < low)
            live, place, index, low = live[on], place[on] + 1, index[on] + 1, low[on]
        return out
