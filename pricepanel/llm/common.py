"""Helpers the llm operators share: scratch tables, row folds and the batch tokeniser.

Scratch tables live under ``spark.checkpoint.dir`` (read from the session), so
they survive the loss of an executor and every machine can read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Word separators of the contracts: space and the controls 9 to 13.
SEPARATORS = b" \t\n\x0b\x0c\r"
IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[list(SEPARATORS)] = True
# Bytes that begin a code point in UTF-8.
IS_LEAD = (np.arange(256) & 0xC0) != 0x80

ARROW_ROWS = 1000
_CHUNK = 1 << 20
_SEGMENT = 1 << 16


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on after a task that needed much."""
    import ctypes
    import gc
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch: texts are long, and a worker holds a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def kept_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` once under ``folder`` and read it back: cuts the lineage at a durable table."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffled rows of a query go once it has ended."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    former = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.set(cleanup, former)


def in_ranges(rows: DataFrame, order: list[str], folder: str, name: str) -> DataFrame:
    """``rows`` written once in ranges of ascending ``order``, with ``part`` (number of the range) and ``place`` in it.

    The bounds are sampled from the data, and equal rows are dealt by a tie-break of their own, so that a range is
    bounded for any distribution of the keys."""
    dealt = (rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie")
             .sortWithinPartitions(*order, "_tie"))
    at = F.monotonically_increasing_id()  # the partition above 33 bits of the row's place in it
    dealt = dealt.select(*rows.columns, F.shiftright(at, 33).alias("part"),
                         at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    with shuffles_dropped(rows.sparkSession):
        return kept_table(dealt, folder, name)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


# --- words of a batch of texts ------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_SYMBOL = _RNG.integers(0, 2**64, size=256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C13)  # odd, 3 modulo 8
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {}


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, _SEGMENT), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of some texts, in order: 64-bit hash, text number and byte range in ``data``."""

    __slots__ = ("data", "buffer", "doc", "hash", "start", "end", "doc_start", "n_docs")

    def __init__(self, texts: list[bytes]):
        self.n_docs = len(texts)
        self.data = b" ".join(texts)
        self.buffer = np.frombuffer(self.data, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.doc_start = np.concatenate([[0], np.cumsum(sizes + 1)])[:len(texts)]
        inside = np.zeros(len(self.buffer) + 2, dtype=np.int8)
        inside[1:-1] = ~IS_SEPARATOR[self.buffer]
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1
        self.hash = self._hashes(self.start, self.end - self.start)

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words longer than ``k`` bytes, and the hashes of their first ``k``."""
        long = np.flatnonzero(self.end - self.start > k)
        return long, self._hashes(self.start[long], np.full(len(long), k, dtype=np.int64))

    def _hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges in order, by differences of one running sum: symbols times powers of their places."""
        out = np.empty(len(size), dtype=np.uint64)
        end = start + size
        lo = 0
        while lo < len(size):  # a bounded number of bytes at a time
            first = start[lo]
            hi = max(lo + 1, int(np.searchsorted(end, first + _SEGMENT, side="right")))
            n = int(end[hi - 1] - first)
            upto = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_SYMBOL[self.buffer[first:first + n]] * _powers(n), out=upto[1:])
            begin = start[lo:hi] - first
            out[lo:hi] = (upto[end[lo:hi] - first] - upto[begin]) * _powers(int(begin[-1]) + 1, _INVERSE)[begin]
            lo = hi
        return mixed(out)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``k`` consecutive words inside one text, and each one's first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        g = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            g = g * _BASE + self.hash[j:j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:k - 1 + n])
        return mixed(g[at]), at


def byte_texts(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = _CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is a range of its own."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)
