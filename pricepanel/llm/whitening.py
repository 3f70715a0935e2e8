"""Embedding whitening by spectrum slicing.

An entry c of a vector becomes the integer x = floor(1024 c) + 100000. Spark
sums the vectors (n and S), then the products of y = x - round(S / n): both are
sums of integers, so the covariance is the exact quotient rounded once,
whatever the order of the tasks. It has one row a dimension; its leading
eigenpairs come from ``spectrum``. Each vector is projected in the task that
reads it; the covariance of the projections (``covar_pop``, centred) is
compared with the identity.

Defined results: null vectors and vectors with null or non-finite entries are
dropped (of neither the fit list nor the result); entries beyond 2**52 after
scaling count as 2**52; a vector shorter than the longest counts as zero in the
entries it lacks; components are only those whose eigenvalue is above rounding
(n = 1, or equal vectors: none, so no rows); a deviation over 63 bits is null;
rows with null or equal vec_id are kept as they are; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, kept_table, scratch
from .spectrum import leading

COMPONENTS = 8
_BASE = 100_000
_MOST = 1 << 52
_EXACT = 1 << 53  # integers below are exact in a double


def _usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def _scaled(column, dims: int) -> np.ndarray:
    """x of the vectors of an Arrow list column, one row each."""
    size = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), dims))
    out[np.arange(dims) < size[:, None]] = flat
    with np.errstate(over="ignore"):
        return np.clip(np.floor(1024.0 * out), -_MOST, _MOST).astype(np.int64) + _BASE


def _sums(vectors: DataFrame, dims: int) -> list[tuple[int, int, int]]:
    """(dimension, sum of x, n) of each dimension."""

    def run(batches):
        import pyarrow as pa
        total, n = [0] * dims, 0
        for b in batches:
            total = [a + s for a, s in zip(total, _scaled(b.column(0), dims).sum(axis=0).tolist())]
            n += b.num_rows
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()), "s": [str(x) for x in total],
                                          "n": pa.array([n] * dims, pa.int64())})

    wide = "decimal(38,0)"
    rows = vectors.select("v").mapInArrow(run, "i int, s string, n long").groupBy("i").agg(
        F.sum(F.col("s").cast(wide)).cast("string").alias("s"), F.sum("n").alias("n")).collect()  # a row a dimension
    return sorted((r.i, int(r.s), r.n) for r in rows)


def _products(z: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of integers, as Python integers."""
    most = int(np.abs(z).max()) if z.size else 0
    if most ** 2 >= _EXACT:
        z = z.astype(object)
        return z.T @ z
    step = max(1, _EXACT // max(1, most ** 2) - 1)
    out = np.zeros((z.shape[1], z.shape[1]), dtype=object)
    for lo in range(0, len(z), step):
        part = z[lo:lo + step].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def _covariance(vectors: DataFrame, sums: list[int], n: int) -> np.ndarray:
    """The covariance of x, divisor n: exact integers, divided once."""
    dims = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    upper = np.triu_indices(dims)

    def run(batches):
        import pyarrow as pa
        total = np.zeros((dims, dims), dtype=object)
        for b in batches:
            total = total + _products(_scaled(b.column(0), dims) - centre)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()), "s": [str(x) for x in total[upper]]})

    rows = vectors.select("v").mapInArrow(run, "i int, j int, s string").groupBy("i", "j").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect()  # dims * (dims + 1) / 2 numbers
    off = [s - n * int(c) for s, c in zip(sums, centre)]  # sums of y
    out = np.zeros((dims, dims))
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = (n * int(r.s) - off[r.i] * off[r.j]) / (n * n)
    return out


def _deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Exact sums of (n x - S)**2; None over 63 bits."""
    most = max((max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(x.min(axis=0), x.max(axis=0), sums)),
               default=0)
    if most ** 2 * len(sums) < 1 << 63:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    z = n * x.astype(object) - np.array(sums, dtype=object)
    return [k if k < 1 << 63 else None for k in (z * z).sum(axis=1).tolist()]


def _projected(vectors: DataFrame, sums: list[int], n: int, axes: np.ndarray) -> DataFrame:
    """vec_id, deviation and the whitened coordinates ``w`` of every vector."""
    dims = len(sums)
    centre = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x = _scaled(b.column(1), dims)
            w = ((x - centre) - rest) @ axes
            ends = pa.array(np.arange(len(w) + 1) * axes.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(_deviations(x, sums, n), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))], ["vec_id", "deviation", "w"])

    return vectors.mapInArrow(run, "vec_id long, deviation long, w array<double>")


def _identity_error(rows: DataFrame, many: int) -> float:
    pairs = [(i, j) for i in range(many) for j in range(i, many)]
    got = rows.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
             folder: str | None = None) -> DataFrame:
    """One row for each remaining vector and component."""
    spark = table.sparkSession
    vectors = _usable(table, id_col, vector_col)
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    found = _sums(vectors, dims) if dims else []
    n = found[0][2] if found else 0
    if not n:
        return spark.createDataFrame([], _RESULT)
    sums = [s for _, s, _ in found]
    covariance = _covariance(vectors, sums, n)
    pairs = leading(covariance, components)
    if not pairs:
        return spark.createDataFrame([], _RESULT)
    axes = np.stack([v / e ** 0.5 for e, v in pairs], axis=1)
    trace = float(np.trace(covariance))
    rows = kept_table(_projected(vectors, sums, n, axes), folder or scratch(spark, "whitening"), "projected")
    error = _identity_error(rows, len(pairs))
    explained = F.array(*[F.lit(e / trace) for e, _ in pairs])
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))


def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable row of ``embeddings``."""
    arrow_batches(spark)
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
