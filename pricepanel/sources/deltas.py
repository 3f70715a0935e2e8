"""Merge on read: numbered deltas beside a table that is partitioned by ``dt``.

``<table>/_deltas/<number>-<kind>/dt=...`` holds what was written after the base
(``<table>/dt=...``; Spark's readers pass over names with an underscore). A delta
of kind ``rows`` adds rows or replaces those of the same key; one of kind
``dates`` replaces whole dates, older deltas included. A delta counts once its
commit marker is there, so a writer that fails leaves nothing behind that a
reader sees, and nothing is ever overwritten in place.

Readers resolve only the dates that have more than one source, by a window over
the key; every other date is a plain partition scan. ``fold`` writes resolved
dates as one ``dates`` delta, ``vacuum`` deletes what no reader uses any more.
One writer at a time; the dates of a table are bounded by the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import sized_tasks

ROWS, DATES = "rows", "dates"


@dataclass(frozen=True)
class Delta:
    number: int
    kind: str
    path: str
    dates: frozenset[str]


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _dates(names: list[str]) -> frozenset[str]:
    return frozenset(n.removeprefix("dt=") for n in names if n.startswith("dt="))


def deltas(spark: SparkSession, path: str) -> list[Delta]:
    """The complete deltas of a table, in the order they were written."""
    out = []
    for name in _names(spark, f"{path}/_deltas"):
        inside = _names(spark, f"{path}/_deltas/{name}")
        if "_SUCCESS" in inside:
            number, kind = name.split("-")
            out.append(Delta(int(number), kind, f"{path}/_deltas/{name}", _dates(inside)))
    return out


def add_delta(rows: DataFrame, path: str, kind: str, cluster: tuple[str, ...] = ()) -> None:
    """Write ``rows`` (with ``dt``) as the next delta. Tasks are sized from the data; a hot date is split."""
    spark = rows.sparkSession
    number = max([int(n.split("-")[0]) for n in _names(spark, f"{path}/_deltas")], default=0) + 1
    with sized_tasks(spark):
        (rows.hint("rebalance", "dt").sortWithinPartitions("dt", *cluster).write.option("compression", "zstd")
         .partitionBy("dt").parquet(f"{path}/_deltas/{number:010d}-{kind}"))


def _sources(spark: SparkSession, path: str) -> dict[str, list[tuple[int, str]]]:
    """Per date where its rows are: (number, folder); number 0 is the base."""
    held = {d: [(0, path)] for d in _dates(_names(spark, path))}
    for x in deltas(spark, path):
        for d in x.dates:
            held[d] = [(x.number, x.path)] if x.kind == DATES else held.get(d, []) + [(x.number, x.path)]
    return held


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_sources(spark, path))


def read_table(spark: SparkSession, path: str, schema: StructType, key: list[str], merge_schema: bool = False) -> DataFrame:
    """The table as of now: of the rows of one key those of the newest delta (all of them, if it holds several).

    ``merge_schema`` reads the base with the columns its files have instead of the declared ones."""
    held = _sources(spark, path)
    if not held:
        return spark.createDataFrame([], schema)
    base = spark.read.option("mergeSchema", "true") if merge_schema else spark.read.schema(schema)
    folders = sorted({s for sources in held.values() for s in sources})
    if folders == [(0, path)]:
        return base.parquet(path)

    def of(number: int, folder: str, dates: list[str]) -> DataFrame:
        df = (base if number == 0 else spark.read.schema(schema)).parquet(folder)
        return df.filter(F.col("dt").isin([F.lit(d).cast("date") for d in dates]))

    alone, mixed = [], []
    for number, folder in folders:
        own = sorted(d for d, sources in held.items() if (number, folder) in sources)
        single = [d for d in own if len(held[d]) == 1]
        shared = [d for d in own if len(held[d]) > 1]
        if single:
            alone.append(of(number, folder, single))
        if shared:
            mixed.append(of(number, folder, shared).withColumn("_delta", F.lit(number)))
    if mixed:
        newest = F.max("_delta").over(Window.partitionBy(*key))
        alone.append(_union(mixed).withColumn("_newest", newest).filter("_delta = _newest").drop("_delta", "_newest"))
    return _union(alone)


def fold(spark: SparkSession, path: str, schema: StructType, key: list[str], first: str, last: str,
         cluster: tuple[str, ...] = ()) -> None:
    """Write the dates from ``first`` to ``last`` anew, resolved and in fewer files, as one delta of whole dates."""
    rows = read_table(spark, path, schema, key).filter(F.col("dt").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    add_delta(rows, path, DATES, cluster)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete deltas and base dates that newer whole dates replace, and deltas a failed writer left; not while one writes."""
    held = _sources(spark, path)
    used = {s for sources in held.values() for s in sources}
    gone = [f"{path}/dt={d}" for d in _dates(_names(spark, path)) if (0, path) not in held[d]]
    gone += [f"{path}/_deltas/{n}" for n in _names(spark, f"{path}/_deltas")
             if (int(n.split("-")[0]), f"{path}/_deltas/{n}") not in used]
    for x in gone:
        fs, p = _folder(spark, x)
        fs.delete(p, True)
    return len(gone)
