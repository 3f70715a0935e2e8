"""Exact quantiles that never put a whole group in one task.

Spark's ``percentile``/``median`` keep, per group, a map of every distinct
value to its count and merge it in one task: a group holding a third of the
rows (or a global median) lands on one executor. Here the same exact answer
(linear interpolation between the ranks around ``p * (n - 1)``) is a selection
by rank over value counts that are written once, in ranges:

1. value counts per (group, value), combined map-side, then dealt into ranges
   of (group, value) whose bounds Spark samples from the counts, and written
   with the number of their range: a hot group lies in many ranges;
2. the totals per (group, range) -- at most groups + ranges rows -- and their
   running sum say which range holds each wanted rank;
3. only the (group, range) pairs that are hit are read again and ranked, with
   a window over one pair, so over a range at most.

One plan for every size. The table lies under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_table


def value_ranges(df: DataFrame, group_cols: list[str], value: Column | str) -> DataFrame:
    """(group, ``_v``, ``_c``, ``_part``): how often each value occurs, written once in ranges of (group, value)."""
    v = F.col(value) if isinstance(value, str) else value
    counts = (df.select(*group_cols, v.alias("_v")).filter(F.col("_v").isNotNull())
              .groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_c")))
    dealt = counts.repartitionByRange(*group_cols, "_v").sortWithinPartitions(*group_cols, "_v")
    return scratch_table(dealt.withColumn("_part", F.spark_partition_id()), "quantiles")


def _wanted(probs: list[float]) -> Column:
    """The two 0-based ranks around each position, with the place they take in the answer."""
    return F.array(*[
        F.struct(F.lit(2 * i + up).alias("at"), (F.ceil if up else F.floor)(F.lit(p) * (F.col("_n") - 1)).cast("long").alias("r"))
        for i, p in enumerate(probs) for up in (0, 1)])


def exact_quantiles(df: DataFrame, group_cols: list[str], value: Column | str, probs: list[float],
                    names: list[str] | None = None, count_name: str | None = None) -> DataFrame:
    """One row per group with one column per probability (``names`` or ``q<p>``),
    plus the number of non-NULL values as ``count_name`` when given.

    NULL values are ignored; a group with no values does not appear; a NULL group key is a group.
    """
    names = names or [f"q{str(p).replace('.', '_')}" for p in probs]
    g = list(group_cols)
    if not g:
        df, g = df.withColumn("_k", F.lit(0)), ["_k"]
    ranges = value_ranges(df, g, value)

    whole = Window.partitionBy(*g)
    upto = F.sum("_t").over(whole.orderBy("_part"))
    totals = ranges.groupBy(*g, "_part").agg(F.sum("_c").alias("_t")).select(
        *g, "_part", "_t", upto.alias("_upto"), F.sum("_t").over(whole).alias("_n"))
    hits = totals.withColumn("_want", F.filter(
        _wanted(probs), lambda x: (x["r"] >= F.col("_upto") - F.col("_t")) & (x["r"] < F.col("_upto"))))
    hits = hits.filter(F.size("_want") > 0).select(
        *[F.col(c).alias(f"_h_{c}") for c in g], F.col("_part").alias("_h_part"),
        (F.col("_upto") - F.col("_t")).alias("_before"), "_n", "_want")

    same = F.col("_part") == F.col("_h_part")
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    inside = Window.partitionBy(*g, "_part").orderBy("_v")
    ranked = ranges.join(hits, same).withColumn("_to", F.col("_before") + F.sum("_c").over(inside))
    at = ranked.select(*g, "_n", "_v", F.explode(F.filter(
        "_want", lambda x: (x["r"] >= F.col("_to") - F.col("_c")) & (x["r"] < F.col("_to")))).alias("_x"))
    found = at.groupBy(*g).agg(F.first("_n").alias("_n"), *[
        F.max(F.when(F.col("_x.at") == 2 * i + up, F.col("_v"))).alias(f"_v{i}_{up}")
        for i in range(len(probs)) for up in (0, 1)])
    cols = []
    for i, (p, n) in enumerate(zip(probs, names)):
        pos = F.lit(p) * (F.col("_n") - 1)
        low, high = F.col(f"_v{i}_0"), F.col(f"_v{i}_1")
        cols.append(F.when(low == high, low).otherwise((F.ceil(pos) - pos) * low + (pos - F.floor(pos)) * high).alias(n))
    if count_name:
        cols.append(F.col("_n").alias(count_name))
    return found.select(*group_cols, *cols)


def exact_median(df: DataFrame, group_cols: list[str], value: Column | str, name: str = "median",
                 count_name: str | None = None) -> DataFrame:
    return exact_quantiles(df, group_cols, value, [0.5], [name], count_name)
