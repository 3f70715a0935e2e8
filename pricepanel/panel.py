"""``Panel``: the canonical listing view plus the two small frames queries need.

* ``prices``    – canonical listings (S2), lazily scanned from the lake.
* ``regions``   – the (provider, raw_region) dimension, size-checked for broadcast.
* ``snapshots`` – the manifest, one row per snapshot; "latest" and lookback
  anchors come from it as scalar subqueries, so the big table is scanned
  once per query and its ``dt`` partitions are pruned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Panel:
    prices: DataFrame
    regions: DataFrame
    snapshots: DataFrame

    @staticmethod
    def from_frames(prices: DataFrame, regions: DataFrame, snapshots: DataFrame | None = None) -> "Panel":
        if snapshots is None:
            snapshots = prices.groupBy("timestamp").agg(F.count(F.lit(1)).alias("row_count"))
        return Panel(prices, regions, snapshots)

    # -- anchors ---------------------------------------------------------
    def max_ts(self) -> Column:
        """Newest snapshot over all rows, before any filter."""
        return self.snapshots.select(F.max("timestamp")).scalar()

    def anchor(self, as_of=None) -> Column:
        """Lookback anchor: the data max by default, or an explicit instant (D3)."""
        return self.max_ts() if as_of is None else F.lit(as_of).cast("timestamp")

    # -- F1 / F3: the two time predicates ---------------------------------
    def latest(self) -> DataFrame:
        """the newest snapshot. The ``dt`` predicate prunes partitions."""
        mx = self.max_ts()
        p = self.prices
        if "dt" in p.columns:
            p = p.filter(F.col("dt") == F.to_date(mx))
        return p.filter(F.col("timestamp") == mx)

    def since(self, days: int, as_of=None, inclusive_end: bool = False) -> DataFrame:
        """Rows with ``timestamp >= anchor - days``.

        Emits a matching ``dt`` bound as well, which Spark cannot derive from
        the timestamp predicate on its own.
        """
        lo = self.anchor(as_of) - F.make_dt_interval(F.lit(days))
        p = self.prices
        if "dt" in p.columns:
            p = p.filter(F.col("dt") >= F.to_date(lo))
        return p.filter(F.col("timestamp") >= lo)
