"""Filter builders (F2, F4-F11): lists of Column predicates reduced with ``&``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def ok(df: DataFrame) -> DataFrame:
    """the ``quality = 'ok'`` gate."""
    return df.filter(F.col("quality") == "ok")


def listing_filters(gpu_types=(), providers=(), region_groups=(), is_spot=None) -> list[Column]:
    """multi-select IN lists plus a spot tri-state; an empty list means all."""
    preds = []
    if gpu_types:
        preds.append(F.col("gpu_type").isin(*gpu_types))
    if providers:
        preds.append(F.col("provider").isin(*providers))
    if region_groups:
        preds.append(F.col("region_group").isin(*region_groups))
    if is_spot is not None:
        preds.append(F.col("is_spot") == F.lit(bool(is_spot)))
    return preds


def optional_equals(**kv) -> list[Column]:
    """equality filters for the arguments that are given (falsy = no filter)."""
    return [F.col(k) == F.lit(v) for k, v in kv.items() if v]


def gpu_contains(pattern: str) -> Column:
    """case-insensitive substring match (``A10`` also hits ``A100``)."""
    return F.upper(F.col("gpu_type")).contains(pattern.upper())


def not_unknown_ci() -> Column:
    """exclude the unknown GPU, case-insensitively."""
    return F.upper(F.col("gpu_type")) != "UNKNOWN"


def market_base() -> Column:
    """F8: rows that describe a priced GPU offer."""
    return (F.col("gpu_count") > 0) & (F.col("price_per_hour") > 0) & (F.col("gpu_type") != "Unknown")
