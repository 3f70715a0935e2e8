"""Plan properties the design relies on at scale (checked on the formatted explain)."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return entry.queries()


def test_latest_prunes_partitions_and_pushes_filter(spark, q):
    txt = plan(q["latest_snapshot"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(dt" in txt and "Subquery subquery" in txt
    assert "EqualTo(timestamp,ScalarSubquery" in txt


def test_lookback_prunes_partitions_and_drops_unused_join(spark, q):
    txt = plan(q["trends_daily"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(dt" in txt
    assert "Join" not in txt                       # region columns unused -> enrichment join removed


def test_scan_reads_only_needed_columns(spark, q):
    txt = plan(q["headline"](spark, SF_SMALL))
    schema = [line for line in txt.splitlines() if line.startswith("ReadSchema")][0]
    assert "ram_gb" not in schema and "availability_zone" not in schema


def test_dedupe_limits_per_key_before_shuffle(spark):
    from pricepanel.operators.lake import dedupe_latest
    from pricepanel.sources.panel import F1_SEQUENCE, listing_panel_raw
    txt = plan(dedupe_latest(listing_panel_raw(spark, SF_SMALL), F1_SEQUENCE))
    assert "WindowGroupLimit" in txt and "Partial" in txt


def test_no_cross_or_nested_loop_joins(spark, q):
    for name in ["best_deals_batch", "gpu_metro_matrix", "provider_corr", "trend_day_guard", "concentration",
                 "latest_kpi", "resolve_regions", "within_day_fill"]:
        txt = plan(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, name


def test_spread_join_is_on_four_keys(spark, q):
    txt = plan(q["spot_spread"](spark, SF_SMALL))
    joins = [line for line in txt.splitlines() if line.startswith("Left keys")]
    assert joins and all(line.count("#") == 4 for line in joins)


def test_registered_queries_configure_a_foreign_session(spark):
    """A cluster passes its own session: the settings the operators rely on
    (UTC, AQE, skew join, RocksDB state store) are applied by the query itself."""
    from pricepanel.session import REQUIRED_CONF
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    entry.queries()["collection_cadence"](spark, SF_SMALL)
    for k, v in REQUIRED_CONF.items():
        assert spark.conf.get(k) == v, k
