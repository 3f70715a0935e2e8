"""Merge on read: deltas, folding, vacuum, and writers that fail between two writes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricepanel.operators import lake as K
from pricepanel.plans.pipeline import panel
from pricepanel.schema import LAKE_SCHEMA, LISTING_COLUMNS, LISTING_KEY
from pricepanel.sources import deltas as D
from pricepanel.sources.lake import scan_prices, write_lake
from pricepanel.sources.panel import old_vintage_rows


def _content(df):
    return sorted((tuple(r) for r in df.select(*LISTING_COLUMNS, "dt").collect()), key=repr)


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _between(p, first, last):
    return p.prices.filter((F.col("dt") >= F.lit(first).cast("date")) & (F.col("dt") < F.lit(last).cast("date")))


def test_a_late_key_writes_one_small_file_and_no_date_again(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    path = f"{tmpdir_path}/lake"
    write_lake(_between(p, "1995-01-01", "1996-01-01"), path, dynamic=False)
    before = _files(path)
    late = _between(p, "1995-03-01", "1995-04-01").limit(1).withColumns(
        {"instance_type": F.lit("late"), "price_per_hour": F.lit(9.5)})
    K.upsert_into_lake(spark, path, late)
    after = _files(path)
    assert {f: t for f, t in after.items() if f in before} == before and len(after) == len(before) + 1
    lake = scan_prices(spark, path)
    assert lake.filter("instance_type = 'late'").first().price_per_hour == 9.5
    assert lake.count() == _between(p, "1995-01-01", "1996-01-01").count() + 1
    # only the date with two sources is resolved by a window; another date is a plain scan
    plan = lake.filter("dt = '1995-07-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_deltas_before_and_after_folding_and_vacuum(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    path = f"{tmpdir_path}/lake"
    base = _between(p, "1995-01-01", "1995-07-01")
    write_lake(base, path, dynamic=False)
    want = {tuple(r[c] for c in LISTING_KEY): tuple(r) for r in base.select(*LISTING_COLUMNS, "dt").collect()}
    for k, (first, last) in enumerate([("1995-02-01", "1995-04-01"), ("1995-03-01", "1995-05-01"), ("1995-09-01", "1995-10-01")]):
        part = _between(p, first, last).withColumn("price_per_hour", F.lit(float(k)))
        want |= {tuple(r[c] for c in LISTING_KEY): tuple(r) for r in part.select(*LISTING_COLUMNS, "dt").collect()}
        K.upsert_into_lake(spark, path, part)
        assert _content(scan_prices(spark, path)) == sorted(want.values(), key=repr)
    K.compact(spark, path, "1995-03-01", "1995-03-31")
    assert _content(scan_prices(spark, path)) == sorted(want.values(), key=repr)
    K.upsert_into_lake(spark, path, _between(p, "1995-03-01", "1995-04-01").withColumn("price_per_hour", F.lit(7.0)))
    want = {k: v[:9] + (7.0,) + v[10:] if str(v[-1]) == "1995-03-01" else v for k, v in want.items()}
    assert _content(scan_prices(spark, path)) == sorted(want.values(), key=repr)
    K.compact(spark, path, "1995-01-01", "1995-12-31")
    assert D.vacuum(spark, path) > 0
    assert [x.kind for x in D.deltas(spark, path)] == [D.DATES] and not any(n.startswith("dt=") for n in os.listdir(path))
    assert _content(scan_prices(spark, path)) == sorted(want.values(), key=repr)
    assert D.vacuum(spark, path) == 0


def test_a_delta_without_its_marker_is_not_read(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    path = f"{tmpdir_path}/lake"
    write_lake(_between(p, "1995-01-01", "1995-02-01"), path, dynamic=False)
    before = _content(scan_prices(spark, path))
    K.upsert_into_lake(spark, path, _between(p, "1995-01-01", "1995-02-01").withColumn("price_per_hour", F.lit(0.5)))
    os.remove(f"{path}/_deltas/0000000001-rows/_SUCCESS")
    assert _content(scan_prices(spark, path)) == before
    K.upsert_into_lake(spark, path, _between(p, "1995-01-01", "1995-02-01").withColumn("price_per_hour", F.lit(0.25)))
    assert [x.number for x in D.deltas(spark, path)] == [2]  # the failed number is not used again
    assert {r[0] for r in scan_prices(spark, path).select("price_per_hour").distinct().collect()} == {0.25}


def test_an_absent_table_is_empty(spark, tmpdir_path):
    assert scan_prices(spark, f"{tmpdir_path}/none").collect() == []
    assert scan_prices(spark, f"{tmpdir_path}/none").schema == LAKE_SCHEMA
    assert K.read_manifest(spark, tmpdir_path).count() == 0 and D.vacuum(spark, f"{tmpdir_path}/none") == 0


class _Stop(Exception):
    pass


def _failing(monkeypatch, at):
    """Every write of a sink goes through add_delta: let the one numbered ``at`` and all after it fail."""
    calls = []

    def add(*a, **k):
        calls.append(a)
        if len(calls) > at:
            raise _Stop
        return D.add_delta(*a, **k)

    monkeypatch.setattr(K, "add_delta", add)


@pytest.mark.parametrize("at", [0, 1])
def test_publish_that_fails_between_two_writes(spark, tmpdir_path, monkeypatch, at):
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/pub"
    first, more = _between(p, "1995-01-01", "1995-04-01"), _between(p, "1995-01-01", "1995-06-01")
    assert K.publish_snapshots(spark, first, root) == 3
    _failing(monkeypatch, at)
    with pytest.raises(_Stop):
        K.publish_snapshots(spark, more, root)
    monkeypatch.undo()
    # a reader in between finds the published snapshots, each once
    assert sorted(r.timestamp.month for r in K.read_manifest(spark, root).collect()) == [1, 2, 3]
    # the next call gets another version of the snapshots whose first version was left half published
    changed = more.withColumn("price_per_hour", F.when(F.col("dt") >= F.lit("1995-04-01").cast("date"), 3.0)
                              .otherwise(F.col("price_per_hour"))).filter("instance_type < 's' or dt < '1995-04-01'")
    assert K.publish_snapshots(spark, changed, root) == 2 and K.publish_snapshots(spark, changed, root) == 0
    manifest = K.read_manifest(spark, root).collect()
    assert sorted(r.timestamp.month for r in manifest) == [1, 2, 3, 4, 5]
    assert _content(scan_prices(spark, f"{root}/prices")) == _content(changed)
    assert sum(r.row_count for r in manifest) == changed.count()
    assert K.verify_lake(spark, root).filter("not intact").count() == 0


@pytest.mark.parametrize("at", [0, 1])
def test_upgrade_that_fails_between_two_writes(spark, tmpdir_path, monkeypatch, at):
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/lake"
    old_vintage_rows(p.prices, "1995-04-01").write.partitionBy("dt").parquet(f"{root}/prices")
    K.publish_snapshots(spark, _between(p, "1995-04-01", "1995-07-01"), root)
    _failing(monkeypatch, at)
    with pytest.raises(_Stop):
        K.upgrade_lake(spark, root, p.regions)
    monkeypatch.undo()
    assert K.read_manifest(spark, root).count() == 3
    assert scan_prices(spark, f"{root}/prices").count() == _between(p, "1995-01-01", "1995-07-01").count()
    assert [d.month for d in K.upgrade_lake(spark, root, p.regions)] == [1, 2, 3]
    assert K.upgrade_lake(spark, root, p.regions) == []
    manifest = K.read_manifest(spark, root)
    assert manifest.count() == 6 and manifest.filter("backfilled").count() == 3
    assert manifest.agg(F.sum("row_count")).first()[0] == scan_prices(spark, f"{root}/prices").count()


def test_verify_names_the_snapshots_of_an_altered_file(spark, tmpdir_path):
    p = panel(spark, SF_SMALL)
    root = f"{tmpdir_path}/lake"
    K.publish_snapshots(spark, _between(p, "1995-01-01", "1995-05-01"), root)
    assert {r.intact for r in K.verify_lake(spark, root).collect()} == {True}
    # the same rows in other files and another order are intact
    K.compact(spark, f"{root}/prices", "1995-02-01", "1995-02-28")
    assert {r.intact for r in K.verify_lake(spark, root).collect()} == {True}
    folder = f"{root}/prices/_deltas/0000000001-rows/dt=1995-03-01"
    rows = spark.read.parquet(folder)
    spark.createDataFrame(rows.withColumn("gpu_count", F.col("gpu_count") + (F.col("instance_type") == rows.first().instance_type)
                                          .cast("int")).collect(), rows.schema).write.mode("overwrite").parquet(folder)
    assert [r.timestamp.month for r in K.verify_lake(spark, root).filter("not intact").collect()] == [3]
