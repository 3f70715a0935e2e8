"""The lake is built with one move of its rows, and tasks are sized by the data, not by the session."""

import io
import os
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricepanel import session
from pricepanel.operators import lake as K
from pricepanel.plans import pipeline
from pricepanel.schema import LISTING_COLUMNS
from pricepanel.sources.deltas import ROWS, add_delta, read_table
from pricepanel.sources.lake import scan_prices, write_lake
from pricepanel.sources.panel import F1_SEQUENCE, listing_panel_raw
from pricepanel.streaming import snapshots as st

SIZES = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
         "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]


def _conf(spark):
    return [spark.conf.get(k, None) for k in SIZES + ["spark.sql.shuffle.partitions"]]


def _listings(spark, n: int):
    i = F.col("id")
    made = {"timestamp": F.lit("2024-01-01").cast("timestamp"), "provider": F.concat(F.lit("p"), i % 3),
            "instance_type": F.concat(F.lit("i"), i), "gpu_type": F.concat(F.lit("g"), i % 50), "region": F.lit("r"),
            "price_per_hour": F.rand(7), "is_spot": i % 2 == 0}
    kinds = {f.name: f.dataType for f in K.LAKE_SCHEMA}
    return spark.range(0, n, 1, 8).select(*[made.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in LISTING_COLUMNS])


def _files(folder):
    return [f for f in os.listdir(folder) if f.startswith("part-")]


def test_lake_build_moves_rows_once(spark, tmpdir_path, monkeypatch):
    taken, write = [], pipeline.write_lake
    monkeypatch.setattr(pipeline, "write_lake", lambda df, *a, **k: (taken.append((df, k)), write(df, *a, **k)))
    before = _conf(spark)
    root = pipeline.build_lake(spark, SF_SMALL, "listings", f"{tmpdir_path}/lake")
    df, how = taken[0]
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    assert "rangepartitioning(timestamp" in text.getvalue()
    assert "hashpartitioning(timestamp" not in text.getvalue()
    assert how["in_ranges"] and how["input_bytes"] > 0
    assert _conf(spark) == before
    columns = ["timestamp", "provider", "instance_type", "gpu_type", "region", "is_spot", "price_per_hour", "available"]
    rows = lambda x: sorted((tuple(r) for r in x.select(*columns).collect()), key=repr)
    assert rows(scan_prices(spark, f"{root}/prices")) == rows(K.dedupe_latest(listing_panel_raw(spark, SF_SMALL), F1_SEQUENCE))


def test_shuffles_start_with_partitions_by_input(spark):
    before = _conf(spark)
    with session.sized_tasks(spark, 1000 * session.INPUT_BYTES):
        assert _conf(spark)[:3] == ["1000", str(session.TASK_BYTES), str(session.TASK_BYTES)]
    assert _conf(spark) == before
    with session.sized_tasks(spark):
        assert _conf(spark)[0] == before[3]


def test_a_hot_date_is_written_by_many_tasks(spark, tmpdir_path, monkeypatch):
    rows = _listings(spark, 40_000)
    monkeypatch.setattr(session, "TASK_BYTES", 64 << 10)
    write_lake(rows, f"{tmpdir_path}/lake", dynamic=False)
    assert len(_files(f"{tmpdir_path}/lake/dt=2024-01-01")) > 2
    add_delta(rows.withColumns({"price_per_hour": F.lit(2.0), "dt": F.to_date("timestamp")}), f"{tmpdir_path}/lake", ROWS)
    delta = f"{tmpdir_path}/lake/_deltas/{1:010d}-rows/dt=2024-01-01"
    assert len(_files(delta)) > 2
    now = read_table(spark, f"{tmpdir_path}/lake", K.LAKE_SCHEMA, K.LISTING_KEY)
    assert now.count() == 40_000 and now.filter("price_per_hour = 2.0").count() == 40_000


def test_state_partitions_do_not_follow_the_session(spark, tmpdir_path):
    rows = _listings(spark, 300).withColumns({"seq_a": F.lit(1), "seq_b": F.col("price_per_hour")})
    land, sink, ck = f"{tmpdir_path}/landing", f"{tmpdir_path}/dedupe", f"{tmpdir_path}/ck"
    twice = rows.unionByName(rows.withColumns({"seq_b": F.col("seq_b") + 1, "gpu_count": F.lit(4)}))
    twice.write.parquet(land)
    with session.settings(spark, {"spark.sql.shuffle.partitions": "12"}):
        st.run_dedupe_stream(spark, land, sink, ck, ["seq_a", "seq_b"], state_partitions=3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "12"
    assert sorted(x for x in os.listdir(f"{ck}/state/0") if x.isdigit()) == ["0", "1", "2"]
    got = spark.read.parquet(sink)
    assert got.count() == 300 and got.filter("gpu_count = 4").count() == 300
    # what a batch hands on is staged once, so the plan with state does not run again for each use
    assert os.path.exists(f"{ck}_staging/0_changed/_SUCCESS")
