"""Batch result == stream result; replaying a batch changes nothing (ST1-ST3)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricepanel.plans.pipeline import panel
from pricepanel.schema import LISTING_COLUMNS
from pricepanel.sources.panel import events_panel_raw
from pricepanel.streaming import snapshots as st


def _rows(df):
    return sorted((tuple(r) for r in df.select(*LISTING_COLUMNS).collect()), key=repr)


def test_stream_equals_batch_and_replay_is_noop(spark, tmpdir_path):
    raw = events_panel_raw(spark, SF_SMALL)
    ev = panel(spark, SF_SMALL, "events")
    land, target, ck = f"{tmpdir_path}/landing", f"{tmpdir_path}/target", f"{tmpdir_path}/ck"
    run = lambda: st.run_ingest_stream(spark, land, target, ck,
                                       lambda b: st.prepare_listings(b, ev.regions), ["seq_a", "seq_b"])
    st.land_in_halves(spark, raw, land, F.lit("2024-01-15").cast("timestamp"), [run])
    streamed = _rows(st.read_stream_target(spark, target))
    assert streamed == _rows(ev.prices)
    run()                                       # nothing new landed: no change
    assert _rows(st.read_stream_target(spark, target)) == streamed
    # replay one batch by hand: the keyed upsert is idempotent
    batch = st.prepare_listings(spark.read.parquet(land).filter(F.col("timestamp") < F.lit("2024-01-05")
                                                                 .cast("timestamp")), ev.regions)
    st.upsert_batch(spark, batch, target, f"{tmpdir_path}/replay", ["seq_a", "seq_b"])
    assert _rows(st.read_stream_target(spark, target)) == streamed


def _summaries(spark, sink):
    return {r.window_start: tuple(r)[1:] for r in st.read_summary_sink(spark, sink).collect()}


def _expected(rows):
    got = rows.groupBy("timestamp").agg(
        F.count("*").alias("n"), F.count_distinct("provider").alias("p"), F.count_distinct("gpu_type").alias("g"),
        F.min("price_per_hour").alias("lo"), F.max("price_per_hour").alias("hi"), F.round(F.avg("price_per_hour"), 6).alias("m"))
    return {r.timestamp: (r.n, r.p, r.g, r.lo, r.hi, r.m) for r in got.collect()}


def test_summaries_take_late_rows_and_replayed_batches(spark, tmpdir_path):
    raw = events_panel_raw(spark, SF_SMALL)
    land, sink, ck = f"{tmpdir_path}/landing", f"{tmpdir_path}/summary", f"{tmpdir_path}/ck"
    run = lambda: st.run_summary_stream(spark, land, sink, ck)
    late = raw.filter(F.col("timestamp") == F.lit("2024-01-05").cast("timestamp")).limit(2).withColumns(
        {"provider": F.lit("a late one"), "price_per_hour": F.lit(0.001)})
    cut = F.lit("2024-01-08 12:00:00").cast("timestamp")
    st.land_in_halves(spark, raw.filter(F.col("timestamp") <= cut), land, F.lit("2024-01-06").cast("timestamp"), [run])
    seen = raw.filter(F.col("timestamp") <= cut)
    assert {k: v[1:] for k, v in _summaries(spark, sink).items()} == _expected(seen)  # the newest window is there too
    rows = spark.createDataFrame(late.collect(), late.schema)
    rows.write.mode("append").parquet(land)  # three days late
    run()
    want = _expected(seen.unionByName(rows))
    assert {k: v[1:] for k, v in _summaries(spark, sink).items()} == want
    assert want != _expected(seen)
    st.update_windows(spark, rows, 2, sink, f"{tmpdir_path}/replay", "12 hours")  # the batch again, by hand
    assert {k: v[1:] for k, v in _summaries(spark, sink).items()} == want
    run()
    assert {k: v[1:] for k, v in _summaries(spark, sink).items()} == want


def test_dedupe_stream_keeps_the_last_whole_row(spark, tmpdir_path):
    from pricepanel.operators.lake import dedupe_latest
    raw = events_panel_raw(spark, SF_SMALL).filter(F.col("timestamp") < F.lit("2024-01-06").cast("timestamp"))
    # every key comes again in a later file, with an older and a newer sequence
    newer = raw.withColumns({"price_per_hour": F.col("price_per_hour") + 1, "seq_b": F.col("seq_b") + 10_000_000})
    older = raw.withColumns({"price_per_hour": F.col("price_per_hour") - 1, "seq_a": F.col("seq_a") - F.expr("INTERVAL 1 DAY")})
    land, sink, ck = f"{tmpdir_path}/landing", f"{tmpdir_path}/dedupe", f"{tmpdir_path}/ck"
    landed = None
    for part in (raw, newer.filter("seq_b % 3 = 0"), older):
        part.write.mode("append").parquet(land)
        st.run_dedupe_stream(spark, land, sink, ck, ["seq_a", "seq_b"], delay="30 days")
        landed = part if landed is None else landed.unionByName(part)
    columns = [c for c in raw.columns]
    rows = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert rows(spark.read.parquet(sink)) == rows(dedupe_latest(landed, ["seq_a", "seq_b"]))
