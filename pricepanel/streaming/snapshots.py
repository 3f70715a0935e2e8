"""Structured Streaming over snapshot files (ST1-ST3).

Snapshots arrive as immutable Parquet files in a landing folder. Each
stream uses ``trigger(availableNow=True)``: it processes every file not yet
seen (tracked in its checkpoint under ``spark.checkpoint.dir``) and stops,
which is how a twice-daily collection is driven from a scheduler.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lake import dedupe_latest
from ..schema import LISTING_COLUMNS, LISTING_KEY
from ..session import settings
from ..sources.lake import path_exists


def landing_schema(spark: SparkSession, landing: str) -> T.StructType:
    """Streams need a declared schema; take it from the files already landed."""
    return spark.read.parquet(landing).schema


def _write_dates(spark: SparkSession, rows: DataFrame, target: str, staging: str, *cluster: str) -> None:
    """Stage ``rows``, then overwrite just their ``dt``s of ``target``."""
    rows.write.mode("overwrite").parquet(staging)
    (spark.read.schema(rows.schema).parquet(staging).hint("rebalance", "dt").sortWithinPartitions("dt", *cluster)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(target))


def upsert_rows(spark: SparkSession, rows: DataFrame, target: str, staging: str, seq_cols: list[str]) -> None:
    """Merge ``rows`` (with ``dt``) into ``target``: for each listing key the row with the highest
    sequence wins, across the rows and what is already stored.

    Only the ``dt`` partitions the rows touch are read and rewritten; the
    merged rows are staged first so a failed batch leaves the target intact
    and a replayed batch produces the same partitions (idempotent).
    """
    merged = rows
    if path_exists(spark, target):
        touched = rows.select("dt").distinct()
        old = spark.read.schema(rows.schema).parquet(target).join(F.broadcast(touched), "dt", "left_semi")
        merged = old.select(*rows.columns).unionByName(rows)
    _write_dates(spark, dedupe_latest(merged, seq_cols, key=LISTING_KEY), target, staging, "gpu_type", "provider")


def upsert_batch(spark: SparkSession, batch: DataFrame, target: str, staging: str, seq_cols: list[str]) -> None:
    """``upsert_rows`` of one prepared micro-batch of listings."""
    rows = batch.withColumn("dt", F.to_date("timestamp")).select(*LISTING_COLUMNS, *seq_cols, "dt")
    upsert_rows(spark, rows, target, staging, seq_cols)


def run_ingest_stream(spark: SparkSession, landing: str, target: str, checkpoint: str, prepare,
                      seq_cols: list[str], max_files_per_trigger: int = 1000, wait: bool = True):
    """ST1: landing files -> ``prepare`` (normalise/tag/enrich) -> keyed upsert, until caught up."""
    stream = (spark.readStream.schema(landing_schema(spark, landing))
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing))
    staging = checkpoint.rstrip("/") + "_staging"

    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(spark, prepare(batch), target, f"{staging}/{batch_id}", seq_cols)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return _finish(q, wait)


def _finish(q, wait: bool):
    if wait:
        q.awaitTermination()
    return q


def read_stream_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).select(*LISTING_COLUMNS, "dt")


_CELL = ["window_start", "provider", "gpu_type"]


def update_windows(spark: SparkSession, batch: DataFrame, batch_id: int, sink: str, staging: str, slot: str) -> None:
    """ST2, one micro-batch: store its cells, then recompute every window it touches from the stored cells.

    A cell is (window, provider, type) with count, least, greatest and sum: cells of all batches merge into the
    exact summary of a window, distinct counts included, so a late row changes its window like any other and a
    window never closes. The cells of a batch lie in a folder of its own that a replay writes again, and the
    recomputed windows replace those of the same start: both steps may be repeated.
    """
    start = F.window("timestamp", slot).getField("start")
    cells = batch.groupBy(start.alias("window_start"), "provider", "gpu_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("price_per_hour").alias("lo"), F.max("price_per_hour").alias("hi"),
        F.sum("price_per_hour").alias("s")).withColumn("dt", F.to_date("window_start"))
    own = f"{sink}/cells/batch={batch_id}"
    (cells.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(own))
    stored = spark.read.schema(T.StructType([*cells.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{sink}/cells")
    mine = stored.filter(F.col("batch") == batch_id)
    touched = mine.select("dt", "window_start").distinct()
    merged = stored.join(F.broadcast(mine.select("dt").distinct()), "dt", "left_semi").join(
        touched, ["dt", "window_start"], "left_semi").groupBy("dt", *_CELL).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"))
    windows = merged.groupBy("dt", "window_start").agg(
        F.sum("n").alias("total_instances"), F.count_distinct("provider").cast("int").alias("providers_count"),
        F.count_distinct("gpu_type").cast("int").alias("gpu_types_count"), F.min("lo").alias("min_price"),
        F.max("hi").alias("max_price"), F.round(F.sum("s") / F.sum("n"), 6).alias("avg_price"))
    windows = windows.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {slot}")).select(*_WINDOW, "dt")
    table = f"{sink}/windows"
    if path_exists(spark, table):
        old = spark.read.schema(windows.schema).parquet(table).join(
            F.broadcast(mine.select("dt").distinct()), "dt", "left_semi").join(touched, ["dt", "window_start"], "left_anti")
        windows = old.select(*windows.columns).unionByName(windows)
    _write_dates(spark, windows, table, staging, "window_start")


_WINDOW = ["window_start", "window_end", "total_instances", "providers_count", "gpu_types_count", "min_price", "max_price",
           "avg_price"]


def run_summary_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str, slot: str = "12 hours",
                       wait: bool = True):
    """ST2: summaries of all 12-hour windows, each updated by every batch that holds rows of it.

    No row is too late and the newest window is there. A sink belongs to one checkpoint (batch numbers)."""
    stream = spark.readStream.schema(landing_schema(spark, landing)).parquet(landing)
    staging = checkpoint.rstrip("/") + "_staging"

    def each(batch: DataFrame, batch_id: int) -> None:
        update_windows(spark, batch, batch_id, sink, f"{staging}/{batch_id}", slot)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return _finish(q, wait)


def read_summary_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/windows").select(*_WINDOW)


# Partitions of the dedupe stream's state.
STATE_PARTITIONS = 128


def run_dedupe_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str, seq_cols: list[str],
                      delay: str = "1 day", wait: bool = True, state_partitions: int = STATE_PARTITIONS):
    """ST3: last write wins: per listing key the row of the greatest sequence, whole.

    Keyed state holds the greatest row of every key until the watermark passes its timestamp (rows later than that
    are the ingest stream's, ST1); a batch hands on the keys it changed, and a keyed upsert stores them, so the
    newest snapshot is there and a replay changes nothing. The state is an aggregation (``max_by`` of the row), so
    it stays in the JVM and in the state store, without a Python call per key.

    Every task of a plan with state reports to the driver a value for each state partition, so these reports grow
    with the square of ``state_partitions``: it is set here, not by the session's shuffles (fewer where they are
    fewer), stays as the checkpoint has it, and each batch runs the plan once, to stage what it hands on.
    """
    schema = landing_schema(spark, landing)
    rest = [c for c in schema.names if c not in LISTING_KEY]
    stream = spark.readStream.schema(schema).parquet(landing)
    last = stream.withWatermark("timestamp", delay).groupBy(*LISTING_KEY).agg(
        F.max_by(F.struct(*rest), F.struct(*seq_cols)).alias("row"))
    staging = checkpoint.rstrip("/") + "_staging"

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*LISTING_KEY, "row.*").select(*schema.names).withColumn("dt", F.to_date("timestamp"))
        rows.write.mode("overwrite").parquet(f"{staging}/{batch_id}_changed")
        changed = spark.read.schema(rows.schema).parquet(f"{staging}/{batch_id}_changed")
        upsert_rows(spark, changed, sink, f"{staging}/{batch_id}", seq_cols)

    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), state_partitions)
    with settings(spark, {"spark.sql.shuffle.partitions": str(parts)}):  # a query takes the session's as it starts
        q = (last.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    return _finish(q, wait)


def prepare_listings(batch: DataFrame, regions: DataFrame) -> DataFrame:
    """Per-batch ingest step: tag quality and enrich regions (the upsert dedupes)."""
    from ..functions.columns import quality_view
    from ..operators.canonical import enrich_regions
    return enrich_regions(batch.withColumn("quality", quality_view()), regions)


def land_in_halves(spark: SparkSession, raw: DataFrame, landing: str, cut, runs) -> None:
    """Land the snapshots before ``cut``, run the streams, land the rest, run again:
    the second run must pick up only the new files. Each ``run`` starts a
    query and returns it (or None); the queries of one wave run concurrently."""
    for part in (F.col("timestamp") < cut, F.col("timestamp") >= cut):
        raw.filter(part).write.mode("append").parquet(landing)
        started = [r() for r in runs]
        for q in started:
            if q is not None:
                q.awaitTermination()
