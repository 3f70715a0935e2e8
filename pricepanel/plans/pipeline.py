"""Collect -> lake: build the listing lake once per input and hand out ``Panel``s.

The lake (listings partitioned by ``dt``), its manifest and the region
dimension are written as Parquet under ``spark.checkpoint.dir`` -- a shared
folder on a cluster -- so every query reads a durable table instead of
re-running the ingest lineage, and a lost executor only re-reads files.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import quality_view
from ..operators.canonical import canonical_prices, enrich_regions
from ..operators.lake import dedupe_latest, snapshot_manifest
from ..panel import Panel
from ..schema import LISTING_KEY, REGIONS_SCHEMA
from ..session import configure, ensure_checkpoint_dir
from ..sources.lake import is_committed, scan_prices, write_lake
from ..sources.panel import (F1_SEQUENCE, F2_SEQUENCE, events_gap_raw, events_panel_raw, listing_panel_raw,
                             region_dimension)
from ..sources.tables import source_bytes, source_fingerprint

_PKG = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_CODE_FILES = ["sources/panel.py", "operators/canonical.py", "operators/lake.py", "sources/lake.py",
               "functions/columns.py", "plans/pipeline.py", "plans/catalog.py", "operators/regions.py", "schema.py",
               "streaming/snapshots.py", "sources/deltas.py"]
_KINDS = {
    "listings": (["lineitem", "part", "supplier", "nation", "region"], listing_panel_raw, F1_SEQUENCE),
    "events": (["events"], events_panel_raw, F2_SEQUENCE),
    "event_gaps": (["events"], events_gap_raw, F2_SEQUENCE),
}
_PANELS: dict = {}
# Folder (under the checkpoint dir) holding the derived tables; bench uses a fresh one.
_NAMESPACE = ["pricepanel-lake"]


def set_namespace(name: str) -> None:
    """Put derived tables under another folder (e.g. a fresh one to time a full build)."""
    _NAMESPACE[0] = name
    _PANELS.clear()


def _code_hash() -> str:
    h = hashlib.sha1()
    for f in _CODE_FILES:
        with open(os.path.join(_PKG, f), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


def lake_root(spark: SparkSession, sf_dir: str, kind: str) -> str:
    tables = _KINDS[kind][0]
    key = hashlib.sha1((source_fingerprint(spark, sf_dir, tables) + _code_hash()).encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{_NAMESPACE[0]}/{kind}-{key}"


def regions_for(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    if kind == "listings":
        return region_dimension(spark, sf_dir)
    return spark.createDataFrame([], REGIONS_SCHEMA)


def build_lake(spark: SparkSession, sf_dir: str, kind: str = "listings", root: str | None = None) -> str:
    """Ingest the panel: raw offers -> key dedupe -> quality -> regions -> lake + manifest.

    The offers are moved once, into ranges of the listing key: a key lies whole in one of them, so the dedupe
    needs no other shuffle, and as the key begins with the timestamp, neither does the write by date.
    """
    root = root or lake_root(spark, sf_dir, kind)
    tables, raw_fn, seq = _KINDS[kind]
    regions = regions_for(spark, sf_dir, kind)
    regions.write.mode("overwrite").parquet(f"{root}/regions")
    regions = spark.read.schema(REGIONS_SCHEMA).parquet(f"{root}/regions")

    offers = raw_fn(spark, sf_dir).repartitionByRange(*LISTING_KEY)
    listings = dedupe_latest(offers, seq).drop("seq_a", "seq_b", "seq_c")
    tagged = enrich_regions(listings.withColumn("quality", quality_view()), regions)
    write_lake(tagged, f"{root}/prices", mode="overwrite", dynamic=False, in_ranges=True,
               input_bytes=source_bytes(spark, sf_dir, tables))

    manifest = snapshot_manifest(scan_prices(spark, f"{root}/prices"), emitted_at=None, code_version=_code_hash())
    manifest.write.mode("overwrite").parquet(f"{root}/manifest")
    return root


def open_panel(spark: SparkSession, root: str) -> Panel:
    regions = spark.read.schema(REGIONS_SCHEMA).parquet(f"{root}/regions")
    raw = scan_prices(spark, f"{root}/prices")
    snapshots = spark.read.parquet(f"{root}/manifest")
    return Panel(canonical_prices(raw, regions), regions, snapshots)


def panel(spark: SparkSession, sf_dir: str, kind: str = "listings") -> Panel:
    """The ``Panel`` for ``sf_dir``, building its lake on first use."""
    configure(spark)
    key = (spark.sparkContext.applicationId, os.path.realpath(sf_dir), kind)
    if key in _PANELS:
        return _PANELS[key]
    root = lake_root(spark, sf_dir, kind)
    # The manifest is written last, from the finished lake: its commit marker
    # stands for the whole build.
    if not is_committed(spark, f"{root}/manifest"):
        build_lake(spark, sf_dir, kind, root)
    p = open_panel(spark, root)
    _PANELS[key] = p
    return p
