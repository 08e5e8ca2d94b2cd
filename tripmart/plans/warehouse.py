"""Read side of a published warehouse (entries 2-4 of the reference) and the per-session
warehouse used by the registered queries."""

from __future__ import annotations

import hashlib
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import dims as D
from tripmart.operators.mart import explorer_view
from tripmart.plans.publish import SourceAsset, publish, read_dimensions
from tripmart.session import scratch_path
from tripmart.sources.fingerprint import schema_fingerprint, source_fingerprint_of
from tripmart.sources.store import TableStore
from tripmart.sources.trips import EVENTS_MONTH, events_trip_view


class Warehouse:
    """Published tables plus the dashboard views over them (all lazy). All month tables are read as of
    the first read, so that a publish in between never mixes two publications of a month."""

    def __init__(self, store: TableStore):
        self.store = store
        self.spark = store.spark

    @cached_property
    def snapshot(self) -> list[str]:
        return self.store.snapshot()

    def table(self, name: str) -> DataFrame:
        return self.store.read(name, self.snapshot)

    @cached_property
    def dims(self):
        # after the snapshot: dimensions only gain members, so later versions hold every key of its facts
        _ = self.snapshot
        return read_dimensions(self.store)

    @cached_property
    def facts(self) -> DataFrame:
        return self.table("fact_trips")

    @cached_property
    def mart(self) -> DataFrame:
        return self.table("trip_metrics_hourly")

    @cached_property
    def metrics(self) -> DataFrame:
        return self.table("trip_metrics_view")

    @cached_property
    def explorer(self) -> DataFrame:
        return explorer_view(self.facts, self.dims)

    @cached_property
    def runs(self) -> DataFrame:
        return self.table("pipeline_run")

    @cached_property
    def assets(self) -> DataFrame:
        return self.table("source_asset")


def _code_version() -> str:
    """Hash of the package sources: a warehouse published by other code is never reused."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for base, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(base, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:16]


def _input_signature(spark: SparkSession, sf_dir: str) -> str:
    """Size and modification time of the input files, through the Hadoop FileSystem API (works
    for local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for t in ("events", "nation", "region"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = path.getFileSystem(conf)
        try:
            summary = fs.getContentSummary(path)
            mtime = fs.getFileStatus(path).getModificationTime()
            parts.append(f"{t}:{summary.getLength()}:{summary.getFileCount()}:{mtime}")
        except Exception:  # noqa: BLE001 - a missing table makes a distinct key
            parts.append(f"{t}:?")
    return ",".join(parts)


_CACHE: dict = {}


def is_published(store: TableStore, months: list[str]) -> bool:
    if not store.exists("pipeline_run"):
        return False
    ok = store.read("pipeline_run").filter((F.col("status") == "success") & F.col("source_month").isin(months))
    return ok.select("source_month").distinct().count() == len(months)


def publish_events_month(spark: SparkSession, store: TableStore, sf_dir: str) -> None:
    """Publish the driver-table trip view as month 2024-01 (fingerprint of the events file)."""
    raw = events_trip_view(spark, sf_dir)
    fp = source_fingerprint_of(spark, f"{sf_dir}/events.parquet").first()
    asset = SourceAsset(
        source_month=EVENTS_MONTH,
        source_asset_id=f"events_{EVENTS_MONTH}:{fp.sha256[:12]}",
        source_version=fp.sha256,
        byte_size=fp.byte_size,
        is_synthetic=True,
        schema_fingerprint=schema_fingerprint(raw),
    )
    publish(spark, store, raw, [asset], D.zone_candidates_from_tables(spark, sf_dir))


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse published from ``sf_dir`` in the session's shared folder, published on
    first use and reused by every later query of the session."""
    key = (sf_dir.rstrip("/"), _input_signature(spark, sf_dir), _code_version())
    sid = spark.sparkContext.applicationId
    if (sid, key) in _CACHE:
        return _CACHE[(sid, key)]
    digest = hashlib.sha256(repr(key).encode()).hexdigest()[:16]
    store = TableStore(spark, scratch_path(spark, "tripmart-warehouse", digest))
    if not is_published(store, [EVENTS_MONTH]):
        publish_events_month(spark, store, sf_dir)
    wh = Warehouse(store)
    _CACHE[(sid, key)] = wh
    return wh
