"""Threshold versions (K13, S11, A26, V3) and reference snapshots (V2, V4).

A threshold version is immutable once saved (append-only table, long form: one row per
metric). Activation is a separate append-only log; the active version is the one with the
latest activation. A reference snapshot id is a hash over the current zone dimension rows,
pinned into each run record together with the threshold version used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import outliers
from tripmart.operators.dims import row_hash
from tripmart.sources.store import TableStore


def save_threshold_version(store: TableStore, version: DataFrame) -> None:
    """Append a calibrated version (output of ``outliers.calibrate``); never mutated."""
    now = F.lit(_dt.datetime.now(_dt.timezone.utc)).cast("timestamp")
    store.append("threshold_version", version.withColumn("created_at", now))


def calibrate_and_save(store: TableStore, converted_months: DataFrame, version_id: str | None = None) -> str:
    """Per-month sketches -> merged sketch -> bounds -> saved version; returns its id."""
    version = outliers.calibrate(converted_months, version_id=version_id)
    vid = version.select("threshold_version_id").first()[0]  # one id per calibration
    save_threshold_version(store, version)
    return vid


def activate(spark: SparkSession, store: TableStore, version_id: str) -> None:
    """V3: record an activation (the version table itself is never rewritten)."""
    now = _dt.datetime.now(_dt.timezone.utc)
    store.append("threshold_activation", spark.createDataFrame(
        [(version_id, now)], "threshold_version_id string, activated_at timestamp"))


def active_version_id(store: TableStore) -> str | None:
    """V3/V4: the version with the latest activation, or None."""
    if not store.exists("threshold_activation"):
        return None
    row = store.read("threshold_activation").orderBy(F.col("activated_at").desc()).select(
        "threshold_version_id").first()
    return row[0] if row else None


def load_threshold_version(store: TableStore, version_id: str) -> DataFrame:
    """One saved version in wide form (``<metric>_low``, ``<metric>_high``): one row."""
    long = store.read("threshold_version").filter(F.col("threshold_version_id") == version_id)
    aggs = []
    for metric in outliers.METRICS:
        aggs.append(F.max(F.when(F.col("metric") == metric, F.col("low_bound"))).alias(f"{metric}_low"))
        aggs.append(F.max(F.when(F.col("metric") == metric, F.col("high_bound"))).alias(f"{metric}_high"))
    return long.groupBy("threshold_version_id").agg(*aggs)


def version_bounds_for_months(spark: SparkSession, store: TableStore, version_id: str, months: list[str]) -> DataFrame:
    """The saved version's bounds repeated for each month of a job (one row per month).

    The version is one row of four numbers, read once; the result has one row per month."""
    row = load_threshold_version(store, version_id).first()
    if row is None:
        raise ValueError(f"unknown threshold version {version_id}")
    names = [f"{m}_{side}" for m in outliers.METRICS for side in ("low", "high")]
    return spark.createDataFrame(
        [(m, *[row[n] for n in names]) for m in months],
        "source_month string, " + ", ".join(f"{n} bigint" for n in names),
    )


def reference_snapshot_id(zone_dim: DataFrame) -> DataFrame:
    """V2: SHA-256 over the number of current dimension rows and two sums of their row hashes: the same for
    any order of the rows, and a plain aggregate (one-row frame)."""
    cur = zone_dim.filter("is_current").select(row_hash("business_key", "label", "attributes").alias("h"))
    sums = [F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16)]
    return cur.agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)), *sums), 256).alias("reference_snapshot_id"))
