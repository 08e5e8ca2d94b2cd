"""Fact build (J1, P24, P25), referential integrity (J9, G5) and duplicate identity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.joins import FIXED_DIMENSIONS
from tripmart.operators.convert import CENT_COLUMNS
from tripmart.operators.dims import current_keys
from tripmart.operators.rules import date_key, time_key


@dataclass
class Dimensions:
    """The reference dimensions of one job."""

    zone: DataFrame
    payment: DataFrame
    vendor: DataFrame
    rate: DataFrame
    date: DataFrame | None = None
    time: DataFrame | None = None

    def side(self, name: str, projected: DataFrame) -> DataFrame:
        """A join side derived from dimension ``name``, with a broadcast hint if its size is fixed."""
        return F.broadcast(projected) if name in FIXED_DIMENSIONS else projected


FACT_KEYS = [
    "pickup_date_key",
    "dropoff_date_key",
    "pickup_time_key",
    "dropoff_time_key",
    "pickup_zone_key",
    "dropoff_zone_key",
    "payment_type_key",
    "vendor_key",
    "rate_code_key",
]


def _surrogate(df: DataFrame, dims: Dimensions, name: str, business_col: str, out: str) -> DataFrame:
    """Left join on the current business key, missing -> surrogate 0."""
    keys = dims.side(
        name,
        current_keys(getattr(dims, name)).select(
            F.col("business_key").alias(f"_bk_{out}"), F.col("surrogate_key").alias(f"_sk_{out}")
        ),
    )
    joined = df.join(keys, df[business_col] == keys[f"_bk_{out}"], "left")
    return joined.withColumn(out, F.coalesce(F.col(f"_sk_{out}"), F.lit(0)).cast("int")).drop(
        f"_bk_{out}", f"_sk_{out}"
    )


def build_facts(accepted: DataFrame, dims: Dimensions, source_asset_id=None, source_version=None) -> DataFrame:
    """P25: one fact row per accepted trip, keyed (source_version, source_row_number).

    The five lookups join current dimension rows; Spark broadcasts those that are small in bytes, so that
    the fact side is shuffled only beside a large zone dimension.
    """
    df = accepted
    df = _surrogate(df, dims, "zone", "pickup_location_id", "pickup_zone_key")
    df = _surrogate(df, dims, "zone", "dropoff_location_id", "dropoff_zone_key")
    df = _surrogate(df, dims, "payment", "payment_type_id", "payment_type_key")
    df = _surrogate(df, dims, "vendor", "vendor_id", "vendor_key")
    df = _surrogate(df, dims, "rate", "rate_code_id", "rate_code_key")
    pickup, dropoff = F.col("pickup_at_local"), F.col("dropoff_at_local")
    asset = source_asset_id if source_asset_id is not None else F.lit(None).cast("string")
    version = source_version if source_version is not None else F.lit(None).cast("string")
    return df.select(
        date_key(pickup).alias("pickup_date_key"),
        date_key(dropoff).alias("dropoff_date_key"),
        time_key(pickup).alias("pickup_time_key"),
        time_key(dropoff).alias("dropoff_time_key"),
        "pickup_zone_key",
        "dropoff_zone_key",
        "payment_type_key",
        "vendor_key",
        "rate_code_key",
        "pickup_at_local",
        "dropoff_at_local",
        "duration_seconds",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "distance_millimiles",
        "store_and_fwd_flag",
        *CENT_COLUMNS,
        asset.alias("source_asset_id"),
        "source_row_number",
        version.alias("source_version"),
        "has_statistical_outlier",
        "has_quality_issue",
        "source_month",
    )


def orphan_counts(facts: DataFrame, dims: Dimensions, extra: dict | None = None) -> DataFrame:
    """Orphan count per foreign key (must all be 0), in ONE pass over the facts:
    each key is left-joined to its (size-checked, broadcast) dimension key set, a missing match
    is counted with ``count_if``, and the single result row is unpivoted to one row per key."""
    checks = [
        ("pickup_zone_key", "zone", "surrogate_key"),
        ("dropoff_zone_key", "zone", "surrogate_key"),
        ("payment_type_key", "payment", "surrogate_key"),
        ("vendor_key", "vendor", "surrogate_key"),
        ("rate_code_key", "rate", "surrogate_key"),
    ]
    if dims.date is not None:
        checks += [("pickup_date_key", "date", "date_key"), ("dropoff_date_key", "date", "date_key")]
    if dims.time is not None:
        checks += [("pickup_time_key", "time", "time_key"), ("dropoff_time_key", "time", "time_key")]
    extra = extra or {}
    df = facts if extra else facts.select(*[fk for fk, _, _ in checks])
    for i, (fk, name, pk) in enumerate(checks):
        keys = dims.side(name, getattr(dims, name).select(F.col(pk).alias(f"_pk{i}"), F.lit(True).alias(f"_hit{i}"))
                         .dropDuplicates([f"_pk{i}"]))
        df = df.join(keys, F.col(fk) == F.col(f"_pk{i}"), "left")
    aggs = [F.count_if(F.col(f"_hit{i}").isNull()).alias(fk) for i, (fk, _, _) in enumerate(checks)]
    aggs += [agg.cast("bigint").alias(name) for name, agg in extra.items()]
    counts = df.agg(*aggs)
    return counts.unpivot([], [fk for fk, _, _ in checks] + list(extra), "foreign_key", "orphan_rows")


def null_key_counts() -> dict:
    """NOT NULL checks of the fact keys and flags, as aggregates for ``orphan_counts``."""
    cols = FACT_KEYS + ["pickup_at_local", "dropoff_at_local", "has_statistical_outlier", "has_quality_issue"]
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in cols}


def duplicate_identities(facts: DataFrame) -> DataFrame:
    """Rows minus distinct source identities, per month (must be 0).

    Identity = (pickup_date_key, source_asset_id, source_version, source_row_number). Row numbers are
    collected in bitmaps, one of 4 KiB per date, asset, version and bucket of 32,768 numbers, combined
    before the shuffle: no identity leaves its task, and the count is exact.
    """
    number = F.col("source_row_number")
    bitmaps = facts.groupBy(
        "source_month", "pickup_date_key", "source_asset_id", "source_version", F.bitmap_bucket_number(number).alias("_bucket")
    ).agg(F.count(F.lit(1)).alias("_rows"), F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"))
    distinct = F.when(F.col("_bucket").isNull(), 1).otherwise(F.bitmap_count("_bits"))
    return bitmaps.groupBy("source_month").agg((F.sum("_rows") - F.sum(distinct)).cast("bigint").alias("duplicate_rows"))


def facts_with_business_keys(facts: DataFrame, dims: Dimensions) -> DataFrame:
    """Facts with every surrogate replaced by its business key (surrogates are opaque)."""
    out = facts
    for fk, name in (
        ("pickup_zone_key", "zone"),
        ("dropoff_zone_key", "zone"),
        ("payment_type_key", "payment"),
        ("vendor_key", "vendor"),
        ("rate_code_key", "rate"),
    ):
        side = dims.side(name, getattr(dims, name).select(
            F.col("surrogate_key").alias("_sk"), F.col("business_key").alias("_bk")))
        out = out.withColumnRenamed(fk, "_fk").join(side, F.col("_fk") == F.col("_sk"), "left")
        out = out.withColumn(fk, F.col("_bk")).drop("_fk", "_sk", "_bk")
    return out.select(*facts.columns)
