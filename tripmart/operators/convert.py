"""Accepted-row conversion (P18-P21): integer units, zero-filled keys, the accepted projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.units import key_or_zero, to_cents, to_millimiles, whole_seconds

MONEY = [
    ("fare_amount", "fare_amount_cents"),
    ("extra", "extra_cents"),
    ("mta_tax", "mta_tax_cents"),
    ("tip_amount", "tip_amount_cents"),
    ("tolls_amount", "tolls_amount_cents"),
    ("improvement_surcharge", "improvement_surcharge_cents"),
    ("total_amount", "total_amount_cents"),
    ("congestion_surcharge", "congestion_surcharge_cents"),
    ("airport_fee", "airport_fee_cents"),
]

CENT_COLUMNS = [c for _, c in MONEY]


def convert_accepted(candidates: DataFrame) -> DataFrame:
    """The accepted projection in integer units (outlier flag added later by P22)."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return candidates.select(
        "source_month",
        "source_row_number",
        pickup.alias("pickup_at_local"),
        dropoff.alias("dropoff_at_local"),
        whole_seconds(pickup, dropoff).alias("duration_seconds"),
        key_or_zero("VendorID").alias("vendor_id"),
        F.col("passenger_count"),
        key_or_zero("PULocationID").alias("pickup_location_id"),
        key_or_zero("DOLocationID").alias("dropoff_location_id"),
        to_millimiles("trip_distance").alias("distance_millimiles"),
        key_or_zero("RatecodeID").alias("rate_code_id"),
        F.col("store_and_fwd_flag"),
        key_or_zero("payment_type").alias("payment_type_id"),
        *[to_cents(src).alias(dst) for src, dst in MONEY],
        F.col("has_quality_issue"),
    )
