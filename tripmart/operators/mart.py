"""Hourly additive mart (A5) and the dashboard read views over it (J4) and over facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.units import int_div
from tripmart.operators.dims import borough_of
from tripmart.operators.fact import Dimensions

MART_KEYS = [
    "pickup_date_key",
    "pickup_hour",
    "pickup_zone_key",
    "payment_type_key",
    "vendor_key",
    "rate_code_key",
    "has_statistical_outlier",
    "has_quality_issue",
]

MART_MEASURES = [
    "trip_count",
    "passenger_count_sum",
    "passenger_sum",
    "distance_millimiles_sum",
    "duration_seconds_sum",
    "fare_amount_cents_sum",
    "extra_cents_sum",
    "mta_tax_cents_sum",
    "tip_amount_cents_sum",
    "tolls_amount_cents_sum",
    "improvement_surcharge_cents_sum",
    "total_amount_cents_sum",
    "congestion_surcharge_cents_sum",
    "airport_fee_cents_sum",
]


def _zsum(c: str):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def hourly_mart(facts: DataFrame) -> DataFrame:
    """A5: 8 keys, 14 additive sums (null money sums to 0). Map-side partial aggregation
    shrinks each task to its distinct key combinations before the shuffle, so hot keys
    (one zone or payment type holding a third of all trips) cost nothing extra."""
    keyed = facts.withColumn("pickup_hour", int_div(F.col("pickup_time_key"), F.lit(60)).cast("int"))
    return keyed.groupBy("source_month", *MART_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        _zsum("passenger_count").alias("passenger_count_sum"),
        F.sum(F.coalesce(F.col("passenger_count"), F.lit(0))).cast("bigint").alias("passenger_sum"),
        F.sum("distance_millimiles").cast("bigint").alias("distance_millimiles_sum"),
        F.sum("duration_seconds").cast("bigint").alias("duration_seconds_sum"),
        F.sum("fare_amount_cents").cast("bigint").alias("fare_amount_cents_sum"),
        _zsum("extra_cents").alias("extra_cents_sum"),
        _zsum("mta_tax_cents").alias("mta_tax_cents_sum"),
        _zsum("tip_amount_cents").alias("tip_amount_cents_sum"),
        _zsum("tolls_amount_cents").alias("tolls_amount_cents_sum"),
        _zsum("improvement_surcharge_cents").alias("improvement_surcharge_cents_sum"),
        F.sum("total_amount_cents").cast("bigint").alias("total_amount_cents_sum"),
        _zsum("congestion_surcharge_cents").alias("congestion_surcharge_cents_sum"),
        _zsum("airport_fee_cents").alias("airport_fee_cents_sum"),
    )


def _dim(dims: Dimensions, name: str, prefix: str, with_borough: bool = False) -> DataFrame:
    dim = getattr(dims, name)
    cols = [
        F.col("surrogate_key").alias(f"_{prefix}_sk"),
        F.col("business_key").alias(f"{prefix}_key"),
        F.col("label").alias(f"{prefix}_label"),
    ]
    if with_borough:
        cols.append(borough_of(F.col("attributes")).alias(f"{prefix.replace('_zone', '')}_borough"))
    return dims.side(name, dim.select(*cols))


def _join_dims(df: DataFrame, parts: list[tuple[str, DataFrame, str]]) -> DataFrame:
    for fk, d, sk in parts:
        df = df.withColumnRenamed(fk, "_fk")
        df = df.join(d, F.col("_fk") == F.col(sk), "inner").drop(sk, "_fk")
    return df


def metrics_view(mart: DataFrame, dims: Dimensions) -> DataFrame:
    """Mart rows labelled with business keys and names (inner joins on surrogates)."""
    date = dims.side(
        "date",
        dims.date.select(
            F.col("date_key").alias("_date_key"),
            F.col("calendar_date").alias("pickup_date"),
            "weekday_number",
            "weekday_name",
        ),
    )
    df = mart.join(date, mart.pickup_date_key == date._date_key, "inner").drop("_date_key")
    parts = [
        ("pickup_zone_key", _dim(dims, "zone", "pickup_zone", with_borough=True), "_pickup_zone_sk"),
        ("payment_type_key", _dim(dims, "payment", "payment_type"), "_payment_type_sk"),
        ("vendor_key", _dim(dims, "vendor", "vendor"), "_vendor_sk"),
        ("rate_code_key", _dim(dims, "rate", "rate_code"), "_rate_code_sk"),
    ]
    return _join_dims(df, parts)


def explorer_view(facts: DataFrame, dims: Dimensions) -> DataFrame:
    """J5 + P30: facts with both zone roles, payment, vendor and rate labels, in display units."""
    parts = [
        ("pickup_zone_key", _dim(dims, "zone", "pickup_zone", with_borough=True), "_pickup_zone_sk"),
        ("dropoff_zone_key", _dim(dims, "zone", "dropoff_zone"), "_dropoff_zone_sk"),
        ("payment_type_key", _dim(dims, "payment", "payment_type"), "_payment_type_sk"),
        ("vendor_key", _dim(dims, "vendor", "vendor"), "_vendor_sk"),
        ("rate_code_key", _dim(dims, "rate", "rate_code"), "_rate_code_sk"),
    ]
    df = _join_dims(facts, parts)
    return df.select(
        F.col("source_row_number").alias("trip_key"),
        "source_version",
        "source_month",
        "pickup_date_key",
        "pickup_at_local",
        "dropoff_at_local",
        "pickup_zone_key",
        "pickup_zone_label",
        "pickup_borough",
        "dropoff_zone_key",
        "dropoff_zone_label",
        "payment_type_key",
        "payment_type_label",
        "vendor_key",
        "vendor_label",
        "rate_code_key",
        "rate_code_label",
        "passenger_count",
        "distance_millimiles",
        (F.col("distance_millimiles").cast("double") / 1000.0).alias("distance_miles"),
        "duration_seconds",
        (F.col("duration_seconds").cast("double") / 60.0).alias("duration_minutes"),
        (F.col("fare_amount_cents").cast("double") / 100.0).alias("fare_amount_dollars"),
        (F.col("tip_amount_cents").cast("double") / 100.0).alias("tip_amount_dollars"),
        "total_amount_cents",
        (F.col("total_amount_cents").cast("double") / 100.0).alias("total_amount_dollars"),
        "has_statistical_outlier",
        "has_quality_issue",
    )
