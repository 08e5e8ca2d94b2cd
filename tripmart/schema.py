"""Declared schemas, contract lists and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published trip-record data dictionary and
# the reference behaviour exactly; they are stated here once, in natural order.
# ---------------------------------------------------------------------------

# Required raw columns of a monthly trip file, in file order.
REQUIRED_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# Vendor, payment-type and rate-code labels by business key (key 0 is the Unknown member).
VENDOR_LOOKUP = {
    0: "Unknown",
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
}
PAYMENT_TYPE_LOOKUP = {
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATE_CODE_LOOKUP = {
    0: "Unknown",
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

# Optional money columns and the flag raised when one is null, in flag order.
NULLABLE_MONEY_FLAGS = [
    ("fare_amount", "NULL_FARE"),
    ("extra", "NULL_EXTRA"),
    ("mta_tax", "NULL_MTA_TAX"),
    ("tip_amount", "NULL_TIP"),
    ("tolls_amount", "NULL_TOLLS"),
    ("improvement_surcharge", "NULL_IMPROVEMENT"),
    ("total_amount", "NULL_TOTAL"),
    ("congestion_surcharge", "NULL_CONGESTION"),
    ("airport_fee", "NULL_AIRPORT_FEE"),
]

# Numeric columns that must be finite when present.
NON_FINITE_COLUMNS = [
    "trip_distance",
    "fare_amount",
    "total_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
]

# Largest plausible magnitudes; sums of 9e9 such rows in cents or millimiles still fit a bigint.
MAX_DOLLARS = 1e7
MAX_MILES = 1e6
# Ids and counts are integers of 32 bits in the warehouse.
KEY_COLUMNS = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type", "passenger_count"]
MAX_KEY = 2**31 - 1

# Dropoff may fall this many hours after the month end.
MONTH_WINDOW_HOURS = 24

# Outlier sketch size and tails; sketch input ranges (exclusive).
SKETCH_K = 4096
LOW_QUANTILE = 0.001
HIGH_QUANTILE = 0.999
DURATION_RANGE = (0, 86400)
DISTANCE_RANGE = (0, 1_000_000)

# Dashboard explorer page size.
PAGE_SIZE = 100

# Dayparts by hour of pickup: below 6, below 12, below 17, otherwise.
DAYPARTS = [(6, "Late Night"), (12, "Morning"), (17, "Afternoon"), (24, "Evening")]

# Alert redaction: sensitive key names, and fields passed through unchanged.
SENSITIVE_KEY_PATTERN = r"(?i)password|secret|token|authorization|cookie|credential|api[-_]?key"
SENSITIVE_VALUE_PATTERN = (
    r"(?i)\b(password|secret|token|authorization|cookie|credential|api[-_]?key)\s*[:=]\s*[^\s,;}]+"
)
SAFE_ALERT_FIELDS = [
    "alertname",
    "alerts",
    "commonLabels",
    "dag_id",
    "endsAt",
    "event",
    "exception_class",
    "fingerprint",
    "groupKey",
    "groupLabels",
    "labels",
    "namespace",
    "pod",
    "receiver",
    "run_id",
    "service",
    "severity",
    "source_month",
    "startsAt",
    "status",
    "task_id",
    "truncatedAlerts",
    "try_number",
]

# ---------------------------------------------------------------------------
# Declared Spark schemas.
# ---------------------------------------------------------------------------

# Raw trip row after the contract cast (type families per column).
RAW_TRIP = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

# Accepted type families per column for the contract check (None = not type-checked).
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
TIMESTAMPS = (T.TimestampNTZType, T.TimestampType)
CONTRACT_FAMILIES: dict[str, tuple | None] = {
    "VendorID": INTEGRAL,
    "tpep_pickup_datetime": TIMESTAMPS,
    "tpep_dropoff_datetime": TIMESTAMPS,
    "passenger_count": INTEGRAL + FRACTIONAL,
    "trip_distance": FRACTIONAL,
    "RatecodeID": INTEGRAL + FRACTIONAL,
    "store_and_fwd_flag": None,
    "PULocationID": INTEGRAL,
    "DOLocationID": INTEGRAL,
    "payment_type": INTEGRAL,
    "fare_amount": FRACTIONAL,
    "extra": FRACTIONAL,
    "mta_tax": FRACTIONAL,
    "tip_amount": FRACTIONAL,
    "tolls_amount": FRACTIONAL,
    "improvement_surcharge": FRACTIONAL,
    "total_amount": FRACTIONAL,
    "congestion_surcharge": FRACTIONAL,
    "airport_fee": FRACTIONAL,
}

ZONE_CSV = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
