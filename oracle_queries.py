"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: plain SQL over the pre-registered driver views,
with business keys resolved by membership tests instead of surrogate joins. Every query
is ``WITH <prelude> SELECT ...``; the prelude is the trip view of FIXTURES F4 followed by
the reject/flag rules, unit conversion, exact bounds, facts and the hourly mart.
"""

from __future__ import annotations

MONTH_START = "TIMESTAMP '2024-01-01 00:00:00'"
MONTH_END = "TIMESTAMP '2024-02-01 00:00:00'"
WINDOW_END = "TIMESTAMP '2024-02-02 00:00:00'"

TRIPS = """
raw AS (
  SELECT event_id + 1 AS rn, user_id, event_type, value, ts,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
trips AS (
SELECT rn AS source_row_number,
  CAST(CASE WHEN rn % 83 = 0 THEN 9 ELSE 1 + user_id % 2 END AS BIGINT) AS "VendorID",
  CASE WHEN rn % 97 = 0 THEN NULL
       WHEN rn % 113 = 0 THEN ts - INTERVAL 31 DAY
       WHEN rn % 127 = 0 THEN ts + INTERVAL 31 DAY
       ELSE ts END AS tpep_pickup_datetime,
  CASE WHEN rn % 89 = 0 THEN NULL
       WHEN rn % 53 = 0 THEN ts - INTERVAL 60 SECOND
       WHEN rn % 211 = 0 THEN ts + INTERVAL 40 DAY
       WHEN rn % 1999 = 0 THEN ts + INTERVAL 20 HOUR
       WHEN rn % 113 = 0 THEN ts - INTERVAL 31 DAY + (k * 30 + 60) * INTERVAL 1 SECOND
       WHEN rn % 127 = 0 THEN ts + INTERVAL 31 DAY + (k * 30 + 60) * INTERVAL 1 SECOND
       ELSE ts + (k * 30 + 60) * INTERVAL 1 SECOND END AS tpep_dropoff_datetime,
  CAST(CASE WHEN rn % 2909 = 0 THEN CAST('NaN' AS DOUBLE) WHEN rn % 71 = 0 THEN NULL WHEN rn % 73 = 0 THEN -1 ELSE k % 7 END AS DOUBLE) AS passenger_count,
  CASE WHEN rn % 31 = 0 THEN 0.0 WHEN rn % 101 = 0 THEN NULL
       WHEN rn % 103 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value / 10.0 END AS trip_distance,
  CASE WHEN rn % 2503 = 0 THEN CAST('NaN' AS DOUBLE) WHEN rn % 79 = 0 THEN 99.0 ELSE CAST(1 + k % 6 AS DOUBLE) END AS "RatecodeID",
  'N' AS store_and_fwd_flag,
  CAST(CASE WHEN rn % 2707 = 0 THEN 3000000000 ELSE 1 + user_id % 27 END AS BIGINT) AS "PULocationID",
  CAST(1 + k % 27 AS BIGINT) AS "DOLocationID",
  CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 4
       ELSE CASE WHEN rn % 5 = 0 THEN 99 ELSE 1 END END AS BIGINT) AS payment_type,
  CASE WHEN rn % 41 = 0 THEN -value WHEN rn % 107 = 0 THEN NULL ELSE value END AS fare_amount,
  CAST(CASE WHEN rn % 61 = 0 THEN NULL ELSE 0.5 END AS DOUBLE) AS extra,
  CAST(CASE WHEN rn % 137 = 0 THEN NULL ELSE 0.5 END AS DOUBLE) AS mta_tax,
  CASE WHEN rn % 67 = 0 THEN NULL ELSE value * 0.2 END AS tip_amount,
  CASE WHEN rn % 131 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN rn % 157 = 0 THEN NULL ELSE CAST(0.0 AS DOUBLE) END AS tolls_amount,
  CAST(CASE WHEN rn % 139 = 0 THEN NULL ELSE 0.3 END AS DOUBLE) AS improvement_surcharge,
  CASE WHEN rn % 3001 = 0 THEN CAST(9.1e16 AS DOUBLE) WHEN rn % 43 = 0 THEN -1.0 WHEN rn % 109 = 0 THEN NULL ELSE value * 1.25 END AS total_amount,
  CAST(CASE WHEN rn % 149 = 0 THEN NULL ELSE 2.5 END AS DOUBLE) AS congestion_surcharge,
  CAST(CASE WHEN rn % 151 = 0 THEN NULL ELSE 0.0 END AS DOUBLE) AS airport_fee
FROM raw)"""

_NONFINITE = " OR ".join(
    f"COALESCE(isnan({c}) OR isinf({c}), FALSE)"
    for c in [
        "trip_distance", "fare_amount", "total_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
    ]
)

_TOOBIG = " OR ".join(
    f"COALESCE(abs({c}) >= {'1e6' if c == 'trip_distance' else '1e7'}, FALSE)"
    for c in [
        "trip_distance", "fare_amount", "total_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
    ]
)

_BADKEY = " OR ".join(
    f'COALESCE(isnan(CAST("{c}" AS DOUBLE)) OR abs(CAST("{c}" AS DOUBLE)) > 2147483647, FALSE)'
    for c in ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type", "passenger_count"]
)

RULES = f"""
rules AS (
  SELECT t.*,
    tpep_pickup_datetime IS NULL AS r_missing_pickup,
    tpep_dropoff_datetime IS NULL AS r_missing_dropoff,
    trip_distance IS NULL AS r_missing_distance,
    COALESCE(trip_distance <= 0, FALSE) AS r_non_positive_distance,
    fare_amount IS NULL AS r_missing_fare,
    COALESCE(fare_amount < 0, FALSE) AS r_negative_fare,
    total_amount IS NULL AS r_missing_total,
    COALESCE(total_amount < 0, FALSE) AS r_negative_total,
    COALESCE(tpep_pickup_datetime < {MONTH_START}, FALSE) AS r_pickup_before_month,
    COALESCE(tpep_pickup_datetime >= {MONTH_END}, FALSE) AS r_pickup_after_month,
    COALESCE(tpep_dropoff_datetime <= tpep_pickup_datetime, FALSE) AS r_dropoff_before_pickup,
    COALESCE(tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime >= {WINDOW_END}, FALSE)
      AS r_dropoff_after_window,
    ({_NONFINITE}) AS r_non_finite_number,
    NOT ({_NONFINITE}) AND ({_TOOBIG}) AS r_value_out_of_range,
    ({_BADKEY}) AS r_key_out_of_range
  FROM trips t),
classified AS (
  SELECT r.*,
    (r_missing_pickup OR r_missing_dropoff OR r_missing_distance OR r_non_positive_distance
     OR r_missing_fare OR r_negative_fare OR r_missing_total OR r_negative_total
     OR r_pickup_before_month OR r_pickup_after_month OR r_dropoff_before_pickup
     OR r_dropoff_after_window OR r_non_finite_number OR r_value_out_of_range OR r_key_out_of_range) AS is_rejected,
    COALESCE("VendorID" NOT IN (0, 1, 2), TRUE) AS f_unknown_vendor,
    COALESCE(payment_type NOT IN (0, 1, 2, 3, 4, 5, 6), TRUE) AS f_unknown_payment,
    COALESCE("RatecodeID" NOT IN (0, 1, 2, 3, 4, 5, 6), TRUE) AS f_unknown_rate,
    COALESCE(passenger_count IS NULL OR passenger_count < 0, TRUE) AS f_invalid_passenger_count,
    fare_amount IS NULL AS f_null_fare,
    extra IS NULL AS f_null_extra,
    mta_tax IS NULL AS f_null_mta_tax,
    tip_amount IS NULL AS f_null_tip,
    tolls_amount IS NULL AS f_null_tolls,
    improvement_surcharge IS NULL AS f_null_improvement,
    total_amount IS NULL AS f_null_total,
    congestion_surcharge IS NULL AS f_null_congestion,
    airport_fee IS NULL AS f_null_airport_fee
  FROM rules r),
flagged AS (
  SELECT c.*,
    (f_unknown_vendor OR f_unknown_payment OR f_unknown_rate OR f_invalid_passenger_count
     OR f_null_fare OR f_null_extra OR f_null_mta_tax OR f_null_tip OR f_null_tolls
     OR f_null_improvement OR f_null_total OR f_null_congestion OR f_null_airport_fee) AS any_flag
  FROM classified c WHERE NOT is_rejected)"""

CONVERTED = """
converted AS (
  SELECT
    '2024-01' AS source_month,
    source_row_number,
    tpep_pickup_datetime AS pickup_at_local,
    tpep_dropoff_datetime AS dropoff_at_local,
    (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) // 1000000 AS duration_seconds,
    COALESCE(CAST("VendorID" AS INTEGER), 0) AS vendor_id,
    passenger_count,
    COALESCE(CAST("PULocationID" AS INTEGER), 0) AS pickup_location_id,
    COALESCE(CAST("DOLocationID" AS INTEGER), 0) AS dropoff_location_id,
    CAST(round_even(trip_distance * 1000.0, 0) AS BIGINT) AS distance_millimiles,
    COALESCE(CAST("RatecodeID" AS INTEGER), 0) AS rate_code_id,
    store_and_fwd_flag,
    COALESCE(CAST(payment_type AS INTEGER), 0) AS payment_type_id,
    CAST(round_even(fare_amount * 100.0, 0) AS BIGINT) AS fare_amount_cents,
    CAST(round_even(extra * 100.0, 0) AS BIGINT) AS extra_cents,
    CAST(round_even(mta_tax * 100.0, 0) AS BIGINT) AS mta_tax_cents,
    CAST(round_even(tip_amount * 100.0, 0) AS BIGINT) AS tip_amount_cents,
    CAST(round_even(tolls_amount * 100.0, 0) AS BIGINT) AS tolls_amount_cents,
    CAST(round_even(improvement_surcharge * 100.0, 0) AS BIGINT) AS improvement_surcharge_cents,
    CAST(round_even(total_amount * 100.0, 0) AS BIGINT) AS total_amount_cents,
    CAST(round_even(congestion_surcharge * 100.0, 0) AS BIGINT) AS congestion_surcharge_cents,
    CAST(round_even(airport_fee * 100.0, 0) AS BIGINT) AS airport_fee_cents,
    any_flag AS has_quality_issue
  FROM flagged),
bounds AS (
  SELECT
    count(*) AS n,
    CAST(quantile_disc(CASE WHEN duration_seconds > 0 AND duration_seconds < 86400 THEN duration_seconds END, 0.001) AS BIGINT) AS dur_lo,
    CAST(quantile_disc(CASE WHEN duration_seconds > 0 AND duration_seconds < 86400 THEN duration_seconds END, 0.999) AS BIGINT) AS dur_hi,
    CAST(quantile_disc(CASE WHEN distance_millimiles > 0 AND distance_millimiles < 1000000 THEN distance_millimiles END, 0.001) AS BIGINT) AS dist_lo,
    CAST(quantile_disc(CASE WHEN distance_millimiles > 0 AND distance_millimiles < 1000000 THEN distance_millimiles END, 0.999) AS BIGINT) AS dist_hi
  FROM converted),
gated AS (
  SELECT dur_lo, dur_hi, dist_lo, dist_hi FROM bounds),
accepted AS (
  SELECT c.*,
    (COALESCE(duration_seconds < g.dur_lo, FALSE) OR COALESCE(duration_seconds > g.dur_hi, FALSE)
     OR COALESCE(distance_millimiles < g.dist_lo, FALSE) OR COALESCE(distance_millimiles > g.dist_hi, FALSE))
      AS has_statistical_outlier
  FROM converted c CROSS JOIN gated g)"""

DIMS = """
zone_dim AS (
  SELECT n.n_nationkey + 1 AS business_key, n.n_name AS label,
         'borough=' || r.r_name || ', service_zone=' || r.r_name AS attributes,
         r.r_name AS borough
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 0, 'Unknown', NULL, NULL),
payment_dim(business_key, label) AS (VALUES
  (0, 'Unknown'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'),
  (6, 'Voided trip')),
vendor_dim(business_key, label) AS (VALUES
  (0, 'Unknown'), (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc')),
rate_dim(business_key, label) AS (VALUES
  (0, 'Unknown'), (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
  (5, 'Negotiated fare'), (6, 'Group ride')),
time_dim AS (
  SELECT CAST(i AS INTEGER) AS time_key, CAST(i // 60 AS INTEGER) AS hour,
    CASE WHEN i // 60 < 6 THEN 'Late Night' WHEN i // 60 < 12 THEN 'Morning'
         WHEN i // 60 < 17 THEN 'Afternoon' ELSE 'Evening' END AS daypart
  FROM range(1440) t(i)),
date_dim AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
    CAST(d AS DATE) AS calendar_date, CAST(isodow(d) AS INTEGER) AS weekday_number, dayname(d) AS weekday_name
  FROM range(DATE '2024-01-01', DATE '2024-02-02', INTERVAL 1 DAY) t(d))"""

FACTS = """
facts AS (
  SELECT
    CAST(year(pickup_at_local) * 10000 + month(pickup_at_local) * 100 + day(pickup_at_local) AS INTEGER) AS pickup_date_key,
    CAST(year(dropoff_at_local) * 10000 + month(dropoff_at_local) * 100 + day(dropoff_at_local) AS INTEGER) AS dropoff_date_key,
    CAST(hour(pickup_at_local) * 60 + minute(pickup_at_local) AS INTEGER) AS pickup_time_key,
    CAST(hour(dropoff_at_local) * 60 + minute(dropoff_at_local) AS INTEGER) AS dropoff_time_key,
    CASE WHEN pickup_location_id IN (SELECT business_key FROM zone_dim) THEN pickup_location_id ELSE 0 END AS pickup_zone_key,
    CASE WHEN dropoff_location_id IN (SELECT business_key FROM zone_dim) THEN dropoff_location_id ELSE 0 END AS dropoff_zone_key,
    CASE WHEN payment_type_id IN (SELECT business_key FROM payment_dim) THEN payment_type_id ELSE 0 END AS payment_type_key,
    CASE WHEN vendor_id IN (SELECT business_key FROM vendor_dim) THEN vendor_id ELSE 0 END AS vendor_key,
    CASE WHEN rate_code_id IN (SELECT business_key FROM rate_dim) THEN rate_code_id ELSE 0 END AS rate_code_key,
    pickup_at_local, dropoff_at_local, duration_seconds,
    CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
    distance_millimiles, store_and_fwd_flag,
    fare_amount_cents, extra_cents, mta_tax_cents, tip_amount_cents, tolls_amount_cents,
    improvement_surcharge_cents, total_amount_cents, congestion_surcharge_cents, airport_fee_cents,
    source_row_number, has_statistical_outlier, has_quality_issue, source_month
  FROM accepted),
mart AS (
  SELECT source_month, pickup_date_key, CAST(pickup_time_key // 60 AS INTEGER) AS pickup_hour,
    pickup_zone_key, payment_type_key, vendor_key, rate_code_key,
    has_statistical_outlier, has_quality_issue,
    CAST(count(*) AS BIGINT) AS trip_count,
    CAST(COALESCE(sum(passenger_count), 0) AS BIGINT) AS passenger_count_sum,
    CAST(sum(COALESCE(passenger_count, 0)) AS BIGINT) AS passenger_sum,
    CAST(sum(distance_millimiles) AS BIGINT) AS distance_millimiles_sum,
    CAST(sum(duration_seconds) AS BIGINT) AS duration_seconds_sum,
    CAST(sum(fare_amount_cents) AS BIGINT) AS fare_amount_cents_sum,
    CAST(COALESCE(sum(extra_cents), 0) AS BIGINT) AS extra_cents_sum,
    CAST(COALESCE(sum(mta_tax_cents), 0) AS BIGINT) AS mta_tax_cents_sum,
    CAST(COALESCE(sum(tip_amount_cents), 0) AS BIGINT) AS tip_amount_cents_sum,
    CAST(COALESCE(sum(tolls_amount_cents), 0) AS BIGINT) AS tolls_amount_cents_sum,
    CAST(COALESCE(sum(improvement_surcharge_cents), 0) AS BIGINT) AS improvement_surcharge_cents_sum,
    CAST(sum(total_amount_cents) AS BIGINT) AS total_amount_cents_sum,
    CAST(COALESCE(sum(congestion_surcharge_cents), 0) AS BIGINT) AS congestion_surcharge_cents_sum,
    CAST(COALESCE(sum(airport_fee_cents), 0) AS BIGINT) AS airport_fee_cents_sum
  FROM facts
  GROUP BY ALL),
mv AS (
  SELECT m.*, d.calendar_date AS pickup_date, d.weekday_number, d.weekday_name,
    z.label AS pickup_zone_label, z.borough AS pickup_borough,
    p.label AS payment_type_label, v.label AS vendor_label, r.label AS rate_code_label
  FROM mart m
  JOIN date_dim d ON d.date_key = m.pickup_date_key
  JOIN zone_dim z ON z.business_key = m.pickup_zone_key
  JOIN payment_dim p ON p.business_key = m.payment_type_key
  JOIN vendor_dim v ON v.business_key = m.vendor_key
  JOIN rate_dim r ON r.business_key = m.rate_code_key)"""

PRELUDE = "WITH " + ",".join([TRIPS, RULES, CONVERTED, DIMS, FACTS])


def q(body: str) -> str:
    return PRELUDE + "\n" + body


def _fin(alias: str = "") -> str:
    return f"NOT {alias}has_statistical_outlier"


ORACLES: dict[str, str] = {}

ORACLES["revenue_by_payment"] = q("""
SELECT f.payment_type_key, p.label AS payment_type_label,
  CAST(sum(f.total_amount_cents) AS DOUBLE) / 100.0 AS total_revenue_dollars,
  CAST(count(*) AS BIGINT) AS trip_count,
  CAST((2 * CAST(sum(f.total_amount_cents) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0
    AS avg_revenue_per_trip_dollars
FROM facts f JOIN payment_dim p ON p.business_key = f.payment_type_key
GROUP BY f.payment_type_key, p.label
""")

ORACLES["revenue_by_payment_no_outliers"] = q("""
SELECT f.payment_type_key, p.label AS payment_type_label,
  CAST(sum(f.total_amount_cents) AS DOUBLE) / 100.0 AS total_revenue_dollars,
  CAST(count(*) AS BIGINT) AS trip_count
FROM facts f JOIN payment_dim p ON p.business_key = f.payment_type_key
WHERE NOT f.has_statistical_outlier
GROUP BY f.payment_type_key, p.label
""")


def qx(ctes: str, body: str) -> str:
    """Prelude plus extra CTEs, then the body."""
    return PRELUDE + ",\n" + ctes + "\n" + body


REJECT_RULES = [
    ("MISSING_PICKUP", "r_missing_pickup"),
    ("MISSING_DROPOFF", "r_missing_dropoff"),
    ("MISSING_DISTANCE", "r_missing_distance"),
    ("NON_POSITIVE_DISTANCE", "r_non_positive_distance"),
    ("MISSING_FARE", "r_missing_fare"),
    ("NEGATIVE_FARE", "r_negative_fare"),
    ("MISSING_TOTAL", "r_missing_total"),
    ("NEGATIVE_TOTAL", "r_negative_total"),
    ("PICKUP_BEFORE_MONTH", "r_pickup_before_month"),
    ("PICKUP_AFTER_MONTH", "r_pickup_after_month"),
    ("DROPOFF_BEFORE_PICKUP", "r_dropoff_before_pickup"),
    ("DROPOFF_AFTER_WINDOW", "r_dropoff_after_window"),
    ("NON_FINITE_NUMBER", "r_non_finite_number"),
    ("VALUE_OUT_OF_RANGE", "r_value_out_of_range"),
    ("KEY_OUT_OF_RANGE", "r_key_out_of_range"),
]
FLAG_RULES = [
    ("UNKNOWN_VENDOR", "f_unknown_vendor"),
    ("UNKNOWN_PAYMENT", "f_unknown_payment"),
    ("UNKNOWN_RATE", "f_unknown_rate"),
    ("INVALID_PASSENGER_COUNT", "f_invalid_passenger_count"),
    ("NULL_FARE", "f_null_fare"),
    ("NULL_EXTRA", "f_null_extra"),
    ("NULL_MTA_TAX", "f_null_mta_tax"),
    ("NULL_TIP", "f_null_tip"),
    ("NULL_TOLLS", "f_null_tolls"),
    ("NULL_IMPROVEMENT", "f_null_improvement"),
    ("NULL_TOTAL", "f_null_total"),
    ("NULL_CONGESTION", "f_null_congestion"),
    ("NULL_AIRPORT_FEE", "f_null_airport_fee"),
]

ISSUES = "issues AS (" + " UNION ALL ".join(
    f"SELECT '2024-01' AS source_month, source_row_number, '{code}' AS issue_code FROM flagged WHERE {col}"
    for code, col in FLAG_RULES
) + ")"


def ratio(num: str, den: str, scale: str = "1.0") -> str:
    """scale * num / NULLIF(den, 0) in double, same operation order as the Spark side."""
    return (f"CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN "
            f"(CAST({scale} AS DOUBLE) * CAST({num} AS DOUBLE)) / CAST({den} AS DOUBLE) END")


def fsum(col: str, cond: str) -> str:
    return f"sum({col}) FILTER (WHERE {cond})"


FIN = "NOT has_statistical_outlier"
MONTH_WHERE = "source_month BETWEEN '2024-01' AND '2024-01' AND pickup_date_key BETWEEN 20240101 AND 20240131"

ORACLES["trip_reject_counts"] = q(f"""
SELECT '2024-01' AS source_month,
  CAST(count(*) AS BIGINT) AS source_rows,
  CAST(count(*) FILTER (WHERE NOT is_rejected) AS BIGINT) AS accepted_rows,
  CAST(count(*) FILTER (WHERE is_rejected) AS BIGINT) AS rejected_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM flagged WHERE any_flag) AS flagged_rows,
  (SELECT CAST(sum({' + '.join(f'CAST({c} AS INTEGER)' for _, c in FLAG_RULES)}) AS BIGINT) FROM flagged) AS issue_rows
FROM classified
""")

ORACLES["reject_reason_histogram"] = q(
    "SELECT '2024-01' AS source_month, reject_code, CAST(count(*) AS BIGINT) AS row_count FROM ("
    + " UNION ALL ".join(f"SELECT '{code}' AS reject_code FROM rules WHERE {col}" for code, col in REJECT_RULES)
    + ") GROUP BY reject_code"
)

ORACLES["trip_issue_rows"] = qx(ISSUES, "SELECT * FROM issues")

ORACLES["accepted_trips"] = q("SELECT * FROM accepted")

ORACLES["exact_bounds"] = q("""
SELECT '2024-01' AS source_month, dur_lo AS duration_seconds_low, dur_hi AS duration_seconds_high,
  dist_lo AS distance_millimiles_low, dist_hi AS distance_millimiles_high
FROM gated""")

ORACLES["fact_trips"] = q("SELECT * FROM facts")

ORACLES["orphan_check"] = q("""
SELECT 'pickup_zone_key' AS foreign_key, CAST(count(*) FILTER (WHERE pickup_zone_key NOT IN (SELECT business_key FROM zone_dim)) AS BIGINT) AS orphan_rows FROM facts
UNION ALL SELECT 'dropoff_zone_key', CAST(count(*) FILTER (WHERE dropoff_zone_key NOT IN (SELECT business_key FROM zone_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'payment_type_key', CAST(count(*) FILTER (WHERE payment_type_key NOT IN (SELECT business_key FROM payment_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'vendor_key', CAST(count(*) FILTER (WHERE vendor_key NOT IN (SELECT business_key FROM vendor_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'rate_code_key', CAST(count(*) FILTER (WHERE rate_code_key NOT IN (SELECT business_key FROM rate_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'pickup_date_key', CAST(count(*) FILTER (WHERE pickup_date_key NOT IN (SELECT date_key FROM date_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'dropoff_date_key', CAST(count(*) FILTER (WHERE dropoff_date_key NOT IN (SELECT date_key FROM date_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'pickup_time_key', CAST(count(*) FILTER (WHERE pickup_time_key NOT IN (SELECT time_key FROM time_dim)) AS BIGINT) FROM facts
UNION ALL SELECT 'dropoff_time_key', CAST(count(*) FILTER (WHERE dropoff_time_key NOT IN (SELECT time_key FROM time_dim)) AS BIGINT) FROM facts
""")

ORACLES["duplicate_check"] = q("""
SELECT source_month, CAST(count(*) - count(DISTINCT (pickup_date_key, source_row_number)) AS BIGINT) AS duplicate_rows
FROM facts GROUP BY source_month""")

ORACLES["dim_date_month"] = """
WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders WHERE o_orderdate IS NOT NULL),
days AS (SELECT DISTINCT CAST(unnest(range(m, m + INTERVAL 1 MONTH + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM months)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
  d AS calendar_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS iso_week,
  CAST(isoyear(d) AS INTEGER) AS iso_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(isodow(d) AS INTEGER) AS weekday_number,
  dayname(d) AS weekday_name, isodow(d) IN (6, 7) AS is_weekend
FROM days"""

ORACLES["hourly_mart"] = q("SELECT * FROM mart")

ORACLES["metrics_view"] = q("SELECT * FROM mv")

ORACLES["kpis"] = q(f"""
SELECT CAST(COALESCE(sum(trip_count), 0) AS BIGINT) AS trip_count,
  CAST(COALESCE({fsum('total_amount_cents_sum', FIN)}, 0) AS DOUBLE) / 100.0 AS gross_revenue_dollars,
  {ratio(fsum('total_amount_cents_sum', FIN), '100.0 * CAST(' + fsum('trip_count', FIN) + ' AS DOUBLE)')} AS revenue_per_trip_dollars,
  {ratio(fsum('fare_amount_cents_sum', FIN), fsum('distance_millimiles_sum', FIN), '10.0')} AS fare_per_mile_dollars,
  {ratio(fsum('duration_seconds_sum', FIN), '60.0 * CAST(' + fsum('trip_count', FIN) + ' AS DOUBLE)')} AS average_duration_minutes,
  {ratio(fsum('tip_amount_cents_sum', FIN + ' AND payment_type_key = 1'), fsum('fare_amount_cents_sum', FIN + ' AND payment_type_key = 1'), '100.0')} AS recorded_card_tip_rate
FROM mv WHERE {MONTH_WHERE}""")

ORACLES["kpis_including_outliers"] = q(f"""
SELECT CAST(COALESCE(sum(trip_count), 0) AS BIGINT) AS trip_count,
  CAST(COALESCE(sum(total_amount_cents_sum), 0) AS DOUBLE) / 100.0 AS gross_revenue_dollars,
  {ratio('sum(total_amount_cents_sum)', '100.0 * CAST(sum(trip_count) AS DOUBLE)')} AS revenue_per_trip_dollars,
  {ratio('sum(fare_amount_cents_sum)', 'sum(distance_millimiles_sum)', '10.0')} AS fare_per_mile_dollars,
  {ratio('sum(duration_seconds_sum)', '60.0 * CAST(sum(trip_count) AS DOUBLE)')} AS average_duration_minutes,
  {ratio(fsum('tip_amount_cents_sum', 'payment_type_key = 1'), fsum('fare_amount_cents_sum', 'payment_type_key = 1'), '100.0')} AS recorded_card_tip_rate
FROM mv WHERE {MONTH_WHERE}""")

ORACLES["daily_metrics"] = q(f"""
SELECT pickup_date, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  CAST({fsum('total_amount_cents_sum', FIN)} AS DOUBLE) / 100.0 AS gross_revenue_dollars,
  {ratio(fsum('fare_amount_cents_sum', FIN), fsum('distance_millimiles_sum', FIN), '10.0')} AS fare_per_mile_dollars
FROM mv WHERE {MONTH_WHERE} GROUP BY pickup_date""")

ORACLES["hourly_metrics"] = q(f"""
SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  {ratio(fsum('distance_millimiles_sum', FIN), fsum('duration_seconds_sum', FIN), '3.6')} AS weighted_network_speed_mph
FROM mv WHERE {MONTH_WHERE} GROUP BY pickup_hour""")

ORACLES["weekday_hour_heatmap"] = q(f"""
SELECT weekday_number, weekday_name, pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trip_count
FROM mv WHERE {MONTH_WHERE} GROUP BY weekday_number, weekday_name, pickup_hour""")

ZONES = f"""
z AS (
SELECT pickup_zone_key, pickup_zone_label, pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  CAST({fsum('total_amount_cents_sum', FIN)} AS DOUBLE) / 100.0 AS gross_revenue_dollars,
  {ratio(fsum('total_amount_cents_sum', FIN), '100.0 * CAST(' + fsum('trip_count', FIN) + ' AS DOUBLE)')} AS revenue_per_trip_dollars,
  {ratio(fsum('fare_amount_cents_sum', FIN), fsum('distance_millimiles_sum', FIN), '10.0')} AS fare_per_mile_dollars
FROM mv WHERE {MONTH_WHERE} GROUP BY pickup_zone_key, pickup_zone_label, pickup_borough)"""

ORACLES["zone_metrics"] = qx(ZONES, "SELECT * FROM z")


def _breakdown(dim: str) -> str:
    return q(f"""
SELECT {dim}_key, {dim}_label,
  CAST(sum(total_amount_cents_sum) AS DOUBLE) / 100.0 AS gross_revenue_dollars,
  CAST(sum(trip_count) AS BIGINT) AS trip_count,
  {ratio('sum(total_amount_cents_sum)', '100.0 * CAST(sum(trip_count) AS DOUBLE)')} AS revenue_per_trip_dollars,
  {ratio(fsum('tip_amount_cents_sum', 'payment_type_key = 1'), fsum('fare_amount_cents_sum', 'payment_type_key = 1'), '100.0')} AS recorded_card_tip_rate
FROM mv WHERE {MONTH_WHERE} AND {FIN} GROUP BY {dim}_key, {dim}_label""")


ORACLES["breakdown_payment"] = _breakdown("payment_type")
ORACLES["breakdown_vendor"] = _breakdown("vendor")
ORACLES["breakdown_rate"] = _breakdown("rate_code")

ORACLES["revenue_components"] = q(f"""
SELECT CAST(sum(fare_amount_cents_sum) AS DOUBLE) / 100.0 AS fare,
  CAST(sum(extra_cents_sum) AS DOUBLE) / 100.0 AS extra,
  CAST(sum(mta_tax_cents_sum) AS DOUBLE) / 100.0 AS mta_tax,
  CAST(sum(tip_amount_cents_sum) AS DOUBLE) / 100.0 AS tips,
  CAST(sum(tolls_amount_cents_sum) AS DOUBLE) / 100.0 AS tolls,
  CAST(sum(improvement_surcharge_cents_sum) AS DOUBLE) / 100.0 AS improvement_surcharge,
  CAST(sum(congestion_surcharge_cents_sum) AS DOUBLE) / 100.0 AS congestion_surcharge,
  CAST(sum(airport_fee_cents_sum) AS DOUBLE) / 100.0 AS airport_fee
FROM mv WHERE {MONTH_WHERE} AND {FIN}""")

ORACLES["avg_fare_per_mile"] = q("""
SELECT pickup_date_key,
  CASE WHEN sum(distance_millimiles) <> 0 THEN
    CAST((2 * 1000 * CAST(sum(fare_amount_cents) AS BIGINT) + CAST(sum(distance_millimiles) AS BIGINT))
         // (2 * CAST(sum(distance_millimiles) AS BIGINT)) AS DOUBLE) / 100.0 END AS avg_fare_per_mile_dollars
FROM facts WHERE NOT has_statistical_outlier GROUP BY pickup_date_key""")

ORACLES["peak_hours"] = q("""
SELECT t.hour AS pickup_hour, t.daypart, lpad(CAST(t.hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
  CAST(count(*) AS BIGINT) AS trip_count
FROM facts f JOIN time_dim t ON f.pickup_time_key = t.time_key
GROUP BY t.hour, t.daypart""")

ORACLES["filter_options"] = q("""
SELECT DISTINCT 'zone' AS option_kind, CAST(pickup_zone_key AS INTEGER) AS option_key, pickup_zone_label AS option_label FROM mv
UNION ALL SELECT DISTINCT 'payment', CAST(payment_type_key AS INTEGER), payment_type_label FROM mv
UNION ALL SELECT DISTINCT 'vendor', CAST(vendor_key AS INTEGER), vendor_label FROM mv
UNION ALL SELECT DISTINCT 'rate', CAST(rate_code_key AS INTEGER), rate_code_label FROM mv
UNION ALL SELECT DISTINCT 'borough', CAST(NULL AS INTEGER), pickup_borough FROM mv WHERE pickup_borough IS NOT NULL""")

ORACLES["date_coverage"] = q("SELECT min(pickup_date) AS minimum_date, max(pickup_date) AS maximum_date FROM mv")

EXPLORER_VIEW = """
ev AS (
  SELECT f.source_row_number AS trip_key, f.source_month, f.pickup_at_local, f.dropoff_at_local,
    pz.label AS pickup_zone_label, pz.borough AS pickup_borough, dz.label AS dropoff_zone_label,
    p.label AS payment_type_label, v.label AS vendor_label, r.label AS rate_code_label,
    f.passenger_count, f.distance_millimiles,
    CAST(f.distance_millimiles AS DOUBLE) / 1000.0 AS distance_miles,
    CAST(f.duration_seconds AS DOUBLE) / 60.0 AS duration_minutes,
    CAST(f.fare_amount_cents AS DOUBLE) / 100.0 AS fare_amount_dollars,
    CAST(f.tip_amount_cents AS DOUBLE) / 100.0 AS tip_amount_dollars,
    f.total_amount_cents,
    CAST(f.total_amount_cents AS DOUBLE) / 100.0 AS total_amount_dollars,
    f.has_statistical_outlier, f.has_quality_issue
  FROM facts f
  JOIN zone_dim pz ON pz.business_key = f.pickup_zone_key
  JOIN zone_dim dz ON dz.business_key = f.dropoff_zone_key
  JOIN payment_dim p ON p.business_key = f.payment_type_key
  JOIN vendor_dim v ON v.business_key = f.vendor_key
  JOIN rate_dim r ON r.business_key = f.rate_code_key)"""

PAGE_COLS = """pickup_at_local, trip_key, dropoff_at_local, pickup_zone_label, dropoff_zone_label,
  payment_type_label, vendor_label, rate_code_label, passenger_count, distance_miles, duration_minutes,
  fare_amount_dollars, tip_amount_dollars, total_amount_dollars, has_statistical_outlier, has_quality_issue"""

EXPLORER_WHERE = """source_month BETWEEN '2024-01' AND '2024-01'
  AND pickup_at_local >= TIMESTAMP '2024-01-01 00:00:00' AND pickup_at_local < TIMESTAMP '2024-02-01 00:00:00'
  AND distance_millimiles >= 1000 AND total_amount_cents <= 10000"""


def _page(op: str, order: str) -> str:
    return qx(EXPLORER_VIEW + f""",
page AS (
  SELECT {PAGE_COLS} FROM ev
  WHERE {EXPLORER_WHERE}
    AND (pickup_at_local {op} TIMESTAMP '2024-01-15 12:00:00'
         OR (pickup_at_local = TIMESTAMP '2024-01-15 12:00:00' AND trip_key {op} 0))
  ORDER BY pickup_at_local {order}, trip_key {order} LIMIT 101),
ranked AS (SELECT *, row_number() OVER (ORDER BY pickup_at_local {order}, trip_key {order}) AS rn,
  count(*) OVER () > 100 AS has_more FROM page)""", f"SELECT {PAGE_COLS}, has_more FROM ranked WHERE rn <= 100")


ORACLES["explorer_page_next"] = _page(">", "ASC")
ORACLES["explorer_page_previous"] = _page("<", "DESC")
ORACLES["explorer_file_page_next"] = ORACLES["explorer_page_next"]
ORACLES["explorer_file_page_previous"] = ORACLES["explorer_page_previous"]

CUR = "pickup_date_key BETWEEN 20240116 AND 20240131"
PRI = "pickup_date_key BETWEEN 20231231 AND 20240115"
SPAN = "source_month BETWEEN '2023-12' AND '2024-01' AND pickup_date_key BETWEEN 20231231 AND 20240131"

ORACLES["zone_movers"] = qx(f"""
g AS (SELECT pickup_zone_key, pickup_zone_label, {fsum('trip_count', CUR)} AS cur, {fsum('trip_count', PRI)} AS pri
      FROM mv WHERE {SPAN} GROUP BY pickup_zone_key, pickup_zone_label)""", """
SELECT pickup_zone_label,
  100.0 * (COALESCE(CAST(cur AS DOUBLE), 0.0) - CAST(pri AS DOUBLE)) / CAST(pri AS DOUBLE) AS change_percent
FROM g WHERE cur IS NOT NULL AND pri IS NOT NULL AND CAST(pri AS DOUBLE) <> 0
ORDER BY change_percent DESC, pickup_zone_label LIMIT 10""")

ORACLES["payment_movers"] = qx(f"""
g AS (SELECT payment_type_key, payment_type_label, {fsum('total_amount_cents_sum', CUR)} AS cur,
        {fsum('total_amount_cents_sum', PRI)} AS pri
      FROM mv WHERE {SPAN} AND {FIN} GROUP BY payment_type_key, payment_type_label)""", """
SELECT payment_type_label,
  100.0 * (COALESCE(CAST(cur AS DOUBLE), 0.0) - CAST(pri AS DOUBLE)) / CAST(pri AS DOUBLE) AS change_percent
FROM g WHERE cur IS NOT NULL AND pri IS NOT NULL AND CAST(pri AS DOUBLE) <> 0
ORDER BY change_percent DESC, payment_type_label LIMIT 10""")


def _period(cond: str, p: str) -> str:
    return f"""CAST(COALESCE(sum(trip_count) FILTER (WHERE {cond}), 0) AS BIGINT) AS trip_count_{p},
  CAST(COALESCE(sum(total_amount_cents_sum) FILTER (WHERE {cond} AND {FIN}), 0) AS DOUBLE) / 100.0 AS gross_revenue_dollars_{p},
  {ratio(fsum('fare_amount_cents_sum', cond + ' AND ' + FIN), fsum('distance_millimiles_sum', cond + ' AND ' + FIN), '10.0')} AS fare_per_mile_dollars_{p}"""


def _delta(cur: str, pri: str) -> str:
    return (f"CASE WHEN CAST({pri} AS DOUBLE) IS NOT NULL AND CAST({pri} AS DOUBLE) <> 0 THEN "
            f"100.0 * (CAST({cur} AS DOUBLE) - CAST({pri} AS DOUBLE)) / CAST({pri} AS DOUBLE) END")


ORACLES["kpi_comparison"] = qx(f"""
k AS (SELECT {_period(CUR, 'current')}, {_period(PRI, 'prior')} FROM mv WHERE {SPAN})""", f"""
SELECT *, {_delta('trip_count_current', 'trip_count_prior')} AS trip_count_delta_percent,
  {_delta('gross_revenue_dollars_current', 'gross_revenue_dollars_prior')} AS gross_revenue_delta_percent
FROM k""")

ORACLES["zone_quantile_classes"] = qx(ZONES + """,
zr AS (SELECT *, row_number() OVER (ORDER BY trip_count) - 1 AS pos, count(*) OVER () AS n FROM z),
cuts AS (SELECT
  max(CASE WHEN pos = least(n - 1, (n * 1) // 5) THEN trip_count END) AS c1,
  max(CASE WHEN pos = least(n - 1, (n * 2) // 5) THEN trip_count END) AS c2,
  max(CASE WHEN pos = least(n - 1, (n * 3) // 5) THEN trip_count END) AS c3,
  max(CASE WHEN pos = least(n - 1, (n * 4) // 5) THEN trip_count END) AS c4 FROM zr)""", """
SELECT z.*, CAST(least(CAST(c1 <= trip_count AS INTEGER) + CAST(c2 <= trip_count AS INTEGER)
  + CAST(c3 <= trip_count AS INTEGER) + CAST(c4 <= trip_count AS INTEGER), 4) AS INTEGER) AS quantile_class
FROM z CROSS JOIN cuts""")

ORACLES["latest_run_state"] = q("""
SELECT '2024-01' AS source_month, 'success' AS status,
  CAST(count(*) AS BIGINT) AS source_rows,
  CAST(count(*) FILTER (WHERE NOT is_rejected) AS BIGINT) AS accepted_rows,
  CAST(count(*) FILTER (WHERE is_rejected) AS BIGINT) AS rejected_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM flagged WHERE any_flag) AS flagged_rows,
  CAST(count(*) FILTER (WHERE NOT is_rejected) AS BIGINT) AS loaded_rows,
  CAST(count(*) FILTER (WHERE NOT is_rejected) AS BIGINT) AS published_rows,
  TRUE AS is_synthetic, '1' AS warehouse_version
FROM classified""")

ORACLES["quality_summary"] = qx(ISSUES, """
SELECT source_month, issue_code, 'warning' AS severity, CAST(count(*) AS BIGINT) AS row_count
FROM issues GROUP BY source_month, issue_code""")

_SECRET = r"(?i)\b(password|secret|token|authorization|cookie|credential|api[-_]?key)\s*[:=]\s*[^\s,;}]+"

ORACLES["redacted_payloads"] = f"""
WITH m AS (
  SELECT *, regexp_replace(text, '{_SECRET}', '\\1=[REDACTED]', 'g') AS t,
    regexp_replace(source, '{_SECRET}', '\\1=[REDACTED]', 'g') AS s FROM documents)
SELECT doc_id, t AS event, s AS service, '[REDACTED]' AS api_key, '[OMITTED]' AS note,
  '{{"password":"[REDACTED]","pod":' || to_json(s) || ',"owner":"[OMITTED]"}}' AS labels,
  '["{{\\"token\\":\\"[REDACTED]\\",\\"status\\":' || replace(to_json(s), '"', '\\"') || '}}","secret=[REDACTED]"]' AS alerts
FROM m"""

ZONE_SNAPSHOTS = """
za AS (
  SELECT n.n_nationkey + 1 AS business_key, n.n_name AS label,
         'borough=' || r.r_name || ', service_zone=' || r.r_name AS attributes
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
cust AS (
  SELECT n.n_nationkey + 1 AS business_key, r.r_name, COALESCE(c.customers, 0) AS customers
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey) c
    ON c.c_nationkey = n.n_nationkey),
zb AS (
  SELECT a.business_key, a.label,
    'borough=' || c.r_name || ', service_zone=' ||
      CASE WHEN c.customers > (SELECT avg(customers) FROM cust) THEN 'High demand' ELSE c.r_name END AS attributes
  FROM za a JOIN cust c USING (business_key)),
hist AS (
  SELECT 0 AS business_key, 'Unknown' AS label, CAST(NULL AS VARCHAR) AS attributes,
    TIMESTAMP '1970-01-01 00:00:00' AS observed_from, CAST(NULL AS TIMESTAMP) AS observed_to, TRUE AS is_current
  UNION ALL
  SELECT a.business_key, a.label, a.attributes, TIMESTAMP '2024-01-01 00:00:00',
    CASE WHEN a.label IS DISTINCT FROM b.label OR a.attributes IS DISTINCT FROM b.attributes
         THEN TIMESTAMP '2024-01-16 00:00:00' END,
    NOT (a.label IS DISTINCT FROM b.label OR a.attributes IS DISTINCT FROM b.attributes)
  FROM za a JOIN zb b USING (business_key)
  UNION ALL
  SELECT b.business_key, b.label, b.attributes, TIMESTAMP '2024-01-16 00:00:00', CAST(NULL AS TIMESTAMP), TRUE
  FROM za a JOIN zb b USING (business_key)
  WHERE a.label IS DISTINCT FROM b.label OR a.attributes IS DISTINCT FROM b.attributes)"""

ORACLES["scd2_zone_history"] = qx(ZONE_SNAPSHOTS, "SELECT * FROM hist")

ORACLES["asof_zone_join"] = qx(ZONE_SNAPSHOTS, """
SELECT f.pickup_zone_key, h.attributes AS zone_attributes, CAST(count(*) AS BIGINT) AS trip_count
FROM facts f LEFT JOIN hist h
  ON h.business_key = f.pickup_zone_key AND h.observed_from <= f.pickup_at_local
 AND (h.observed_to IS NULL OR f.pickup_at_local < h.observed_to)
GROUP BY f.pickup_zone_key, h.attributes""")

ORACLES["sliding_window_events"] = qx("""
wb AS (SELECT payment_type_id, total_amount_cents, distance_millimiles, has_statistical_outlier,
         epoch_us(pickup_at_local) // 900000000 * 900000000 AS b FROM accepted),
wx AS (SELECT payment_type_id, total_amount_cents, distance_millimiles, has_statistical_outlier, b - k * 900000000 AS s
       FROM wb, (VALUES (CAST(0 AS BIGINT)), (1), (2), (3)) t(k))""", """
SELECT make_timestamp(s) AS window_start, make_timestamp(s + 3600000000) AS window_end, payment_type_id,
  CAST(count(*) AS BIGINT) AS trip_count, CAST(sum(total_amount_cents) AS BIGINT) AS total_amount_cents_sum,
  CAST(sum(distance_millimiles) AS BIGINT) AS distance_millimiles_sum,
  count(*) FILTER (has_statistical_outlier) AS outlier_count
FROM wx GROUP BY s, payment_type_id""")

ORACLES["unknown_zone_issues"] = q("""
SELECT '2024-01' AS source_month, issue_code, CAST(count(*) AS BIGINT) AS row_count FROM (
  SELECT 'UNKNOWN_PICKUP_ZONE' AS issue_code FROM converted
  WHERE pickup_location_id NOT IN (SELECT business_key FROM zone_dim WHERE business_key <> 0)
  UNION ALL
  SELECT 'UNKNOWN_DROPOFF_ZONE' FROM converted
  WHERE dropoff_location_id NOT IN (SELECT business_key FROM zone_dim WHERE business_key <> 0))
GROUP BY issue_code""")

ORACLES["outlier_issue_rows"] = q("""
SELECT '2024-01' AS source_month, source_row_number, 'STAT_OUTLIER_DURATION' AS issue_code,
  duration_seconds AS metric_value, g.dur_lo AS low_bound, g.dur_hi AS high_bound
FROM converted, gated g WHERE duration_seconds < g.dur_lo OR duration_seconds > g.dur_hi
UNION ALL
SELECT '2024-01', source_row_number, 'STAT_OUTLIER_DISTANCE', distance_millimiles, g.dist_lo, g.dist_hi
FROM converted, gated g WHERE distance_millimiles < g.dist_lo OR distance_millimiles > g.dist_hi""")

ORACLES["top_zones"] = qx(ZONES, "SELECT * FROM z ORDER BY trip_count DESC, pickup_zone_label LIMIT 20")

ORACLES["peak_hour_headline"] = q(f"""
SELECT pickup_hour, trip_count FROM (
  SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM mv WHERE {MONTH_WHERE} GROUP BY pickup_hour)
ORDER BY trip_count DESC, pickup_hour LIMIT 1""")

ORACLES["reconciliation_bars"] = q("""
SELECT '2024-01' AS source_month,
  CAST(count(*) AS BIGINT) AS source_rows,
  CAST(count(*) FILTER (WHERE NOT is_rejected) AS BIGINT) AS accepted_rows,
  CAST(count(*) FILTER (WHERE is_rejected) AS BIGINT) AS rejected_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM flagged WHERE any_flag) AS flagged_rows,
  CASE WHEN count(*) > 0 THEN 100.0 * CAST(count(*) FILTER (WHERE is_rejected) AS DOUBLE) / CAST(count(*) AS DOUBLE)
       ELSE 0.0 END AS reject_rate_percent,
  CASE WHEN count(*) FILTER (WHERE NOT is_rejected) > 0
       THEN 100.0 * CAST((SELECT count(*) FROM flagged WHERE any_flag) AS DOUBLE)
            / CAST(count(*) FILTER (WHERE NOT is_rejected) AS DOUBLE) ELSE 0.0 END AS flag_rate_percent,
  TRUE AS balanced
FROM classified""")

ORACLES["release_checks"] = q("""
SELECT f.source_month, f.fact_rows, m.mart_trip_total, f.unknown_pickup_zone_rows,
  f.fact_rows = m.mart_trip_total AS mart_matches_facts
FROM (SELECT source_month, CAST(count(*) AS BIGINT) AS fact_rows,
        CAST(count(*) FILTER (WHERE pickup_zone_key = 0) AS BIGINT) AS unknown_pickup_zone_rows
      FROM facts GROUP BY source_month) f
JOIN (SELECT source_month, CAST(sum(trip_count) AS BIGINT) AS mart_trip_total FROM mart GROUP BY source_month) m
  USING (source_month)""")

ORACLES["month_partition_replace"] = """
SELECT strftime(l_shipdate, '%Y-%m') AS source_month, CAST(count(*) AS BIGINT) AS row_count,
  CAST(sum(l_linenumber) AS BIGINT) AS linenumber_sum
FROM lineitem
GROUP BY 1"""

ORACLES["published_versions"] = q("""
SELECT '2024-01' AS source_month, CAST((SELECT count(*) FROM facts) AS BIGINT) AS fact_rows,
  CAST((SELECT sum(trip_count) FROM mart) AS BIGINT) AS mart_trips,
  CAST((SELECT count(*) FROM classified WHERE is_rejected) AS BIGINT) AS quarantined_rows,
  CAST((SELECT sum(CAST(f_unknown_vendor AS INT) + CAST(f_unknown_payment AS INT) + CAST(f_unknown_rate AS INT)
    + CAST(f_invalid_passenger_count AS INT) + CAST(f_null_extra AS INT) + CAST(f_null_mta_tax AS INT)
    + CAST(f_null_tip AS INT) + CAST(f_null_tolls AS INT) + CAST(f_null_improvement AS INT)
    + CAST(f_null_congestion AS INT) + CAST(f_null_airport_fee AS INT)) FROM flagged) AS BIGINT) AS issue_rows""")

ORACLES["stream_progress"] = """
SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS rows_dropped_by_watermark FROM events"""

_IN_RANGE = {"duration_seconds": (0, 86400), "distance_millimiles": (0, 1000000)}

ORACLES["kll_bounds"] = q(" UNION ALL ".join(
    f"SELECT '2024-01' AS source_month, '{m}' AS metric, count(*) AS n, TRUE AS low_rank_ok, TRUE AS high_rank_ok "
    f"FROM converted WHERE {m} > {lo} AND {m} < {hi}" for m, (lo, hi) in _IN_RANGE.items()))

ORACLES["derived_metric_bounds"] = q("""
SELECT '2024-01' AS source_month, 'speed_mph' AS metric, count(*) AS n, TRUE AS low_rank_ok, TRUE AS high_rank_ok
FROM converted WHERE duration_seconds > 0
UNION ALL
SELECT '2024-01', 'fare_per_mile', count(*), TRUE, TRUE FROM converted WHERE distance_millimiles > 0""")

# The second carrier: one trip per lineitem row, in the month of its ship date.
_LINEITEM_TRIPS = """
li AS (
  SELECT *, l_orderkey * 10 + l_linenumber AS rn, strftime(l_shipdate, '%Y-%m') AS source_month
  FROM lineitem WHERE l_shipdate IS NOT NULL),
li_trips AS (
  SELECT source_month, rn, l_shipdate + to_minutes(CAST(rn % 1440 AS INT)) AS pickup,
    60 + l_partkey % 100 * 30 AS duration_seconds,
    CAST(round_even(l_quantity / 10.0 * 1000.0, 0) AS BIGINT) AS distance_millimiles,
    CAST(round_even(l_extendedprice / 100.0 * 100.0, 0) AS BIGINT) AS fare_cents,
    CAST(round_even(l_extendedprice / 100.0 * 1.25 * 100.0, 0) AS BIGINT) AS total_cents,
    rn % 89 = 0 OR rn % 31 = 0 OR rn % 41 = 0 OR l_quantity <= 0 OR l_extendedprice < 0 AS is_rejected
  FROM li),
li_ok AS (SELECT * FROM li_trips WHERE NOT is_rejected)"""

ORACLES["monthly_reject_counts"] = f"""
WITH {_LINEITEM_TRIPS}
SELECT source_month, count(*) AS source_rows, count(*) FILTER (NOT is_rejected) AS accepted_rows,
  count(*) FILTER (is_rejected) AS rejected_rows, CAST(0 AS BIGINT) AS flagged_rows, CAST(0 AS BIGINT) AS issue_rows
FROM li_trips GROUP BY source_month"""

ORACLES["monthly_bounds"] = f"""
WITH {_LINEITEM_TRIPS}
SELECT source_month, """ + ", ".join(
    f"CAST(quantile_disc(CASE WHEN {m} > {lo} AND {m} < {hi} THEN {m} END, {share}) AS BIGINT) AS {m}_{side}"
    for m, (lo, hi) in _IN_RANGE.items() for side, share in (("low", 0.001), ("high", 0.999))) + """
FROM li_ok GROUP BY source_month"""

ORACLES["calibration_thresholds"] = f"WITH {_LINEITEM_TRIPS} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, count(*) FILTER ({m} > {lo} AND {m} < {hi}) AS n, TRUE AS low_rank_ok, TRUE AS high_rank_ok, "
    f"CAST(count(DISTINCT source_month) AS INT) AS months, CAST(4096 AS INT) AS k FROM li_ok" for m, (lo, hi) in _IN_RANGE.items())



def _month_kpis(month: str, period: str) -> str:
    return f"""(SELECT count(*) AS trips_{period}, CAST(COALESCE(sum(total_cents), 0) AS DOUBLE) / 100.0 AS revenue_{period},
      10.0 * CAST(sum(fare_cents) AS DOUBLE) / NULLIF(CAST(sum(distance_millimiles) AS DOUBLE), 0) AS per_mile_{period}
      FROM li_ok WHERE source_month = '{month}') k_{period}"""


ORACLES["full_month_comparison"] = f"""
WITH {_LINEITEM_TRIPS}
SELECT CAST(trips_current AS BIGINT) AS trip_count_current, revenue_current AS gross_revenue_dollars_current,
  per_mile_current AS fare_per_mile_dollars_current, CAST(trips_prior AS BIGINT) AS trip_count_prior,
  revenue_prior AS gross_revenue_dollars_prior, per_mile_prior AS fare_per_mile_dollars_prior,
  100.0 * (CAST(trips_current AS DOUBLE) - trips_prior) / NULLIF(CAST(trips_prior AS DOUBLE), 0) AS trip_count_delta_percent,
  100.0 * (revenue_current - revenue_prior) / NULLIF(revenue_prior, 0) AS gross_revenue_delta_percent
FROM {_month_kpis('1995-03', 'current')}, {_month_kpis('1995-02', 'prior')}"""

ORACLES["latest_fingerprints"] = "SELECT '2024-01' AS source_month, CAST(count(*) AS BIGINT) AS row_count, TRUE AS is_synthetic FROM events"

ORACLES["latest_thresholds"] = "SELECT '2024-01' AS source_month, CAST(NULL AS VARCHAR) AS threshold_version_id, TRUE AS has_snapshot"

# Rows of the dashboard's frames: distinct group keys of the mart in each period (16th to 31st, and the 16 days before).
_NOW, _BEFORE = "pickup_date_key BETWEEN 20240116 AND 20240131", "pickup_date_key BETWEEN 20231231 AND 20240115"
_FIN = "NOT has_statistical_outlier"
_FRAMES = {
    "kpis": "1", "comparison_kpis": "1", "components": "1", "publications": "1", "fingerprints": "1", "thresholds": "1", "alerts": "0",
    "daily": f"(SELECT count(DISTINCT pickup_date_key) FROM mv WHERE {_NOW})",
    "hourly": f"(SELECT count(DISTINCT pickup_hour) FROM mv WHERE {_NOW})",
    "heatmap": f"(SELECT count(DISTINCT (weekday_number, pickup_hour)) FROM mv WHERE {_NOW})",
    "quality": "(SELECT " + " + ".join(f"CAST(bool_or({f}) AS INT)" for f in (
        "f_unknown_vendor", "f_unknown_payment", "f_unknown_rate", "f_invalid_passenger_count", "f_null_extra", "f_null_mta_tax", "f_null_tip",
        "f_null_tolls", "f_null_improvement", "f_null_congestion", "f_null_airport_fee")) + " FROM flagged)",
}
for _period, _prefix in ((_NOW, ""), (_BEFORE, "comparison_")):
    _FRAMES[f"{_prefix}zones"] = f"(SELECT count(DISTINCT pickup_zone_key) FROM mv WHERE {_period})"
    for _name, _key in (("payments", "payment_type_key"), ("vendors", "vendor_key"), ("rates", "rate_code_key")):
        _FRAMES[f"{_prefix}{_name}"] = f"(SELECT count(DISTINCT {_key}) FROM mv WHERE {_period} AND {_FIN})"

ORACLES["dashboard_frames"] = q(" UNION ALL ".join(f"SELECT '{name}' AS frame, CAST({count} AS BIGINT) AS n_rows" for name, count in _FRAMES.items()))

# --- observation history, as-of joins, contracts per file, bounded backfills, positions -----------------

_STATES = """
obs AS (
  SELECT c_custkey AS business_key, c_mktsegment AS label, 'nation=' || c_nationkey AS attributes, 1 AS i FROM customer
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END, 'nation=' || c_nationkey, 2
  FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 10 <> 0 THEN 'MOVED' ELSE c_mktsegment END,
    'nation=' || (CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 100 ELSE c_nationkey END), 3
  FROM customer WHERE c_custkey % 13 <> 0),
taken(i, seen_at) AS (VALUES (1, TIMESTAMP '2024-01-01'), (2, TIMESTAMP '2024-02-01'), (3, TIMESTAMP '2024-03-01'))"""

ORACLES["scd2_customer_history"] = f"""
WITH {_STATES},
opened AS (
  SELECT o.*, t.seen_at FROM obs o JOIN taken t USING (i)
  QUALIFY lag(label || '/' || attributes) OVER (PARTITION BY business_key ORDER BY i) IS DISTINCT FROM label || '/' || attributes)
SELECT business_key, label, attributes, seen_at AS observed_from,
  lead(seen_at) OVER (PARTITION BY business_key ORDER BY i) AS observed_to,
  lead(seen_at) OVER (PARTITION BY business_key ORDER BY i) IS NULL AS is_current
FROM opened WHERE business_key <> 0"""

ORACLES["scd2_customer_gaps"] = f"""
WITH {_STATES},
grid AS (
  SELECT k.business_key, t.i, t.seen_at, o.label, o.attributes
  FROM (SELECT DISTINCT business_key FROM obs WHERE business_key <> 0) k CROSS JOIN taken t
  LEFT JOIN obs o ON o.business_key = k.business_key AND o.i = t.i),
turns AS (
  SELECT * FROM grid
  QUALIFY i = 1 OR lag(label || '/' || attributes) OVER (PARTITION BY business_key ORDER BY i) IS DISTINCT FROM label || '/' || attributes),
ends AS (SELECT *, lead(seen_at) OVER (PARTITION BY business_key ORDER BY i) AS until FROM turns)
SELECT business_key, label, attributes, seen_at AS observed_from, until AS observed_to, until IS NULL AS is_current
FROM ends WHERE label IS NOT NULL"""

ORACLES["asof_event_versions"] = """
WITH bought AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts)
SELECT e.event_id, e.user_id, b.value AS bought_value, b.ts AS bought_at
FROM events e ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts >= b.ts"""

ORACLES["source_contract_files"] = """
WITH parts AS (SELECT (event_id + 1) % 4 AS part, count(*) AS n FROM events GROUP BY 1),
files(file, part, status, missing_required, extra_columns, incompatible_columns, drifted_columns) AS (VALUES
  ('a', 0, 'VALID', '', '', '', ''), ('b', 1, 'VALID', '', 'zone_note', '', 'VendorID,zone_note'),
  ('c', 2, 'MISSING_COLUMNS', 'tip_amount', '', '', ''), ('d', 3, 'INCOMPATIBLE_TYPES', '', '', 'fare_amount', 'fare_amount'),
  ('e', -1, 'ZERO_ROWS', '', '', '', ''))
SELECT '2024-01' AS source_month, file, status, missing_required, extra_columns, incompatible_columns, drifted_columns,
  CAST(coalesce(n, 0) AS BIGINT) AS row_count
FROM files LEFT JOIN parts USING (part)"""

ORACLES["backfill_windows"] = ORACLES["sliding_window_events"]

ORACLES["backfill_progress"] = q("""
SELECT CAST(5 AS BIGINT) AS batches, CAST(5 AS BIGINT) AS batch_ids,
  (SELECT CAST(count(*) + count(*) FILTER (event_id % 4 = 0) AS BIGINT) FROM events) AS input_rows,
  CAST(count(*) + count(*) FILTER ((source_row_number - 1) % 4 = 0) AS BIGINT) AS accepted_rows,
  CAST(5 AS BIGINT) AS lagging_batches
FROM accepted""")

ORACLES["ranked_orders"] = """
WITH r AS (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS price_position, count(*) OVER () AS n FROM orders),
cuts AS (SELECT list(o_totalprice) AS cut FROM r JOIN (VALUES (1), (2), (3), (4)) t(i) ON price_position = least(n - 1, n * i // 5))
SELECT o_orderkey, CAST(price_position AS BIGINT) AS price_position,
  CAST(least(4, len(list_filter(cut, lambda c: c <= o_totalprice))) AS INT) AS price_class FROM r, cuts"""

ORACLES["redacted_deep_payloads"] = f"""
SELECT doc_id, regexp_replace(text, '{_SECRET}', '\\1=[REDACTED]', 'g') AS event,
  CASE WHEN lang IS NOT NULL THEN '[REDACTED]' END AS token, CASE WHEN source IS NOT NULL THEN '[OMITTED]' END AS owner
FROM documents WHERE text IS NOT NULL"""
