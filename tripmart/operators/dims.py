"""Dimensions: calendar (H1, K14), minute of day (H2), SCD2-shaped reference dimensions
(S6, S7, K5), their integrity checks (J10, J11), the observed-time SCD2 merge (V1, W5)
and the as-of lookup (J12).

Dimensions are small by nature (hundreds of rows); the only unpartitioned windows in the
library are the surrogate numbering here, and they run over dimension rows, never facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.schema import DAYPARTS, PAYMENT_TYPE_LOOKUP, RATE_CODE_LOOKUP, VENDOR_LOOKUP

DIM_COLUMNS = ["surrogate_key", "business_key", "label", "attributes", "observed_from", "observed_to", "is_current"]
EPOCH = "1970-01-01 00:00:00"


# ---------------------------------------------------------------------------
# H1 calendar / H2 minute of day
# ---------------------------------------------------------------------------


def calendar_rows(dates: DataFrame, date_col: str = "calendar_date") -> DataFrame:
    """The 13 calendar columns for a frame of dates."""
    d = F.col(date_col)
    iso_dow = F.weekday(d) + 1
    return dates.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        iso_dow.cast("int").alias("weekday_number"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def calendar_for_months(months: DataFrame, month_col: str = "source_month") -> DataFrame:
    """All days of each month plus the first day of the next month (dropoff boundary day)."""
    start = F.to_date(F.concat(F.col(month_col), F.lit("-01")))
    days = months.select(F.explode(F.sequence(start, F.add_months(start, 1))).alias("calendar_date")).distinct()
    return calendar_rows(days)


def calendar_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """H1: calendar rows from ``start`` to ``end`` inclusive (YYYY-MM-DD)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("calendar_date")
    )
    return calendar_rows(days)


def daypart(hour: Column) -> Column:
    expr = None
    for limit, name in DAYPARTS:
        expr = F.when(hour < limit, F.lit(name)) if expr is None else expr.when(hour < limit, F.lit(name))
    return expr


def time_dimension(spark: SparkSession) -> DataFrame:
    """H2: 1,440 minute-of-day rows with hour, minute, quarter hour, label and daypart."""
    base = spark.range(1440).select(F.col("id").cast("int").alias("time_key"))
    hour = F.floor(F.col("time_key") / 60).cast("int")
    minute = (F.col("time_key") % 60).cast("int")
    return base.select(
        "time_key",
        hour.alias("hour"),
        minute.alias("minute"),
        F.floor(minute / 15).cast("int").alias("quarter_hour"),
        F.format_string("%02d:%02d", hour, minute).alias("hour_label"),
        daypart(hour).alias("daypart"),
    )


def add_missing_days(existing: DataFrame, new_days: DataFrame) -> DataFrame:
    """Insert-if-absent on ``date_key`` (anti join), returns the new table contents."""
    fresh = new_days.join(existing.select("date_key"), "date_key", "left_anti")
    return existing.unionByName(fresh)


# ---------------------------------------------------------------------------
# Reference dimensions (SCD2-shaped)
# ---------------------------------------------------------------------------


def _unknown_row(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(0, 0, "Unknown", None, EPOCH, None, True)],
        "surrogate_key int, business_key int, label string, attributes string, "
        "observed_from string, observed_to string, is_current boolean",
    ).select(
        "surrogate_key",
        "business_key",
        "label",
        "attributes",
        F.to_timestamp("observed_from").alias("observed_from"),
        F.to_timestamp("observed_to").alias("observed_to"),
        "is_current",
    )


def empty_dimension(spark: SparkSession) -> DataFrame:
    """A dimension holding only the seeded Unknown member (surrogate 0, business key 0)."""
    return _unknown_row(spark)


def insert_missing(dim: DataFrame, candidates: DataFrame) -> DataFrame:
    """K5: insert-if-absent on ``business_key``; new surrogates are max + row_number by business key.

    ``candidates`` has business_key, label, attributes. Business key 0 is skipped (seeded row).
    Deterministic: same inputs, same surrogates.
    """
    fresh = (
        candidates.filter(F.col("business_key") != 0)
        .dropDuplicates(["business_key"])
        .join(dim.select("business_key"), "business_key", "left_anti")
        .select(
            F.lit(None).cast("int").alias("surrogate_key"),
            F.col("business_key").cast("int").alias("business_key"),
            "label",
            F.col("attributes").cast("string").alias("attributes"),
            F.to_timestamp(F.lit(EPOCH)).alias("observed_from"),
            F.lit(None).cast("timestamp").alias("observed_to"),
            F.lit(True).alias("is_current"),
        )
    )
    return _number_new_rows(dim.select(*DIM_COLUMNS).unionByName(fresh))


def _number_new_rows(rows: DataFrame) -> DataFrame:
    """Give rows without a surrogate key ``max(existing) + row_number()`` by business key.

    Both windows run over dimension rows only (small by nature), so no join is needed to
    carry the current maximum to the new rows.
    """
    everything = Window.partitionBy()
    top = F.coalesce(F.max("surrogate_key").over(everything), F.lit(0))
    rank = F.row_number().over(Window.partitionBy(F.col("surrogate_key").isNull()).orderBy("business_key"))
    return rows.withColumn(
        "surrogate_key", F.coalesce(F.col("surrogate_key"), (top + rank).cast("int"))
    ).select(*DIM_COLUMNS)


def lookup_dimension(spark: SparkSession, lookup: dict[int, str]) -> DataFrame:
    """A reference dimension from a fixed lookup (vendor, payment type, rate code)."""
    cands = spark.createDataFrame(
        [(k, v, None) for k, v in lookup.items()], "business_key int, label string, attributes string"
    )
    return insert_missing(empty_dimension(spark), cands)


def vendor_dimension(spark: SparkSession) -> DataFrame:
    return lookup_dimension(spark, VENDOR_LOOKUP)


def payment_dimension(spark: SparkSession) -> DataFrame:
    return lookup_dimension(spark, PAYMENT_TYPE_LOOKUP)


def rate_dimension(spark: SparkSession) -> DataFrame:
    return lookup_dimension(spark, RATE_CODE_LOOKUP)


def zone_attributes(borough: Column, service_zone: Column) -> Column:
    """H3: packed ``borough=..., service_zone=...`` attribute string."""
    return F.concat(F.lit("borough="), borough, F.lit(", service_zone="), service_zone)


def borough_of(attributes: Column) -> Column:
    """NULLIF(split_part(split_part(attributes, 'borough=', 2), ',', 1), '')."""
    part = F.split_part(F.split_part(attributes, F.lit("borough="), F.lit(2)), F.lit(","), F.lit(1))
    return F.nullif(part, F.lit(""))


def zone_candidates_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones on the driver tables: business key = nation key + 1, label = nation name,
    borough and service zone = region name."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1).cast("int").alias("business_key"),
        F.col("n_name").alias("label"),
        zone_attributes(F.col("r_name"), F.col("r_name")).alias("attributes"),
    )


def zone_demand_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later zone snapshot on the driver tables: zones whose customer count is above the
    average per zone move to service zone 'High demand' (an SCD2 attribute change)."""
    base = zone_candidates_from_tables(spark, sf_dir)
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_regionkey")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    customers = (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    per_zone = nation.join(customers, nation.n_nationkey == customers.c_nationkey, "left").select(
        (F.col("n_nationkey") + 1).cast("int").alias("business_key"),
        "n_regionkey",
        F.coalesce(F.col("customers"), F.lit(0)).alias("customers"),
    )
    busy = per_zone.withColumn("_avg", F.avg("customers").over(Window.partitionBy())).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    service = F.when(F.col("customers") > F.col("_avg"), F.lit("High demand")).otherwise(F.col("r_name"))
    attrs = busy.select("business_key", zone_attributes(F.col("r_name"), service).alias("_attrs"))
    return base.join(attrs, "business_key").select("business_key", "label", F.col("_attrs").alias("attributes"))


def zone_candidates_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (LocationID, Borough, Zone, service_zone); id 0 skipped by K5."""
    from tripmart.schema import ZONE_CSV

    csv = spark.read.option("header", True).schema(ZONE_CSV).csv(path)
    return csv.select(
        F.col("LocationID").alias("business_key"),
        F.col("Zone").alias("label"),
        zone_attributes(F.col("Borough"), F.col("service_zone")).alias("attributes"),
    )


def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_missing(empty_dimension(spark), zone_candidates_from_tables(spark, sf_dir))


def current_keys(dim: DataFrame) -> DataFrame:
    """J1 input: business key -> surrogate key over current rows only."""
    return dim.filter("is_current").select("business_key", "surrogate_key")


# ---------------------------------------------------------------------------
# Integrity checks
# ---------------------------------------------------------------------------


def multiple_current_rows(dim: DataFrame) -> DataFrame:
    """Business keys with more than one current row (must be empty)."""
    return (
        dim.filter("is_current")
        .groupBy("business_key")
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .filter(F.col("current_rows") > 1)
    )


def overlapping_versions(dim: DataFrame) -> DataFrame:
    """Versions of one business key whose validity intervals overlap (must be empty).

    A version overlaps an earlier one exactly when it starts before the latest end of all that started
    before it, so one running maximum replaces the self-join.
    """
    before = Window.partitionBy("business_key").orderBy("observed_from", "surrogate_key").rowsBetween(Window.unboundedPreceding, -1)
    prev_to = F.max(F.coalesce(F.col("observed_to"), F.to_timestamp(F.lit("9999-12-31")))).over(before)
    return (
        dim.select("business_key", "surrogate_key", "observed_from", "observed_to", prev_to.alias("_prev_to"))
        .filter(F.col("_prev_to").isNotNull() & (F.col("observed_from") < F.col("_prev_to")))
        .drop("_prev_to")
    )


# ---------------------------------------------------------------------------
# V1 observed-time SCD2 merge and J12 as-of lookup
# ---------------------------------------------------------------------------


def row_hash(*cols: str) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)


def scd2_merge(dim: DataFrame, snapshot: DataFrame, observed_at: Column) -> DataFrame:
    """V1: merge a snapshot (business_key, label, attributes) observed at ``observed_at``.

    Changed keys: the current row is closed at ``observed_at`` and a successor is opened.
    New keys: inserted. Unchanged keys and keys missing from the snapshot: kept as they are.
    One full-outer join on business key over current rows; history rows pass through.
    New surrogates continue after the current maximum, numbered by business key. A snapshot that changes
    a row observed after it is an error: ``history.history`` takes late snapshots, from their log.
    """
    cols = ["business_key", "label", "attributes"]
    cur = dim.filter("is_current").select(
        *DIM_COLUMNS, row_hash("label", "attributes").alias("_h_old")
    )
    history = dim.filter(~F.col("is_current")).select(*DIM_COLUMNS)
    snap = snapshot.filter(F.col("business_key") != 0).select(
        *[F.col(c).alias(f"_n_{c}") for c in cols], row_hash("label", "attributes").alias("_h_new")
    )
    j = cur.join(snap, cur.business_key == snap._n_business_key, "full_outer")
    changed = F.col("surrogate_key").isNotNull() & F.col("_h_new").isNotNull() & (F.col("_h_old") != F.col("_h_new"))
    new_key = F.col("surrogate_key").isNull()
    kept = j.filter(F.col("surrogate_key").isNotNull()).select(
        "surrogate_key",
        "business_key",
        "label",
        "attributes",
        "observed_from",
        F.when(changed & (observed_at.cast("timestamp") <= F.col("observed_from")), F.raise_error(F.lit("late snapshot: rebuild the history from the observation log")).cast("timestamp"))
        .when(changed, observed_at).otherwise(F.col("observed_to")).alias("observed_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    )
    opened = j.filter(changed | new_key).select(
        F.lit(None).cast("int").alias("surrogate_key"),
        F.col("_n_business_key").cast("int").alias("business_key"),
        F.col("_n_label").alias("label"),
        F.col("_n_attributes").alias("attributes"),
        observed_at.cast("timestamp").alias("observed_from"),
        F.lit(None).cast("timestamp").alias("observed_to"),
        F.lit(True).alias("is_current"),
    )
    return _number_new_rows(history.unionByName(kept).unionByName(opened))


def asof_lookup(facts: DataFrame, dim: DataFrame, key_col: str, time_col: str, prefix: str) -> DataFrame:
    """Pin each fact to the dimension version valid at ``time_col``:
    equi join on business key, then ``observed_from <= t < observed_to`` (open end = current).

    The equi key keeps this a hash/broadcast join; the range test is a post-join filter
    over the few versions of one key. Facts without a valid version keep null columns.
    """
    d = dim.select(
        F.col("business_key").alias(f"_{prefix}_bk"),
        F.col("surrogate_key").alias(f"{prefix}_version_key"),
        F.col("label").alias(f"{prefix}_label"),
        F.col("attributes").alias(f"{prefix}_attributes"),
        F.col("observed_from").alias(f"_{prefix}_from"),
        F.col("observed_to").alias(f"_{prefix}_to"),
    )
    t = F.col(time_col).cast("timestamp")
    cond = (
        (F.col(key_col) == F.col(f"_{prefix}_bk"))
        & (F.col(f"_{prefix}_from") <= t)
        & (F.col(f"_{prefix}_to").isNull() | (t < F.col(f"_{prefix}_to")))
    )
    return facts.join(d, cond, "left").drop(f"_{prefix}_bk", f"_{prefix}_from", f"_{prefix}_to")
