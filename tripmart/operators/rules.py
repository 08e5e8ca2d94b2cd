"""Row rules: reject masks and codes (P4-P13), quality flags (P14-P16), issue rows (P17),
reconciliation counts (A1-A3) and dataset gates (G1, G6, G7).

All rules are row-local Column expressions, so the classified frame is a narrow
projection of the scan: no shuffle, whole-stage codegen end to end. Month bounds are
computed from the ``source_month`` column, so one job can classify many months.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schema import (
    KEY_COLUMNS,
    MAX_DOLLARS,
    MAX_KEY,
    MAX_MILES,
    MONTH_WINDOW_HOURS,
    NON_FINITE_COLUMNS,
    NULLABLE_MONEY_FLAGS,
    PAYMENT_TYPE_LOOKUP,
    RATE_CODE_LOOKUP,
    VENDOR_LOOKUP,
)


def month_start(month: Column | str = "source_month") -> Column:
    """First instant of the month as TIMESTAMP_NTZ."""
    m = F.col(month) if isinstance(month, str) else month
    return F.to_timestamp_ntz(F.concat(m, F.lit("-01")))


def month_end(month: Column | str = "source_month") -> Column:
    """First instant of the following month (December rolls to January)."""
    return month_start(month) + F.expr("INTERVAL 1 MONTH")


def month_key_bounds(month: Column | str = "source_month") -> tuple[Column, Column]:
    """Date-key bounds [start, end) of a month as YYYYMMDD integers."""
    start = month_start(month)
    end = month_end(month)
    return date_key(start), date_key(end)


def date_key(ts: Column) -> Column:
    """YYYYMMDD as int, by arithmetic (no string formatting in the hot path)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """Minute of day 0..1439."""
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


def _non_finite(c: str) -> Column:
    col = F.col(c)
    return col.isNotNull() & (F.isnan(col) | (F.abs(col) == F.lit(float("inf"))))


def reject_masks(columns: list[str] | None = None) -> list[tuple[str, Column]]:
    """(code, mask) pairs; every mask is never null."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    dist, fare, total = F.col("trip_distance"), F.col("fare_amount"), F.col("total_amount")
    both = pickup.isNotNull() & dropoff.isNotNull()
    start, end = month_start(), month_end()
    window_end = end + F.expr(f"INTERVAL {MONTH_WINDOW_HOURS} HOURS")
    present = [c for c in NON_FINITE_COLUMNS if columns is None or c in columns]
    non_finite = reduce(or_, [_non_finite(c) for c in present]) if present else F.lit(False)
    # Values that do not fit the warehouse's integers, alone or summed (an ANSI cast or sum would
    # end the job), and ids or counts that are no 32-bit integer.
    too_big = [F.abs(F.col(c)) >= (MAX_MILES if c == "trip_distance" else MAX_DOLLARS) for c in present]
    out_of_range = reduce(or_, too_big) & ~non_finite if too_big else F.lit(False)
    keys = [F.col(c).cast("double") for c in KEY_COLUMNS if columns is None or c in columns]
    bad_key = reduce(or_, [F.isnan(k) | (F.abs(k) > MAX_KEY) for k in keys]) if keys else F.lit(False)
    masks = [
        ("MISSING_PICKUP", pickup.isNull()),
        ("MISSING_DROPOFF", dropoff.isNull()),
        ("MISSING_DISTANCE", dist.isNull()),
        ("NON_POSITIVE_DISTANCE", dist.isNotNull() & (dist <= 0.0)),
        ("MISSING_FARE", fare.isNull()),
        ("NEGATIVE_FARE", fare.isNotNull() & (fare < 0.0)),
        ("MISSING_TOTAL", total.isNull()),
        ("NEGATIVE_TOTAL", total.isNotNull() & (total < 0.0)),
        ("PICKUP_BEFORE_MONTH", pickup.isNotNull() & (pickup < start)),
        ("PICKUP_AFTER_MONTH", pickup.isNotNull() & (pickup >= end)),
        ("DROPOFF_BEFORE_PICKUP", both & (dropoff <= pickup)),
        ("DROPOFF_AFTER_WINDOW", both & (dropoff >= window_end)),
        ("NON_FINITE_NUMBER", non_finite),
        ("VALUE_OUT_OF_RANGE", out_of_range),
        ("KEY_OUT_OF_RANGE", bad_key),
    ]
    return [(code, F.coalesce(mask, F.lit(False))) for code, mask in masks]


def _unknown(col: str, keys: dict[int, str]) -> Column:
    # A null id counts as unknown (Kleene NOT IN would give null otherwise).
    return F.coalesce(~F.col(col).isin(list(keys)), F.lit(True))


def flag_masks() -> list[tuple[str, Column]]:
    """(code, mask) pairs for accepted candidates, in issue order; never null."""
    passenger = F.col("passenger_count")
    flags = [
        ("UNKNOWN_VENDOR", _unknown("VendorID", VENDOR_LOOKUP)),
        ("UNKNOWN_PAYMENT", _unknown("payment_type", PAYMENT_TYPE_LOOKUP)),
        ("UNKNOWN_RATE", _unknown("RatecodeID", RATE_CODE_LOOKUP)),
        ("INVALID_PASSENGER_COUNT", F.coalesce(passenger.isNull() | (passenger < 0), F.lit(True))),
    ]
    flags += [(code, F.col(col).isNull()) for col, code in NULLABLE_MONEY_FLAGS]
    return flags


def _codes(masks: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(mask, F.lit(code)) for code, mask in masks]))


def classify(raw: DataFrame) -> DataFrame:
    """Add ``is_rejected``, ``reject_codes``, ``has_quality_issue`` and ``issue_codes``.

    Flags are only evaluated on rows that pass every reject rule (rejected rows carry an
    empty issue list and ``has_quality_issue = false``).
    """
    rejects = reject_masks(raw.columns)
    flags = flag_masks()
    is_rejected = reduce(or_, [m for _, m in rejects])
    any_flag = reduce(or_, [m for _, m in flags])
    return (
        raw.withColumn("is_rejected", is_rejected)
        .withColumn("reject_codes", _codes(rejects))
        .withColumn("has_quality_issue", ~F.col("is_rejected") & any_flag)
        .withColumn(
            "issue_codes",
            F.when(F.col("is_rejected"), F.array().cast("array<string>")).otherwise(_codes(flags)),
        )
    )


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Rows failing at least one hard rule, raw columns plus their reject codes."""
    return classified.filter("is_rejected").drop("is_rejected", "has_quality_issue", "issue_codes")


def candidate_rows(classified: DataFrame) -> DataFrame:
    """Rows passing every hard rule."""
    return classified.filter(~F.col("is_rejected")).drop("is_rejected", "reject_codes")


def issue_rows(classified: DataFrame) -> DataFrame:
    """One (month, source row, issue code) row per flag per accepted row.

    A narrow ``explode`` of the per-row code array: no shuffle, no driver loop.
    """
    return classified.filter(F.col("has_quality_issue")).select(
        "source_month",
        "source_row_number",
        F.explode("issue_codes").alias("issue_code"),
    )


def reject_reason_histogram(classified: DataFrame) -> DataFrame:
    """Quarantine manifest, rejected rows per reason code and month.

    Partial aggregation collapses each task to at most (months x 13) rows before the shuffle.
    """
    return (
        classified.filter("is_rejected")
        .select("source_month", F.explode("reject_codes").alias("reject_code"))
        .groupBy("source_month", "reject_code")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def reconciliation_counts(classified: DataFrame) -> DataFrame:
    """A1/A2: source, accepted, rejected, flagged and issue-row counts per month, in one pass."""
    return classified.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~F.col("is_rejected")).alias("accepted_rows"),
        F.count_if(F.col("is_rejected")).alias("rejected_rows"),
        F.count_if(F.col("has_quality_issue")).alias("flagged_rows"),
        F.sum(F.size("issue_codes")).cast("bigint").alias("issue_rows"),
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    """A3: issue rows per month and code (written as severity 'warning')."""
    return issues.groupBy("source_month", "issue_code").agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "severity", F.lit("warning")
    )


def reject_rate_percent(rejected: Column, source: Column) -> Column:
    """100 * rejected / source, 0 when the base is 0."""
    return F.when(source > 0, F.lit(100.0) * rejected.cast("double") / source.cast("double")).otherwise(F.lit(0.0))


def gate_reconciliation(counts, warn_reject_percent: float | None = None,
                        fail_reject_percent: float | None = None) -> list[str]:
    """source = accepted + rejected, flagged <= accepted, optional reject-rate limits.

    ``counts`` is the per-month counts frame or its already collected rows (one per month).
    Returns warnings; raises on a failure.
    """
    rows = counts if isinstance(counts, list) else [r.asDict() for r in counts.collect()]
    warnings = []
    for row in rows:
        src, acc, rej, flg = (int(row[k]) for k in ("source_rows", "accepted_rows", "rejected_rows", "flagged_rows"))
        if src != acc + rej or flg > acc:
            raise RuntimeError(f"reconciliation failed for {row['source_month']}: {row}")
        pct = 100.0 * rej / src if src else 0.0
        if fail_reject_percent is not None and pct > fail_reject_percent:
            raise RuntimeError(f"reject rate {pct:.2f}% above {fail_reject_percent}%")
        if warn_reject_percent is not None and pct > warn_reject_percent:
            warnings.append(f"{row['source_month']}: reject rate {pct:.2f}%")
    return warnings


def zone_issue_rows(accepted: DataFrame, zone_keys: DataFrame) -> DataFrame:
    """UNKNOWN_PICKUP_ZONE / UNKNOWN_DROPOFF_ZONE issue rows for accepted trips whose
    location id is not a current zone (the fact maps them to key 0). ``zone_keys`` are the current
    zone business keys; Spark broadcasts them by their size in bytes."""
    keys = zone_keys.select(F.col("business_key").alias("_zk")).distinct()
    pu = accepted.join(keys, F.col("pickup_location_id") == F.col("_zk"), "left").withColumn(
        "_pu_unknown", F.col("_zk").isNull()).drop("_zk")
    both = pu.join(keys, F.col("dropoff_location_id") == F.col("_zk"), "left").withColumn(
        "_do_unknown", F.col("_zk").isNull()).drop("_zk")
    codes = F.array_compact(F.array(
        F.when(F.col("_pu_unknown"), F.lit("UNKNOWN_PICKUP_ZONE")),
        F.when(F.col("_do_unknown"), F.lit("UNKNOWN_DROPOFF_ZONE")),
    ))
    return both.filter(F.col("_pu_unknown") | F.col("_do_unknown")).select(
        "source_month", "source_row_number", F.explode(codes).alias("issue_code"))


def dst_wall_time_flags(ts: Column, zone: str = "America/New_York") -> tuple[Column, Column]:
    """(nonexistent, ambiguous) for a wall-clock TIMESTAMP_NTZ in ``zone``.

    Nonexistent: the wall time does not survive a round trip through UTC (spring-forward gap).
    Ambiguous: the same wall time is also reached one hour earlier or later in UTC (fall-back
    overlap). Built from ``to_utc_timestamp`` / ``from_utc_timestamp`` only.
    """
    wall = ts.cast("timestamp")
    utc = F.to_utc_timestamp(wall, zone)
    back = F.from_utc_timestamp(utc, zone)
    hour = F.expr("INTERVAL 1 HOUR")
    nonexistent = back != wall
    ambiguous = ~nonexistent & (
        (F.from_utc_timestamp(utc + hour, zone) == wall) | (F.from_utc_timestamp(utc - hour, zone) == wall)
    )
    return nonexistent, ambiguous
