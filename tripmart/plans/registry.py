"""Registered queries: one callable per operator family, each ``(spark, sf_dir) -> DataFrame``.

Two kinds:

* ETL operators (rules, issues, conversion, bounds) run on the lazy trip model built
  straight from the driver tables in ``sf_dir``.
* Warehouse queries (facts, mart, dashboard, explorer, ops) read the warehouse that the
  publish job wrote from the same tables into the session's shared folder (published once
  per session and input, then reused), exactly as the dashboard reads published tables.

Column names match the oracle SQL in ``oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import compare as C
from tripmart.operators import metrics as M
from tripmart.operators import ops as O
from tripmart.operators import outliers, rules
from tripmart.operators.explorer import Cursor, explorer_page
from tripmart.operators.fact import duplicate_identities, facts_with_business_keys, orphan_counts
from tripmart.operators.mart import MART_KEYS, MART_MEASURES
from tripmart.plans.log_queries import LOG_QUERIES
from tripmart.plans.model import TripModel, build_model
from tripmart.plans.pages import page_over_files
from tripmart.plans.warehouse import Warehouse, warehouse_for
from tripmart.sources.trips import lineitem_months, lineitem_trip_view, months_between

Query = Callable[[SparkSession, str], DataFrame]

# Dashboard parameters. The driver tables hold January 2024 trips.
FULL_MONTH = M.DashboardFilters(date(2024, 1, 1), date(2024, 1, 31))
FULL_MONTH_ALL_ROWS = M.DashboardFilters(date(2024, 1, 1), date(2024, 1, 31), include_outliers=True)
# Second half of the month against the same-length span before it (H6 rule).
SECOND_HALF = M.DashboardFilters(date(2024, 1, 16), date(2024, 1, 31))
EXPLORER = M.ExplorerFilters(minimum_distance_miles=1.0, maximum_total_dollars=100.0)
CURSOR = Cursor(datetime(2024, 1, 15, 12, 0, 0), 0)

def model(spark: SparkSession, sf_dir: str) -> TripModel:
    """A new lazy chain for every query: nothing is kept between calls."""
    return build_model(spark, sf_dir)


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return warehouse_for(spark, sf_dir)


# --- ETL operators on the lazy model ------------------------------------------------------------


def trip_reject_counts(spark, sf_dir):
    """A1/A2: reconciliation counts."""
    return model(spark, sf_dir).counts


def reject_reason_histogram(spark, sf_dir):
    """Rejected rows per reason code."""
    return rules.reject_reason_histogram(model(spark, sf_dir).classified)


def trip_issue_rows(spark, sf_dir):
    """One row per flag per accepted row."""
    return model(spark, sf_dir).issues


def accepted_trips(spark, sf_dir):
    """Accepted rows in integer units with the outlier flag, from the published bounds (one scan)."""
    return outliers.mark_outliers(model(spark, sf_dir).converted, wh(spark, sf_dir).table("outlier_bounds"))


def exact_bounds(spark, sf_dir):
    """A21/A23 (exact variant): per-month quantile bounds."""
    return model(spark, sf_dir).bounds


def kll_bounds(spark, sf_dir):
    """Per-month sketch bounds, checked against the exact ranks of the same values."""
    converted = model(spark, sf_dir).converted
    bounds = outliers.long_bounds(outliers.kll_bounds(converted), list(outliers.METRICS), ["source_month"])
    return outliers.rank_checks(outliers.in_range_values(converted), bounds, ["source_month", "metric"])


def calibration_thresholds(spark, sf_dir):
    """One threshold version from the merged sketches of all ship months, checked against the exact
    ranks over all of them."""
    converted = monthly_model(spark, sf_dir).converted
    version = outliers.calibrate(converted)
    bounds = version.select("metric", F.size("baseline_months").alias("months"), "k", F.col("low_bound").cast("double").alias("low"), F.col("high_bound").cast("double").alias("high"))
    checked = outliers.rank_checks(outliers.in_range_values(converted), bounds.select("metric", "low", "high"), ["metric"])
    return checked.join(bounds.select("metric", "months", "k"), "metric")


def monthly_model(spark, sf_dir) -> TripModel:
    """The lazy chain over the trips of all ship months."""
    return build_model(spark, sf_dir, raw=lineitem_trip_view(spark, sf_dir), months=lineitem_months(spark, sf_dir))


def monthly_reject_counts(spark, sf_dir):
    """Reconciliation counts of every ship month."""
    return monthly_model(spark, sf_dir).counts


def monthly_bounds(spark, sf_dir):
    """A23 over many months: exact bounds of every ship month."""
    return monthly_model(spark, sf_dir).bounds


def full_month_comparison(spark, sf_dir):
    """H6: a whole month against the calendar month before it, over the trips of all ship months."""
    march = M.DashboardFilters(date(1995, 3, 1), date(1995, 3, 31), include_outliers=True)
    return C.kpi_comparison(monthly_model(spark, sf_dir).metrics, march)


def source_fingerprint(spark, sf_dir):
    """SHA-256 and size of the source file (rows-only: file bytes are not in the views)."""
    from tripmart.sources.fingerprint import source_fingerprint_of, source_identity

    return source_identity(source_fingerprint_of(spark, f"{sf_dir}/events.parquet"), "2024-01", "events")


# --- warehouse: facts, integrity, dimensions ------------------------------------------------------


def fact_trips(spark, sf_dir):
    w = wh(spark, sf_dir)
    return facts_with_business_keys(w.facts, w.dims).drop("source_asset_id", "source_version")


def orphan_check(spark, sf_dir):
    w = wh(spark, sf_dir)
    return orphan_counts(w.facts, w.dims)


def duplicate_check(spark, sf_dir):
    return duplicate_identities(wh(spark, sf_dir).facts)


def dim_date_month(spark, sf_dir):
    """The calendar of every month with an order (each month and the day after it)."""
    from tripmart.operators.dims import calendar_for_months

    month = F.date_format("o_orderdate", "yyyy-MM").alias("source_month")
    months = spark.read.parquet(f"{sf_dir}/orders.parquet").select(month).where("source_month is not null").distinct()
    return calendar_for_months(months).distinct()


def hourly_mart(spark, sf_dir):
    """A5 with business keys (surrogates resolved through the metrics view joins)."""
    return wh(spark, sf_dir).metrics.select("source_month", *MART_KEYS, *MART_MEASURES)


def metrics_view(spark, sf_dir):
    return wh(spark, sf_dir).metrics


# --- warehouse: dashboard aggregates --------------------------------------------------------------


def kpis(spark, sf_dir):
    return M.kpis(wh(spark, sf_dir).metrics, FULL_MONTH)


def kpis_including_outliers(spark, sf_dir):
    return M.kpis(wh(spark, sf_dir).metrics, FULL_MONTH_ALL_ROWS)


def daily_metrics(spark, sf_dir):
    return M.daily(wh(spark, sf_dir).metrics, FULL_MONTH)


def hourly_metrics(spark, sf_dir):
    return M.hourly(wh(spark, sf_dir).metrics, FULL_MONTH)


def weekday_hour_heatmap(spark, sf_dir):
    return M.heatmap(wh(spark, sf_dir).metrics, FULL_MONTH)


def zone_metrics(spark, sf_dir):
    return M.zones(wh(spark, sf_dir).metrics, FULL_MONTH)


def breakdown_payment(spark, sf_dir):
    return M.breakdown(wh(spark, sf_dir).metrics, FULL_MONTH, "payment_type")


def breakdown_vendor(spark, sf_dir):
    return M.breakdown(wh(spark, sf_dir).metrics, FULL_MONTH, "vendor")


def breakdown_rate(spark, sf_dir):
    return M.breakdown(wh(spark, sf_dir).metrics, FULL_MONTH, "rate_code")


def revenue_components(spark, sf_dir):
    return M.revenue_components(wh(spark, sf_dir).metrics, FULL_MONTH)


def avg_fare_per_mile(spark, sf_dir):
    return M.avg_fare_per_mile(wh(spark, sf_dir).facts)


def peak_hours(spark, sf_dir):
    w = wh(spark, sf_dir)
    return M.peak_hours(w.facts, w.dims.time)


def revenue_by_payment(spark, sf_dir):
    w = wh(spark, sf_dir)
    return M.revenue_by_payment(w.facts, w.dims, include_outliers=True)


def revenue_by_payment_no_outliers(spark, sf_dir):
    w = wh(spark, sf_dir)
    return M.revenue_by_payment(w.facts, w.dims, include_outliers=False)


def filter_options(spark, sf_dir):
    return O.filter_options(wh(spark, sf_dir).metrics)


def date_coverage(spark, sf_dir):
    return O.date_coverage(wh(spark, sf_dir).metrics)


# --- explorer, comparison ----------------------------------------------------------------------------


def explorer_page_next(spark, sf_dir):
    return explorer_page(wh(spark, sf_dir).explorer, FULL_MONTH, EXPLORER, CURSOR, "next")


def explorer_page_previous(spark, sf_dir):
    return explorer_page(wh(spark, sf_dir).explorer, FULL_MONTH, EXPLORER, CURSOR, "previous")


def explorer_file_page_next(spark, sf_dir):
    """L1 over the file manifest: the same page from the files that settle it."""
    return page_over_files(wh(spark, sf_dir), FULL_MONTH, EXPLORER, CURSOR, "next", first_files=1).rows


def explorer_file_page_previous(spark, sf_dir):
    """L2 over the file manifest."""
    return page_over_files(wh(spark, sf_dir), FULL_MONTH, EXPLORER, CURSOR, "previous", first_files=1).rows


def zone_movers(spark, sf_dir):
    return C.zone_movers(wh(spark, sf_dir).metrics, SECOND_HALF)


def payment_movers(spark, sf_dir):
    return C.breakdown_movers(wh(spark, sf_dir).metrics, SECOND_HALF, "payment_type")


def kpi_comparison(spark, sf_dir):
    return C.kpi_comparison(wh(spark, sf_dir).metrics, SECOND_HALF)


def zone_quantile_classes(spark, sf_dir):
    return C.zone_choropleth(M.zones(wh(spark, sf_dir).metrics, FULL_MONTH), "trip_count")


# --- ops -----------------------------------------------------------------------------------------------


def latest_run_state(spark, sf_dir):
    w = wh(spark, sf_dir)
    return O.publication_state(w.runs, w.assets).drop(
        "published_at", "source_version", "threshold_version_id", "reference_snapshot_id"
    )


def quality_summary(spark, sf_dir):
    return O.quality_summary(wh(spark, sf_dir).table("quality_result_summary"))


def redacted_payloads(spark, sf_dir):
    """H4 over alert-style payloads built from whole documents: text in a safe field, a sensitive key, a
    field outside the safe list, a nested object and a list of objects and strings."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source, lang = F.col("source"), F.col("lang")
    alert = F.to_json(F.struct(lang.alias("token"), source.alias("status")))
    payload = F.to_json(
        F.struct(
            F.col("text").alias("event"),
            source.alias("service"),
            lang.alias("api_key"),
            F.col("text").alias("note"),
            F.struct(lang.alias("password"), source.alias("pod"), lang.alias("owner")).alias("labels"),
            F.array(alert, F.concat(F.lit("secret="), source)).alias("alerts"),
        )
    )
    red = O.redact_payload(payload)
    return docs.select("doc_id", *[red[name].alias(name) for name in ("event", "service", "api_key", "note", "labels", "alerts")])


# SCD2: first snapshot at the month start, demand-based snapshot mid-month.
SNAPSHOT_A = "2024-01-01 00:00:00"
SNAPSHOT_B = "2024-01-16 00:00:00"


def _zone_history(spark, sf_dir):
    from tripmart.operators import dims as D

    first = D.scd2_merge(D.empty_dimension(spark), D.zone_candidates_from_tables(spark, sf_dir),
                         F.to_timestamp(F.lit(SNAPSHOT_A)))
    return D.scd2_merge(first, D.zone_demand_snapshot(spark, sf_dir), F.to_timestamp(F.lit(SNAPSHOT_B)))


def scd2_zone_history(spark, sf_dir):
    """V1: observed-time SCD2 history after two snapshots (surrogates omitted: opaque)."""
    h = _zone_history(spark, sf_dir)
    return h.select(
        "business_key",
        "label",
        "attributes",
        F.col("observed_from").cast("timestamp_ntz").alias("observed_from"),
        F.col("observed_to").cast("timestamp_ntz").alias("observed_to"),
        "is_current",
    )


def asof_zone_join(spark, sf_dir):
    """Each published trip pinned to the zone version valid at its pickup time."""
    from tripmart.operators import dims as D

    w = wh(spark, sf_dir)
    facts = facts_with_business_keys(w.facts, w.dims).select("pickup_zone_key", "pickup_at_local")
    pinned = D.asof_lookup(facts, _zone_history(spark, sf_dir), "pickup_zone_key", "pickup_at_local", "zone")
    return pinned.groupBy("pickup_zone_key", F.col("zone_attributes")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def sliding_window_events(spark, sf_dir):
    """Streaming rules + 1 h / 15 min sliding windows, upserted per micro-batch, read back."""
    from tripmart.session import scratch_path
    from tripmart.streaming.trips import run_sliding_windows

    bounds = wh(spark, sf_dir).table("outlier_bounds")
    store, _ = run_sliding_windows(spark, sf_dir, scratch_path(spark, "stream", unique=True), bounds=bounds)
    return store.read("trip_windows").drop("window_date")


def stream_progress(spark, sf_dir):
    """What a run to completion read, and how many late rows it dropped (none), from its metrics table."""
    from tripmart.session import scratch_path
    from tripmart.streaming.trips import run_sliding_windows

    store, _ = run_sliding_windows(spark, sf_dir, scratch_path(spark, "stream", unique=True))
    return store.read("stream_progress").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("rows_dropped_by_watermark").alias("rows_dropped_by_watermark"))


def dashboard_frames(spark, sf_dir):
    """M1: rows of each of the 19 frames of one dashboard load."""
    from tripmart.plans.dashboard import load_dashboard_data

    frames = load_dashboard_data(wh(spark, sf_dir), SECOND_HALF)
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("frame"), "n_rows") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counted)


def latest_fingerprints(spark, sf_dir):
    """The newest source asset of each month (hash and time left out: file bytes are not in the views)."""
    return O.fingerprints(wh(spark, sf_dir).assets).select("source_month", "row_count", "is_synthetic")


def latest_thresholds(spark, sf_dir):
    """Threshold version of the latest successful run of each month, and whether a snapshot was recorded (V2)."""
    return O.thresholds(wh(spark, sf_dir).runs).select(
        "source_month", "threshold_version_id", F.col("reference_snapshot_id").isNotNull().alias("has_snapshot"))


def published_versions(spark, sf_dir):
    """Rows per published month of every table that a publish switches at once."""
    w = wh(spark, sf_dir)
    parts = {
        "fact_rows": w.facts.groupBy("source_month").agg(F.count(F.lit(1)).alias("n")),
        "mart_trips": w.mart.groupBy("source_month").agg(F.sum("trip_count").cast("bigint").alias("n")),
        "quarantined_rows": w.table("quarantine_rejected").groupBy("source_month").agg(F.count(F.lit(1)).alias("n")),
        "issue_rows": w.table("trip_quality_issue").groupBy("source_month").agg(F.count(F.lit(1)).alias("n")),
    }
    out = w.store.pointers().select("source_month")
    for name, df in parts.items():
        out = out.join(df.withColumnRenamed("n", name), "source_month", "left")
    return out.na.fill(0, list(parts))


def unknown_zone_issues(spark, sf_dir):
    """Accepted trips whose pickup / dropoff location is not a known zone, per code."""
    from tripmart.operators.dims import current_keys

    m = model(spark, sf_dir)
    rows = rules.zone_issue_rows(m.converted, current_keys(m.dims.zone))
    return rows.groupBy("source_month", "issue_code").agg(F.count(F.lit(1)).alias("row_count"))


def outlier_issue_rows(spark, sf_dir):
    """Per-metric outlier issue rows with the value and the bounds."""
    return outliers.outlier_issue_rows(model(spark, sf_dir).converted, wh(spark, sf_dir).table("outlier_bounds"))


def derived_metric_bounds(spark, sf_dir):
    """Sketch bounds of speed and fare per mile, checked against the exact ranks."""
    converted = model(spark, sf_dir).converted
    bounds = outliers.long_bounds(outliers.derived_metric_sketch_bounds(converted), list(outliers.DERIVED), ["source_month"])
    return outliers.rank_checks(outliers.derived_values(converted), bounds, ["source_month", "metric"])


def top_zones(spark, sf_dir):
    from tripmart.plans.dashboard import top_zones as tz

    return tz(M.zones(wh(spark, sf_dir).metrics, FULL_MONTH), 20)


def peak_hour_headline(spark, sf_dir):
    from tripmart.plans.dashboard import peak_hour

    return peak_hour(M.hourly(wh(spark, sf_dir).metrics, FULL_MONTH))


def reconciliation_bars(spark, sf_dir):
    from tripmart.plans.dashboard import reconciliation

    w = wh(spark, sf_dir)
    return reconciliation(w.runs, w.assets)


def release_checks(spark, sf_dir):
    from tripmart.plans.dashboard import release_checks as rc

    return rc(wh(spark, sf_dir))


def month_partition_replace(spark, sf_dir):
    """K3 at table scale on ``lineitem`` (ship month as the partition): every month written and written
    again (a rerun leaves no duplicates). Reads back rows per month."""
    from tripmart.session import scratch_path
    from tripmart.sources.store import TableStore

    store = TableStore(spark, scratch_path(spark, "month-replace", unique=True))
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn(
        "source_month", F.date_format("l_shipdate", "yyyy-MM"))
    ends = li.agg(F.min("source_month").alias("a"), F.max("source_month").alias("b")).first()
    months = months_between(ends.a, ends.b) if ends.a else []
    store.replace_partitions("lineitem_by_month", li, months)
    store.replace_partitions("lineitem_by_month", li, months)
    return store.read("lineitem_by_month").groupBy("source_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_linenumber").cast("bigint").alias("linenumber_sum"))


QUERIES: dict[str, Query] = {
    "trip_reject_counts": trip_reject_counts,
    "reject_reason_histogram": reject_reason_histogram,
    "trip_issue_rows": trip_issue_rows,
    "accepted_trips": accepted_trips,
    "exact_bounds": exact_bounds,
    "kll_bounds": kll_bounds,
    "calibration_thresholds": calibration_thresholds,
    "monthly_reject_counts": monthly_reject_counts,
    "monthly_bounds": monthly_bounds,
    "full_month_comparison": full_month_comparison,
    "source_fingerprint": source_fingerprint,
    "fact_trips": fact_trips,
    "orphan_check": orphan_check,
    "duplicate_check": duplicate_check,
    "dim_date_month": dim_date_month,
    "hourly_mart": hourly_mart,
    "metrics_view": metrics_view,
    "kpis": kpis,
    "kpis_including_outliers": kpis_including_outliers,
    "daily_metrics": daily_metrics,
    "hourly_metrics": hourly_metrics,
    "weekday_hour_heatmap": weekday_hour_heatmap,
    "zone_metrics": zone_metrics,
    "breakdown_payment": breakdown_payment,
    "breakdown_vendor": breakdown_vendor,
    "breakdown_rate": breakdown_rate,
    "revenue_components": revenue_components,
    "avg_fare_per_mile": avg_fare_per_mile,
    "peak_hours": peak_hours,
    "revenue_by_payment": revenue_by_payment,
    "revenue_by_payment_no_outliers": revenue_by_payment_no_outliers,
    "filter_options": filter_options,
    "date_coverage": date_coverage,
    "explorer_page_next": explorer_page_next,
    "explorer_page_previous": explorer_page_previous,
    "explorer_file_page_next": explorer_file_page_next,
    "explorer_file_page_previous": explorer_file_page_previous,
    "zone_movers": zone_movers,
    "payment_movers": payment_movers,
    "kpi_comparison": kpi_comparison,
    "zone_quantile_classes": zone_quantile_classes,
    "latest_run_state": latest_run_state,
    "quality_summary": quality_summary,
    "redacted_payloads": redacted_payloads,
    "scd2_zone_history": scd2_zone_history,
    "asof_zone_join": asof_zone_join,
    "sliding_window_events": sliding_window_events,
    "stream_progress": stream_progress,
    "published_versions": published_versions,
    "dashboard_frames": dashboard_frames,
    "latest_fingerprints": latest_fingerprints,
    "latest_thresholds": latest_thresholds,
    "unknown_zone_issues": unknown_zone_issues,
    "outlier_issue_rows": outlier_issue_rows,
    "derived_metric_bounds": derived_metric_bounds,
    "top_zones": top_zones,
    "peak_hour_headline": peak_hour_headline,
    "reconciliation_bars": reconciliation_bars,
    "release_checks": release_checks,
    "month_partition_replace": month_partition_replace,
} | LOG_QUERIES
