"""Composite dashboard read models (M1, M2, M4, M6, M7, M8), top-k headlines (L5, L6) and the
result export (K12). Every frame is a lazy DataFrame over the published warehouse; nothing is
collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import compare as C
from tripmart.operators import metrics as M
from tripmart.operators import ops as O
from tripmart.operators.rules import reject_rate_percent
from tripmart.plans.warehouse import Warehouse


def top_zones(zones: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` busiest pickup zones (label as tie-break); a top-k report."""
    return zones.orderBy(F.col("trip_count").desc(), F.col("pickup_zone_label")).limit(n)


def peak_hour(hourly: DataFrame) -> DataFrame:
    """The hour with most trips (earliest hour on ties), as one row."""
    return hourly.agg(
        F.max_by(F.struct(F.col("pickup_hour"), F.col("trip_count")),
                 F.struct(F.col("trip_count"), -F.col("pickup_hour"))).alias("peak")
    ).select("peak.pickup_hour", "peak.trip_count")


def reconciliation(runs: DataFrame, assets: DataFrame) -> DataFrame:
    """M8 + A28: per published month, source = accepted + rejected bars and the reject and flag
    rates (percent, 0 when the base is 0)."""
    st = O.publication_state(runs, assets)
    return st.select(
        "source_month",
        "source_rows",
        "accepted_rows",
        "rejected_rows",
        "flagged_rows",
        reject_rate_percent(F.col("rejected_rows"), F.col("source_rows")).alias("reject_rate_percent"),
        reject_rate_percent(F.col("flagged_rows"), F.col("accepted_rows")).alias("flag_rate_percent"),
        (F.col("source_rows") == F.col("accepted_rows") + F.col("rejected_rows")).alias("balanced"),
    )


def release_checks(wh: Warehouse) -> DataFrame:
    """Facts per month, mart total equal to fact total, and facts on the unknown zone.

    Two grouped aggregates (facts, mart) joined on the month key: one small row per month.
    """
    f = wh.facts.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("pickup_zone_key") == 0).alias("unknown_pickup_zone_rows"),
    )
    m = wh.mart.groupBy("source_month").agg(F.sum("trip_count").cast("bigint").alias("mart_trip_total"))
    return f.join(m, "source_month", "full_outer").select(
        "source_month", "fact_rows", "mart_trip_total", "unknown_pickup_zone_rows",
        (F.coalesce(F.col("fact_rows"), F.lit(0)) == F.coalesce(F.col("mart_trip_total"), F.lit(0))).alias(
            "mart_matches_facts"),
    )


class DashboardData(dict):
    """The frames by name; ``release`` frees what they share."""

    def __init__(self, frames: dict[str, DataFrame], shared: DataFrame | None):
        super().__init__(frames)
        self._shared = shared

    def release(self) -> None:
        if self._shared is not None:
            self._shared.unpersist()


def load_dashboard_data(wh: Warehouse, filters: M.DashboardFilters,
                        comparison: M.DashboardFilters | None = None, persist: bool = False) -> DashboardData:
    """M1: the 19 frames of one dashboard load for a current and a comparison range.

    With ``persist`` the filtered metrics rows (shared by ten frames) are cached until
    ``release`` of the result; the cache is recomputable from lineage if an executor is lost.
    """
    comparison = comparison or C.prior_filters(filters)
    view = wh.metrics
    if persist:
        ends = [d for f in (filters, comparison) for d in (f.start_date, f.end_date)]
        view = view.filter(M.metric_where(M.DashboardFilters(min(ends), max(ends), max_days=None))).persist()
    month_lo, month_hi = filters.start_date.strftime("%Y-%m"), filters.end_date.strftime("%Y-%m")
    in_months = F.col("source_month").between(month_lo, month_hi)
    runs, assets = wh.runs, wh.assets
    frames = {
        "kpis": M.kpis(view, filters),
        "comparison_kpis": M.kpis(view, comparison),
        "daily": M.daily(view, filters),
        "hourly": M.hourly(view, filters),
        "heatmap": M.heatmap(view, filters),
        "zones": M.zones(view, filters),
        "comparison_zones": M.zones(view, comparison),
        "payments": M.breakdown(view, filters, "payment_type"),
        "comparison_payments": M.breakdown(view, comparison, "payment_type"),
        "vendors": M.breakdown(view, filters, "vendor"),
        "comparison_vendors": M.breakdown(view, comparison, "vendor"),
        "rates": M.breakdown(view, filters, "rate_code"),
        "comparison_rates": M.breakdown(view, comparison, "rate_code"),
        "components": M.revenue_components(view, filters),
        "publications": O.publication_state(runs, assets).filter(in_months),
        "quality": O.quality_summary(wh.table("quality_result_summary")).filter(in_months),
        "fingerprints": O.fingerprints(assets),
        "thresholds": O.thresholds(runs),
        "alerts": O.alerts(runs),
    }
    return DashboardData(frames, view if persist else None)


def filter_options_and_coverage(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """M2: option lists and the date coverage."""
    return O.filter_options(wh.metrics), O.date_coverage(wh.metrics)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result as CSV with a header. ``single_file`` is for bounded results only
    (an explorer page of at most 100 rows); large results keep their partitioning."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
