"""The lazy trip model: one chain of DataFrames from a raw month to the read views.

Nothing here triggers a job except the size probes of the (small) dimension sides.
Callers pick the frame they need; Catalyst prunes everything else.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators import dims as D
from tripmart.operators import outliers, rules
from tripmart.operators.convert import convert_accepted
from tripmart.operators.fact import Dimensions, build_facts
from tripmart.operators.mart import explorer_view, hourly_mart, metrics_view
from tripmart.sources.trips import EVENTS_MONTH, events_trip_view


@dataclass
class TripModel:
    raw: DataFrame
    classified: DataFrame
    converted: DataFrame
    bounds: DataFrame
    dims: Dimensions
    source_asset_id: object = None
    source_version: object = None

    @cached_property
    def accepted(self) -> DataFrame:
        """Converted rows with the outlier flag."""
        return outliers.mark_outliers(self.converted, self.bounds)

    @cached_property
    def rejected(self) -> DataFrame:
        return rules.rejected_rows(self.classified)

    @cached_property
    def issues(self) -> DataFrame:
        return rules.issue_rows(self.classified)

    @cached_property
    def counts(self) -> DataFrame:
        return rules.reconciliation_counts(self.classified)

    @cached_property
    def facts(self) -> DataFrame:
        return build_facts(self.accepted, self.dims, self.source_asset_id, self.source_version)

    @cached_property
    def mart(self) -> DataFrame:
        return hourly_mart(self.facts)

    @cached_property
    def metrics(self) -> DataFrame:
        return metrics_view(self.mart, self.dims)

    @cached_property
    def explorer(self) -> DataFrame:
        return explorer_view(self.facts, self.dims)


def reference_dimensions(spark: SparkSession, sf_dir: str, months: list[str]) -> Dimensions:
    """Zone dimension from the driver tables, lookup dimensions, calendar for the months."""
    month_df = spark.createDataFrame([(m,) for m in months], "source_month string")
    return Dimensions(
        zone=D.zone_dimension(spark, sf_dir),
        payment=D.payment_dimension(spark),
        vendor=D.vendor_dimension(spark),
        rate=D.rate_dimension(spark),
        date=D.calendar_for_months(month_df),
        time=D.time_dimension(spark),
    )


def build_model(
    spark: SparkSession,
    sf_dir: str,
    raw: DataFrame | None = None,
    months: list[str] | None = None,
    bounds_method: str = "exact",
    dims: Dimensions | None = None,
    source_asset_id=None,
    source_version=None,
) -> TripModel:
    """Build the whole lazy chain. ``raw`` defaults to the driver-table trip view."""
    if raw is None:
        raw = events_trip_view(spark, sf_dir)
        months = months or [EVENTS_MONTH]
    if months is None:
        raise ValueError("months must be given with an explicit raw frame")
    classified = rules.classify(raw)
    converted = convert_accepted(rules.candidate_rows(classified))
    if bounds_method == "exact":
        bounds = outliers.exact_bounds(converted)
    elif bounds_method == "kll":
        bounds = outliers.kll_bounds(converted)
    else:
        raise ValueError("bounds_method must be 'exact' or 'kll'")
    dims = dims or reference_dimensions(spark, sf_dir, months)
    return TripModel(
        raw=raw,
        classified=classified,
        converted=converted,
        bounds=bounds,
        dims=dims,
        source_asset_id=source_asset_id,
        source_version=source_version,
    )
