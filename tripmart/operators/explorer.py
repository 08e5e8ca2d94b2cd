"""Trip explorer keyset paging (L1-L3) over the explorer view (J5, P27, P30), and the pickup ranges of fact files
by which a page knows the files it needs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.metrics import DashboardFilters, ExplorerFilters, explorer_where
from tripmart.schema import PAGE_SIZE

PAGE_COLUMNS = [
    "pickup_at_local",
    "trip_key",
    "dropoff_at_local",
    "pickup_zone_label",
    "dropoff_zone_label",
    "payment_type_label",
    "vendor_label",
    "rate_code_label",
    "passenger_count",
    "distance_miles",
    "duration_minutes",
    "fare_amount_dollars",
    "tip_amount_dollars",
    "total_amount_dollars",
    "has_statistical_outlier",
    "has_quality_issue",
]


@dataclass(frozen=True)
class Cursor:
    pickup_at_local: datetime
    trip_key: int


def explorer_page(view: DataFrame, filters: DashboardFilters, explorer: ExplorerFilters,
                  cursor: Cursor | None = None, direction: str = "next", page_size: int = PAGE_SIZE) -> DataFrame:
    """L1/L2: one page after (next) or before (previous) a row-value cursor.

    ``orderBy(...).limit(page_size + 1)`` plans as TakeOrderedAndProject: each task keeps its
    own top rows and only those reach the final merge, never a full sort. The extra row gives
    ``has_more``; the page itself is the first ``page_size`` rows in ascending order.
    """
    if direction not in ("next", "previous"):
        raise ValueError(f"no page in direction {direction!r}")
    cond = explorer_where(filters, explorer)
    t, k = F.col("pickup_at_local"), F.col("trip_key")
    if cursor is not None:
        ct = F.lit(cursor.pickup_at_local.isoformat(sep=" ")).cast("timestamp_ntz")
        ck = F.lit(int(cursor.trip_key))
        after = (t > ct) | ((t == ct) & (k > ck))
        before = (t < ct) | ((t == ct) & (k < ck))
        cond = cond & (after if direction == "next" else before)
    order = [t.asc(), k.asc()] if direction == "next" else [t.desc(), k.desc()]
    fetched = view.filter(cond).select(*PAGE_COLUMNS).orderBy(*order).limit(page_size + 1)
    # The fetched frame has at most page_size + 1 rows: a single-partition window is bounded.
    w = Window.orderBy(*order)
    ranked = fetched.withColumn("_rn", F.row_number().over(w)).withColumn(
        "has_more", F.count(F.lit(1)).over(Window.partitionBy()) > page_size
    )
    return ranked.filter(F.col("_rn") <= page_size).drop("_rn").orderBy("pickup_at_local", "trip_key")


def page_cursors(page: DataFrame) -> DataFrame:
    """L3: cursors of the first and last row of a page (min/max of the row value)."""
    key = F.struct(F.col("pickup_at_local"), F.col("trip_key"))
    return page.agg(F.min(key).alias("first"), F.max(key).alias("last"))


def file_ranges(facts: DataFrame) -> DataFrame:
    """Per file of a written fact table: rows and pickup range (partial aggregates of one timestamp column; one
    small row per file)."""
    at = F.col("pickup_at_local")
    return facts.groupBy("source_month", F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("trip_rows"), F.min(at).alias("first_pickup"), F.max(at).alias("last_pickup"))


def files_in_order(ranges: DataFrame, filters: DashboardFilters, cursor: Cursor | None = None, direction: str = "next") -> DataFrame:
    """The files that may hold rows of a page, in the order in which the page meets them."""
    first, last = F.col("first_pickup"), F.col("last_pickup")
    start, end = (F.lit(str(d)).cast("timestamp_ntz") for d in (filters.start_date, filters.end_date + timedelta(days=1)))
    cond = F.col("source_month").between(f"{filters.start_date:%Y-%m}", f"{filters.end_date:%Y-%m}") & (last >= start) & (first < end)
    if cursor is not None:
        at = F.lit(cursor.pickup_at_local.isoformat(sep=" ")).cast("timestamp_ntz")
        cond = cond & ((last >= at) if direction == "next" else (first <= at))
    order = first.asc() if direction == "next" else last.desc()
    return ranges.filter(cond).orderBy(order, "source_month", "file_name")
