"""Property tests: reconciliation, unit conversion, keyset page-walk completeness."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import make_raw
from tripmart.operators import rules
from tripmart.operators.convert import convert_accepted

money = st.one_of(st.none(), st.floats(min_value=-50, max_value=500),
                  st.sampled_from([float("nan"), float("inf"), float("-inf"), 1e19]))
row = st.fixed_dictionaries(
    {
        "VendorID": st.one_of(st.none(), st.integers(0, 9)),
        "payment_type": st.one_of(st.none(), st.integers(0, 9)),
        "trip_distance": money,
        "fare_amount": money,
        "total_amount": money,
        "tip_amount": money,
        "passenger_count": st.one_of(st.none(), st.floats(-2, 6)),
        "tpep_pickup_datetime": st.one_of(st.none(), st.datetimes(datetime(2022, 12, 25), datetime(2023, 2, 5))),
        "minutes": st.integers(-30, 60 * 30),
    }
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(raw_rows):
    out = []
    for r in raw_rows:
        r = dict(r)
        minutes = r.pop("minutes")
        p = r["tpep_pickup_datetime"]
        r["tpep_dropoff_datetime"] = None if p is None else p + timedelta(minutes=minutes)
        out.append(r)
    return out


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_reconciliation_always_balances(spark, raw_rows):
    c = rules.classify(make_raw(spark, _rows(raw_rows)))
    n = rules.reconciliation_counts(c).first()
    assert n.source_rows == len(raw_rows) == n.accepted_rows + n.rejected_rows
    assert n.flagged_rows <= n.accepted_rows
    # every rejected row has a reason; no accepted row has one
    bad = c.filter((F.col("is_rejected") & (F.size("reject_codes") == 0))
                   | (~F.col("is_rejected") & (F.size("reject_codes") > 0))).count()
    assert bad == 0


@SETTINGS
@given(st.lists(st.floats(min_value=0.01, max_value=10_000, allow_nan=False), min_size=1, max_size=20))
def test_cents_within_half_a_cent(spark, fares):
    rows = [{"fare_amount": f, "total_amount": f} for f in fares]
    conv = convert_accepted(rules.candidate_rows(rules.classify(make_raw(spark, rows)))).collect()
    for r, f in zip(sorted(conv, key=lambda x: x.source_row_number), fares):
        assert abs(r.fare_amount_cents - f * 100.0) <= 0.5 + 1e-6


@SETTINGS
@given(st.integers(1, 60), st.integers(1, 25))
def test_page_walk_visits_every_row_once(spark, n, page_size):
    from datetime import date

    from tripmart.operators.explorer import Cursor, explorer_page
    from tripmart.operators.metrics import DashboardFilters, ExplorerFilters

    base = datetime(2024, 1, 3)
    data = [(base + timedelta(minutes=i // 3), i, "2024-01") for i in range(n)]
    view = spark.createDataFrame(data, "pickup_at_local timestamp_ntz, trip_key long, source_month string")
    for c in ["dropoff_at_local", "pickup_zone_label", "dropoff_zone_label", "payment_type_label", "vendor_label",
              "rate_code_label", "passenger_count", "distance_miles", "duration_minutes", "fare_amount_dollars",
              "tip_amount_dollars", "total_amount_dollars", "has_statistical_outlier", "has_quality_issue"]:
        view = view.withColumn(c, F.lit(None))
    f = DashboardFilters(date(2024, 1, 1), date(2024, 1, 31))
    seen, cursor = [], None
    while True:
        page = explorer_page(view, f, ExplorerFilters(), cursor, "next", page_size).collect()
        seen += [r.trip_key for r in page]
        if not page or not page[-1].has_more:
            break
        cursor = Cursor(page[-1].pickup_at_local, page[-1].trip_key)
    assert seen == list(range(n))
