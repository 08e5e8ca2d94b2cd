"""Keyset paging (forward/backward, page walk completeness) and the streaming path."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tripmart.operators.explorer import Cursor, explorer_page, page_cursors
from tripmart.operators.metrics import DashboardFilters, ExplorerFilters


def _view(spark, n=250):
    base = datetime(2024, 1, 10)
    rows = []
    for i in range(n):
        t = base + timedelta(minutes=(i // 2))  # pairs share a pickup time: ties broken by trip_key
        rows.append((t, i, t + timedelta(minutes=5), "2024-01", "z", "z", "p", "v", "r", 1, 1000 + i, 1.0, 5.0,
                     1.0, 0.1, 100 + i, 1.0 + i, False, i % 3 == 0))
    return spark.createDataFrame(
        rows,
        "pickup_at_local timestamp_ntz, trip_key long, dropoff_at_local timestamp_ntz, source_month string, "
        "pickup_zone_label string, dropoff_zone_label string, payment_type_label string, vendor_label string, "
        "rate_code_label string, passenger_count int, distance_millimiles long, distance_miles double, "
        "duration_minutes double, fare_amount_dollars double, tip_amount_dollars double, total_amount_cents long, "
        "total_amount_dollars double, has_statistical_outlier boolean, has_quality_issue boolean",
    )


F_ALL = DashboardFilters(date(2024, 1, 1), date(2024, 1, 31))


def test_page_walk_forward_is_complete(spark):
    view = _view(spark).cache()
    seen, cursor, pages = [], None, 0
    while True:
        page = explorer_page(view, F_ALL, ExplorerFilters(), cursor, "next", page_size=100).collect()
        seen += [r.trip_key for r in page]
        pages += 1
        if not page or not page[-1].has_more:
            break
        cursor = Cursor(page[-1].pickup_at_local, page[-1].trip_key)
    assert seen == list(range(250)) and pages == 3


def test_previous_page_is_before_cursor_ascending(spark):
    view = _view(spark)
    c = Cursor(datetime(2024, 1, 10, 1, 0), 120)
    page = explorer_page(view, F_ALL, ExplorerFilters(), c, "previous", page_size=100).collect()
    keys = [r.trip_key for r in page]
    assert keys == list(range(20, 120)) and page[0].has_more is True
    cur = page_cursors(spark.createDataFrame(page)).first()
    assert cur["first"]["trip_key"] == 20 and cur["last"]["trip_key"] == 119


def test_explorer_filters_in_integer_units(spark):
    view = _view(spark)
    x = ExplorerFilters(quality_only=True, minimum_distance_miles=1.1, maximum_total_dollars=2.5)
    page = explorer_page(view, F_ALL, x, None, "next").collect()
    assert all(r.has_quality_issue for r in page)
    assert {r.trip_key for r in page} == {i for i in range(100, 151) if i % 3 == 0}


def test_stream_windows_match_batch(spark, tmp_path):
    from tripmart.streaming.trips import run_sliding_windows

    src = tmp_path / "src"
    events = spark.createDataFrame(
        [(i, datetime(2024, 1, 5, 10, 0) + timedelta(minutes=7 * i), i, "purchase", 10.0 + i, '{"k": 1}')
         for i in range(1, 40)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    events.coalesce(1).write.parquet(str(src / "events.parquet"))
    store, q = run_sliding_windows(spark, str(src / "events.parquet"), str(tmp_path / "out"), glob="*.parquet")
    got = store.read("trip_windows")
    # batch expansion: every accepted trip falls in exactly four 1 h / 15 min windows
    from tripmart.operators import rules
    from tripmart.operators.convert import convert_accepted
    from tripmart.sources.trips import trips_from_events

    accepted = convert_accepted(rules.candidate_rows(rules.classify(trips_from_events(events))))
    assert got.agg(F.sum("trip_count")).first()[0] == 4 * accepted.count()
    assert got.groupBy("window_start", "payment_type_id").count().filter("count > 1").count() == 0
    assert q.recentProgress[0]["numInputRows"] == 39


def test_the_events_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    from tripmart.streaming.trips import event_stream

    plan = event_stream(spark, str(tmp_path), "*.parquet")._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" in plan
