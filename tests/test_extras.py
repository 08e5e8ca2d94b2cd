"""Overflow reject, DST flags, threshold versions, dashboard composite, export."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import f2_rows, make_raw
from tripmart.operators import rules


def test_overflow_is_rejected_not_a_job_failure(spark):
    df = rules.classify(make_raw(spark, [{"fare_amount": 1e18}, {"trip_distance": 1e16}, {}]))
    got = [(r.is_rejected, list(r.reject_codes)) for r in df.orderBy("source_row_number").collect()]
    assert got == [(True, ["VALUE_OUT_OF_RANGE"]), (True, ["VALUE_OUT_OF_RANGE"]), (False, [])]


def test_dst_flags(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 3, 10, 2, 30),), (datetime(2024, 11, 3, 1, 30),), (datetime(2024, 1, 15, 12, 0),)],
        "t timestamp_ntz")
    nonexistent, ambiguous = rules.dst_wall_time_flags(F.col("t"))
    got = [tuple(r) for r in df.select(nonexistent, ambiguous).collect()]
    assert got == [(True, False), (False, True), (False, False)]


def test_zone_issue_rows(spark):
    acc = spark.createDataFrame([("2023-01", 1, 1, 2), ("2023-01", 2, 26, 1), ("2023-01", 3, 27, 28)],
                                "source_month string, source_row_number long, pickup_location_id int, "
                                "dropoff_location_id int")
    keys = spark.createDataFrame([(1,), (2,)], "business_key int")
    got = sorted(tuple(r) for r in rules.zone_issue_rows(acc, keys).select("source_row_number", "issue_code").collect())
    assert got == [(2, "UNKNOWN_PICKUP_ZONE"), (3, "UNKNOWN_DROPOFF_ZONE"), (3, "UNKNOWN_PICKUP_ZONE")]


def test_threshold_version_save_activate_load_and_publish(spark, tmp_path):
    from tripmart.plans import thresholds as TH
    from tripmart.plans.publish import SourceAsset, publish
    from tripmart.sources.store import TableStore

    store = TableStore(spark, str(tmp_path))
    base = [("2023-01", d, d * 10) for d in range(1, 1001)] + [("2023-02", d, d * 10) for d in range(1, 1001)]
    conv = spark.createDataFrame(base, "source_month string, duration_seconds long, distance_millimiles long")
    vid = TH.calibrate_and_save(store, conv, version_id="v1")
    TH.activate(spark, store, vid)
    assert TH.active_version_id(store) == "v1"
    wide = TH.load_threshold_version(store, "v1").first()
    assert 0 < wide.duration_seconds_low <= 5 and 995 <= wide.duration_seconds_high <= 1000
    # the fixture has 4 accepted rows: with a saved version, bounds apply anyway
    zones = spark.createDataFrame([(1, "Z", "borough=B, service_zone=S")], "business_key int, label string, attributes string")
    asset = SourceAsset("2023-01", "a", "h" * 64)
    publish(spark, store, make_raw(spark, f2_rows()), [asset], zones, bounds_method="version")
    runs = store.read("pipeline_run").collect()
    assert runs[0].threshold_version_id == "v1" and len(runs[0].reference_snapshot_id) == 64
    # durations 600, 600, 900, 1200 s vs high bound <= 1000: the 1,200 s trip is an outlier
    assert store.read("fact_trips").filter("has_statistical_outlier").count() == 1


def test_dashboard_composite_and_export(spark, tmp_path):
    from tripmart.operators.metrics import DashboardFilters
    from tripmart.plans.dashboard import export_csv, load_dashboard_data, peak_hour, top_zones
    from tripmart.plans.publish import SourceAsset, publish
    from tripmart.plans.warehouse import Warehouse
    from tripmart.sources.store import TableStore

    store = TableStore(spark, str(tmp_path / "wh"))
    zones = spark.createDataFrame([(1, "Z", "borough=B, service_zone=S")], "business_key int, label string, attributes string")
    publish(spark, store, make_raw(spark, f2_rows()), [SourceAsset("2023-01", "a", "h" * 64)], zones)
    data = load_dashboard_data(Warehouse(store), DashboardFilters(date(2023, 1, 1), date(2023, 1, 31)), persist=True)
    assert len(data) == 19
    assert data["kpis"].first().trip_count == 4
    assert data["comparison_kpis"].first().trip_count == 0  # December 2022 is empty
    assert data["publications"].count() == 1 and data["alerts"].count() == 0
    assert tuple(peak_hour(data["hourly"]).first()) == (1, 2)
    assert top_zones(data["zones"], 20).count() == 1
    export_csv(data["daily"], str(tmp_path / "daily_csv"), single_file=True)
    back = spark.read.option("header", True).csv(str(tmp_path / "daily_csv"))
    assert back.count() == 3 and "trip_count" in back.columns


def test_deep_redaction_goes_in_pieces():
    """A batch of nested payloads is never held as Python values in whole; the results are those of each row."""
    import json

    import pyarrow as pa

    from tripmart.operators import ops

    deep = json.dumps({"labels": {"labels": {"labels": {"labels": {"labels": {"event": "password=x y", "token": "t"}}}}}})
    batch = pa.array([deep, None] * 200)
    pieces = list(ops._deep_redactor().func(iter([batch])))
    assert [len(p) for p in pieces][:-1] == [ops.REDACTION_ROWS] * (len(batch) // ops.REDACTION_ROWS)
    rows = [r for p in pieces for r in p.to_pylist()]
    assert len(rows) == 400 and rows[1::2] == [None] * 200
    text = dict(rows[0])["labels"]
    assert "password=[REDACTED]" in text and "\"t\"" not in text and rows[0::2] == [rows[0]] * 200
