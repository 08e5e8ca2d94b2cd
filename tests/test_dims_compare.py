"""Dimensions, SCD2, as-of lookup, comparison helpers, quantile classes, paging, redaction."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators import compare as C
from tripmart.operators import dims as D
from tripmart.operators import ops as O


def test_calendar_month_plus_boundary_day(spark):
    months = spark.createDataFrame([("2024-03",)], "source_month string")
    cal = D.calendar_for_months(months)
    assert cal.count() == 32
    first = cal.filter(F.col("date_key") == 20240301).first()
    assert (first.weekday_number, first.weekday_name, first.month_name, first.is_weekend) == (5, "Friday", "March", False)


def test_calendar_iso_parts(spark):
    r = D.calendar_between(spark, "2023-01-01", "2023-01-01").first()
    assert (r.weekday_number, r.iso_week, r.iso_year, r.weekday_name, r.month_name) == (7, 52, 2022, "Sunday", "January")


def test_time_dimension(spark):
    t = D.time_dimension(spark)
    assert t.count() == 1440
    rows = {r.time_key: (r.hour, r.minute, r.quarter_hour, r.hour_label, r.daypart) for r in t.collect()}
    assert rows[0] == (0, 0, 0, "00:00", "Late Night")
    assert rows[6 * 60] == (6, 0, 0, "06:00", "Morning")
    assert rows[12 * 60 + 59] == (12, 59, 3, "12:59", "Afternoon")
    assert rows[17 * 60] == (17, 0, 0, "17:00", "Evening")


def _cands(spark, rows):
    return spark.createDataFrame(rows, "business_key int, label string, attributes string")


def test_insert_missing_is_deterministic_and_idempotent(spark):
    dim = D.insert_missing(D.empty_dimension(spark), _cands(spark, [(3, "c", None), (1, "a", None), (0, "x", None)]))
    assert sorted((r.business_key, r.surrogate_key) for r in dim.collect()) == [(0, 0), (1, 1), (3, 2)]
    again = D.insert_missing(dim, _cands(spark, [(2, "b", None), (1, "changed", None)]))
    assert sorted((r.business_key, r.surrogate_key, r.label) for r in again.collect()) == [
        (0, 0, "Unknown"), (1, 1, "a"), (2, 3, "b"), (3, 2, "c")]
    assert D.multiple_current_rows(again).count() == 0


def test_scd2_merge_closes_changed_and_opens_successor(spark):
    t0, t1 = F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    v1 = D.scd2_merge(D.empty_dimension(spark), _cands(spark, [(1, "a", "x"), (2, "b", "y")]), t0)
    v2 = D.scd2_merge(v1, _cands(spark, [(1, "a", "x"), (2, "b", "z"), (3, "c", None)]), t1)
    rows = sorted((r.business_key, r.attributes, r.is_current, r.observed_to is None) for r in v2.collect())
    assert rows == [(0, None, True, True), (1, "x", True, True), (2, "y", False, False), (2, "z", True, True),
                    (3, None, True, True)]
    assert D.multiple_current_rows(v2).count() == 0
    assert D.overlapping_versions(v2).count() == 0
    assert v2.select("surrogate_key").distinct().count() == v2.count()


def test_overlap_check_finds_overlap(spark):
    rows = [(1, 1, "a", None, datetime(2024, 1, 1), datetime(2024, 3, 1), False),
            (2, 1, "a", None, datetime(2024, 2, 1), None, True)]
    dim = spark.createDataFrame(rows, "surrogate_key int, business_key int, label string, attributes string, "
                                      "observed_from timestamp, observed_to timestamp, is_current boolean")
    assert D.overlapping_versions(dim).count() == 1


def test_asof_lookup_pins_version(spark):
    t0, t1 = F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.to_timestamp(F.lit("2024-01-16 00:00:00"))
    v1 = D.scd2_merge(D.empty_dimension(spark), _cands(spark, [(1, "a", "old")]), t0)
    v2 = D.scd2_merge(v1, _cands(spark, [(1, "a", "new")]), t1)
    facts = spark.createDataFrame([(1, datetime(2024, 1, 10)), (1, datetime(2024, 1, 20)), (1, datetime(2023, 12, 1))],
                                  "zone int, t timestamp_ntz")
    out = sorted((r.t, r.zone_attributes) for r in D.asof_lookup(facts, v2, "zone", "t", "zone").collect())
    assert [a for _, a in out] == [None, "old", "new"]


def test_borough_parse(spark):
    df = spark.createDataFrame([("borough=Queens, service_zone=Airports",), ("service_zone=x",), (None,)], "a string")
    assert [r[0] for r in df.select(D.borough_of(F.col("a"))).collect()] == ["Queens", None, None]


def test_prior_range():
    assert C.prior_range(date(2024, 2, 1), date(2024, 2, 29)) == (date(2024, 1, 1), date(2024, 1, 31))
    assert C.prior_range(date(2024, 2, 10), date(2024, 2, 12)) == (date(2024, 2, 7), date(2024, 2, 9))
    assert C.prior_range(date(2024, 1, 1), date(2024, 1, 31)) == (date(2023, 12, 1), date(2023, 12, 31))


def test_percent_delta(spark):
    from tripmart.functions.units import percent_delta

    df = spark.createDataFrame([(120, 100), (120, 0), (120, None)], "c long, p long")
    assert [r[0] for r in df.select(percent_delta("c", "p")).collect()] == [20.0, None, None]


def test_staleness(spark):
    now = F.to_timestamp(F.lit("2024-01-03 12:00:00"))
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 0),), (datetime(2024, 1, 2, 1, 0),), (None,)], "p timestamp")
    assert [r[0] for r in df.select(O.is_stale_column(F.col("p"), now, 36)).collect()] == [True, False, True]


def test_quantile_classes(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 100, 1000]], "v long")
    out = [r["class"] for r in C.quantile_classes(df, "v").orderBy("v").collect()]
    assert out == sorted(out) and out[0] == 0 and out[-1] == 4


def test_movers_skip_missing_and_zero_prior(spark):
    df = spark.createDataFrame([("a", 120, 100), ("b", 50, 0), ("c", None, 10), ("d", 10, None)],
                               "label string, now long, old long")
    out = {r.label: r.change_percent for r in C.movers(df, "label", "now", "old").collect()}
    assert out == {"a": 20.0, "c": -100.0}


def test_redaction(spark):
    payload = '{"event": "login token=abc123, ok", "password": "p", "other": "x", "status": "%s"}' % ("y" * 5000)
    df = spark.createDataFrame([(payload,)], "p string")
    m = df.select(O.redact_payload(F.col("p")).alias("m")).first().m
    assert m["event"] == "login token=[REDACTED], ok"
    assert m["password"] == "[REDACTED]" and m["other"] == "[OMITTED]"
    assert m["status"] == "y" * 5000


def test_redaction_of_nested_values(spark):
    import json

    payload = {
        "labels": {"password": "hunter2", "pod": "cookie: abc", "owner": "x", "labels": {"api_key": "k", "status": "ok"}},
        "alerts": [{"token": "abc", "severity": "secret=1"}, "password=2", [{"token": "deep"}]],
        "event": "{not json",
        "status": None,
        "service": {"labels": {"labels": {"labels": {"labels": {"token": "far"}}}}},
    }
    df = spark.createDataFrame([(json.dumps(payload),)], "p string")
    m = df.select(O.redact_payload(F.col("p")).alias("m")).first().m
    assert json.loads(m["labels"]) == {"password": "[REDACTED]", "pod": "cookie=[REDACTED]", "owner": "[OMITTED]",
                                       "labels": json.dumps({"api_key": "[REDACTED]", "status": "ok"}, separators=(",", ":"))}
    first, second, third = json.loads(m["alerts"])
    assert json.loads(first) == {"token": "[REDACTED]", "severity": "secret=[REDACTED]"}
    assert second == "password=[REDACTED]" and "deep" not in third
    assert m["event"] == "{not json" and m["status"] is None
    assert "far" not in str(m) and "hunter2" not in str(m)


def test_publication_state_latest_run(spark):
    from tripmart.plans.publish import ASSET_SCHEMA, RUN_SCHEMA

    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [(1, "d", "r1", None, "2024-01", "failed", t, t, 0.0, 5, 4, 1, 0, "h", None, None, None),
         (2, "d", "r2", None, "2024-01", "success", t, t, 0.0, 5, 4, 1, 0, "h", None, None, None),
         (3, "d", "r3", None, "2024-02", "success", t, None, 0.0, 7, 7, 0, 1, "g", None, None, None)], RUN_SCHEMA)
    assets = spark.createDataFrame([("a", "2024-01", "h", 1, 5, True, None, t)], ASSET_SCHEMA)
    st = {r.source_month: r for r in O.publication_state(runs, assets).collect()}
    assert st["2024-01"].status == "success" and st["2024-01"].is_synthetic is True
    assert st["2024-02"].is_synthetic is False and st["2024-01"].warehouse_version == "3"
    alerts = O.alerts(runs).collect()
    assert len(alerts) == 1 and alerts[0].event_summary == "d / r1"
