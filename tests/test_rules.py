"""Single-operator tests of the row rules, conversion and counts (reference unit fixtures)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from tripmart.operators import rules
from tripmart.operators.convert import convert_accepted


def classify(spark, rows, month="2023-01"):
    return rules.classify(make_raw(spark, rows, month))


def outcome(spark, row, month="2023-01"):
    r = classify(spark, [row], month).select("is_rejected", "reject_codes", "issue_codes").first()
    return r.is_rejected, list(r.reject_codes), list(r.issue_codes)


def test_base_row_accepted_without_flags(spark):
    assert outcome(spark, {}) == (False, [], [])


BASE_PICKUP = datetime(2023, 1, 15, 10, 0)


@pytest.mark.parametrize(
    "change, code",
    [
        ({"tpep_pickup_datetime": None}, "MISSING_PICKUP"),
        ({"tpep_dropoff_datetime": None}, "MISSING_DROPOFF"),
        ({"trip_distance": 0.0}, "NON_POSITIVE_DISTANCE"),
        ({"trip_distance": None}, "MISSING_DISTANCE"),
        ({"fare_amount": -1.0}, "NEGATIVE_FARE"),
        ({"total_amount": -0.01}, "NEGATIVE_TOTAL"),
        ({"tpep_pickup_datetime": datetime(2022, 12, 31, 23, 0), "tpep_dropoff_datetime": datetime(2022, 12, 31, 23, 30)},
         "PICKUP_BEFORE_MONTH"),
        ({"tpep_pickup_datetime": datetime(2023, 2, 1, 0, 0), "tpep_dropoff_datetime": datetime(2023, 2, 1, 0, 30)},
         "PICKUP_AFTER_MONTH"),
        ({"tpep_dropoff_datetime": BASE_PICKUP}, "DROPOFF_BEFORE_PICKUP"),
        ({"tpep_pickup_datetime": datetime(2023, 1, 31, 23, 0), "tpep_dropoff_datetime": datetime(2023, 2, 2, 0, 0)},
         "DROPOFF_AFTER_WINDOW"),
        ({"tip_amount": float("inf")}, "NON_FINITE_NUMBER"),
        ({"trip_distance": float("nan")}, "NON_FINITE_NUMBER"),
    ],
)
def test_each_reject_rule(spark, change, code):
    rejected, codes, issues = outcome(spark, change)
    assert rejected and code in codes and issues == []


def test_month_edge_dropoff_allowed(spark):
    row = {"tpep_pickup_datetime": datetime(2023, 1, 31, 23, 50), "tpep_dropoff_datetime": datetime(2023, 2, 1, 23, 59)}
    assert outcome(spark, row)[0] is False


@pytest.mark.parametrize(
    "change, codes",
    [
        ({"VendorID": 99}, ["UNKNOWN_VENDOR"]),
        ({"payment_type": 99}, ["UNKNOWN_PAYMENT"]),
        ({"tip_amount": None}, ["NULL_TIP"]),
        ({"VendorID": 99, "payment_type": 99}, ["UNKNOWN_VENDOR", "UNKNOWN_PAYMENT"]),
        ({"VendorID": None}, ["UNKNOWN_VENDOR"]),
        ({"passenger_count": -1.0}, ["INVALID_PASSENGER_COUNT"]),
        ({"RatecodeID": 99.0, "airport_fee": None}, ["UNKNOWN_RATE", "NULL_AIRPORT_FEE"]),
    ],
)
def test_flag_rules(spark, change, codes):
    rejected, _, issues = outcome(spark, change)
    assert not rejected and issues == codes


def test_reconciliation_counts(spark):
    rows = [{}, {"VendorID": 99}, {}, {"trip_distance": 0.0}, {"fare_amount": -5.0}]
    c = rules.reconciliation_counts(classify(spark, rows)).first()
    assert (c.source_rows, c.accepted_rows, c.rejected_rows, c.flagged_rows, c.issue_rows) == (5, 3, 2, 1, 1)


def test_unit_conversion(spark):
    row = {"trip_distance": 3.456, "fare_amount": 12.34, "tpep_dropoff_datetime": BASE_PICKUP + timedelta(minutes=15, seconds=30)}
    conv = convert_accepted(rules.candidate_rows(classify(spark, [row]))).first()
    assert (conv.distance_millimiles, conv.fare_amount_cents, conv.duration_seconds) == (3456, 1234, 930)


def test_half_even_cents_and_nulls(spark):
    df = spark.createDataFrame([(1.235,), (float("nan"),), (None,), (1.25,)], "x double")
    from tripmart.functions.units import to_cents, to_millimiles

    out = [tuple(r) for r in df.select(to_cents("x"), to_millimiles("x")).collect()]
    assert out == [(124, 1235), (None, None), (None, None), (125, 1250)]


def test_source_row_numbers_are_file_order(spark, tmp_path):
    from tripmart.sources.trips import read_month

    raw = make_raw(spark, [{} for _ in range(5)]).drop("source_row_number", "source_month")
    path = str(tmp_path / "m.parquet")
    raw.coalesce(1).write.parquet(path)
    got = [r.source_row_number for r in read_month(spark, path, "2023-01").orderBy("source_row_number").collect()]
    assert got == [1, 2, 3, 4, 5]


@pytest.mark.parametrize(
    "month, pickup, rejected",
    [
        ("2023-02", datetime(2023, 2, 28, 23, 0), False),
        ("2023-12", datetime(2024, 1, 1, 0, 5), True),
        ("2023-12", datetime(2023, 12, 31, 23, 0), False),
    ],
)
def test_month_bounds(spark, month, pickup, rejected):
    row = {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": pickup + timedelta(minutes=20)}
    assert outcome(spark, row, month)[0] is rejected


def test_issue_rows_one_per_flag(spark):
    rows = [{"VendorID": 99, "payment_type": 99}, {}, {"tip_amount": None}]
    issues = rules.issue_rows(classify(spark, rows)).orderBy("source_row_number", "issue_code").collect()
    assert [(r.source_row_number, r.issue_code) for r in issues] == [
        (1, "UNKNOWN_PAYMENT"), (1, "UNKNOWN_VENDOR"), (3, "NULL_TIP")]


def test_reject_histogram_counts_every_reason(spark):
    rows = [{"trip_distance": 0.0, "fare_amount": -1.0}, {"fare_amount": -2.0}, {}]
    h = {r.reject_code: r.row_count for r in rules.reject_reason_histogram(classify(spark, rows)).collect()}
    assert h == {"NON_POSITIVE_DISTANCE": 1, "NEGATIVE_FARE": 2}


def test_contract_checks(spark):
    from tripmart.sources.trips import check_contract

    good = make_raw(spark, [{}]).drop("source_row_number", "source_month")
    assert check_contract(good).is_valid
    renamed = good.withColumnRenamed("airport_fee", "Airport_fee")
    assert check_contract(renamed).is_valid  # drifted spelling accepted
    missing = good.drop("fare_amount")
    assert check_contract(missing).status == "MISSING_COLUMNS"
    bad = good.withColumn("trip_distance", F.lit("x"))
    assert check_contract(bad).status == "INCOMPATIBLE_TYPES"
    assert check_contract(good.limit(0)).status == "ZERO_ROWS"
    assert check_contract(good.withColumn("extra_col", F.lit(1))).extra_columns == ["extra_col"]


def test_gate_reconciliation_raises_on_bad_counts(spark):
    ok = spark.createDataFrame([("2023-01", 10, 8, 2, 1)], "source_month string, source_rows long, accepted_rows long, rejected_rows long, flagged_rows long")
    assert rules.gate_reconciliation(ok, warn_reject_percent=1.0) == ["2023-01: reject rate 20.00%"]
    bad = spark.createDataFrame([("2023-01", 10, 8, 1, 1)], ok.schema)
    with pytest.raises(RuntimeError):
        rules.gate_reconciliation(bad)
