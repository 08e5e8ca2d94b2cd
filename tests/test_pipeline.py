"""End to end with golden output: the six-row fixture through the publish job, the three
required queries, idempotent rerun, and the empty-month replace."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import f2_rows, make_raw
from tripmart.operators import metrics as M
from tripmart.plans.publish import SourceAsset, publish, read_dimensions
from tripmart.plans.warehouse import Warehouse
from tripmart.sources.store import TableStore


def _zones(spark):
    return spark.createDataFrame([(1, "Newark Airport", "borough=EWR, service_zone=EWR")],
                                 "business_key int, label string, attributes string")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    store = TableStore(spark, root)
    asset = SourceAsset("2023-01", "yellow_tripdata_2023-01:abc", "abc" * 21 + "d", 1, True)
    res1 = publish(spark, store, make_raw(spark, f2_rows()), [asset], _zones(spark))
    res2 = publish(spark, store, make_raw(spark, f2_rows()), [asset], _zones(spark))  # rerun
    return store, res1, res2


def test_counts_and_rerun(published):
    store, r1, r2 = published
    c = r1.counts[0]
    assert (c["source_rows"], c["accepted_rows"], c["rejected_rows"], c["flagged_rows"], c["issue_rows"]) == (6, 4, 2, 1, 2)
    assert r2.counts == r1.counts
    assert store.read("fact_trips").count() == 4  # replaced, not appended
    assert store.read("trip_quality_issue").count() == 2
    assert store.read("quarantine_rejected").count() == 2
    assert store.read("pipeline_run").count() == 2


def test_facts_summary_and_gates(spark, published):
    store, _, _ = published
    wh = Warehouse(store)
    assert wh.facts.filter(F.col("pickup_zone_key") == 0).count() == 0
    assert store.read("quality_result_summary").agg(F.sum("row_count")).first()[0] == 2
    from tripmart.operators.fact import duplicate_identities, orphan_counts

    assert duplicate_identities(wh.facts).first().duplicate_rows == 0
    assert orphan_counts(wh.facts, wh.dims).agg(F.sum("orphan_rows")).first()[0] == 0
    # mart total equals fact total
    assert wh.mart.agg(F.sum("trip_count")).first()[0] == 4


def test_required_queries_golden(spark, published):
    store, _, _ = published
    wh = Warehouse(store)
    fpm = sorted(tuple(r) for r in M.avg_fare_per_mile(wh.facts).collect())
    assert fpm == [(20230101, 15.0), (20230102, 15.0), (20230131, 15.0)]
    peak = M.peak_hours(wh.facts, wh.dims.time).orderBy(F.col("trip_count").desc(), "pickup_hour").collect()
    assert tuple(peak[0]) == (1, "Late Night", "01:00", 2)
    assert {tuple(r) for r in peak[1:]} == {(9, "Morning", "09:00", 1), (23, "Evening", "23:00", 1)}
    rev = {tuple(r) for r in M.revenue_by_payment(wh.facts, wh.dims).collect()}
    assert rev == {(2, "Cash", 100.0, 2, 50.0), (0, "Unknown", 50.0, 1, 50.0), (1, "Credit card", 20.0, 1, 20.0)}


def test_dashboard_kpis_on_fixture(spark, published):
    store, _, _ = published
    k = M.kpis(Warehouse(store).metrics, M.DashboardFilters(date(2023, 1, 1), date(2023, 1, 31))).first()
    assert k.trip_count == 4 and k.gross_revenue_dollars == 170.0
    assert k.fare_per_mile_dollars == 15.0


def test_empty_month_replace_removes_old_partition(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([("2023-01", 1), ("2023-02", 2)], "source_month string, v int")
    store.replace_partitions("t", rows, ["2023-01", "2023-02"])
    assert store.read("t").count() == 2
    store.replace_partitions("t", rows.filter("false"), ["2023-01"])
    assert [r.source_month for r in store.read("t").collect()] == ["2023-02"]


def test_failed_write_keeps_old_partition(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([("2023-01", 1)], "source_month string, v int")
    store.replace_partitions("t", rows, ["2023-01"])
    boom = rows.withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        store.replace_partitions("t", boom, ["2023-01"])
    assert [tuple(r) for r in store.read("t").select("source_month", "v").collect()] == [("2023-01", 1)]


def test_dimension_insert_is_idempotent(spark, published):
    store, _, _ = published
    dims = read_dimensions(store)
    assert dims.payment.count() == 7  # Unknown member + six lookup keys
    assert dims.zone.count() == 2
    assert dims.date.count() == 32  # January 2023 plus the boundary day
