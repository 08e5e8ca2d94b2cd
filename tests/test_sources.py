"""Sources and sinks: CSV zones, multi-month union, fingerprints, raw append, asset upsert."""

import hashlib
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import f2_rows, make_raw


def test_zone_csv_scan_and_insert(spark, tmp_path):
    from tripmart.operators import dims as D

    p = tmp_path / "zones.csv"
    p.write_text("LocationID,Borough,Zone,service_zone\n0,N/A,Skip,N/A\n1,EWR,Newark Airport,EWR\n"
                 "2,Queens,Jamaica Bay,Boro Zone\n")
    dim = D.insert_missing(D.empty_dimension(spark), D.zone_candidates_from_csv(spark, str(p)))
    rows = sorted((r.business_key, r.label, r.attributes) for r in dim.collect())
    assert rows == [(0, "Unknown", None), (1, "Newark Airport", "borough=EWR, service_zone=EWR"),
                    (2, "Jamaica Bay", "borough=Queens, service_zone=Boro Zone")]
    assert [r[0] for r in dim.filter("business_key = 2").select(D.borough_of(F.col("attributes"))).collect()] == ["Queens"]


def test_multi_month_union_of_different_physical_types(spark, tmp_path):
    from tripmart.sources.trips import read_months

    jan = make_raw(spark, [{}, {}]).drop("source_row_number", "source_month")
    feb_rows = [{"tpep_pickup_datetime": datetime(2023, 2, 3, 9), "tpep_dropoff_datetime": datetime(2023, 2, 3, 9, 20)}]
    feb = make_raw(spark, feb_rows, "2023-02").drop("source_row_number", "source_month")
    feb = feb.withColumn("passenger_count", F.col("passenger_count").cast("long")) \
             .withColumnRenamed("airport_fee", "Airport_fee")  # drifted month
    jan.coalesce(1).write.parquet(str(tmp_path / "jan.parquet"))
    feb.coalesce(1).write.parquet(str(tmp_path / "feb.parquet"))
    both = read_months(spark, {"2023-01": str(tmp_path / "jan.parquet"), "2023-02": str(tmp_path / "feb.parquet")})
    got = sorted((r.source_month, r.source_row_number) for r in both.collect())
    assert got == [("2023-01", 1), ("2023-01", 2), ("2023-02", 1)]
    assert dict(both.dtypes)["passenger_count"] == "double" and "airport_fee" in both.columns


def test_fingerprint_equals_sha256(spark, tmp_path):
    from tripmart.sources.fingerprint import file_fingerprints, source_identity

    p = tmp_path / "blob.bin"
    data = bytes(range(256)) * 1000
    p.write_bytes(data)
    fp = file_fingerprints(spark, str(p)).first()
    assert fp.sha256 == hashlib.sha256(data).hexdigest() and fp.byte_size == len(data)
    ident = source_identity(file_fingerprints(spark, str(p)), "2023-01").first()
    assert ident.source_asset_id == f"yellow_tripdata_2023-01:{fp.sha256[:12]}"


def test_raw_append_stream(spark, tmp_path):
    from tripmart.streaming.trips import accepted_stream, event_stream, start_raw_append

    src = tmp_path / "ev"
    events = spark.createDataFrame(
        [(i, datetime(2024, 1, 5, 10) + timedelta(minutes=i), i, "view", 5.0 + i, '{"k": 2}') for i in range(1, 20)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(str(src))
    acc = accepted_stream(event_stream(spark, str(src), glob="*.parquet"))
    q = start_raw_append(acc, str(tmp_path / "raw"), str(tmp_path / "ck"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "raw"))
    assert out.count() == 19 and out.select("source_month").distinct().first()[0] == "2024-01"


def test_asset_upsert_and_views_on_rerun(spark, tmp_path):
    from tripmart.operators import ops as O
    from tripmart.plans.publish import SourceAsset, publish
    from tripmart.sources.store import TableStore

    store = TableStore(spark, str(tmp_path))
    zones = spark.createDataFrame([(1, "Z", "borough=B, service_zone=S")], "business_key int, label string, attributes string")
    asset = SourceAsset("2023-01", "yellow_tripdata_2023-01:abc", "abc" + "0" * 61, 10, True)
    for _ in range(2):
        publish(spark, store, make_raw(spark, f2_rows()), [asset], zones)
    assets = store.read("source_asset").collect()
    assert len(assets) == 1 and assets[0].row_count == 6 and assets[0].byte_size == 10
    fp = O.fingerprints(store.read("source_asset")).collect()
    assert len(fp) == 1 and fp[0].sha256 == asset.source_version
    th = O.thresholds(store.read("pipeline_run")).collect()
    assert len(th) == 1 and th[0].reference_snapshot_id is not None
    st = O.publication_state(store.read("pipeline_run"), store.read("source_asset")).first()
    assert st.warehouse_version == "2" and st.is_synthetic is True


def test_trip_columns_are_computed_once(spark):
    """The reject rules name a column many times; its expression is in the plan once."""
    from tripmart.operators import rules
    from tripmart.operators.convert import convert_accepted
    from tripmart.sources.trips import trips_from_events

    events = spark.createDataFrame(
        [(k, datetime(2024, 1, 1 + k % 28), 7, "view", 10.0, f'{{"k": {k}}}') for k in range(40)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    accepted = convert_accepted(rules.candidate_rows(rules.classify(trips_from_events(events))))
    plan = accepted._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("timestampadd") == 2
    assert accepted.columns[0] == "source_month" and accepted.count() > 0
