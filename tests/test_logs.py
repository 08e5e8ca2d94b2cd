"""Observation history, bucketed as-of joins, the delta log, contracts per file, positions, bitmaps."""

from __future__ import annotations

import itertools
import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import make_raw
from pyspark.sql import functions as F

from tripmart.operators import dims as D
from tripmart.operators.fact import duplicate_identities
from tripmart.operators.history import asof_bucketed, history, record_snapshot
from tripmart.operators.ops import redact_payload
from tripmart.operators.ranking import numbered, quantile_classes_spread, surrogates
from tripmart.sources.store import TableStore
from tripmart.sources.trips import contract_files, read_month

LOG = "business_key long, label string, attributes string, observed_at timestamp"
DAYS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]
STATES = [[(1, "a", "x"), (2, "b", "y"), (3, "c", None)], [(1, "a", "z"), (3, "c", None)], [(1, "a", "x"), (2, "b", "y"), (4, "d", "q")], [(1, "a", "x"), (2, "b", "n"), (4, "d", "q")]]
SNAP = "business_key long, label string, attributes string"


def _versions(df):
    return sorted((r.business_key, str(r.observed_from)[:7], str(r.observed_to)[:7], r.attributes, r.is_current) for r in df.collect())


def test_history_is_the_same_for_any_order_of_snapshots(spark, scratch):
    found = set()
    for n, order in enumerate([*itertools.permutations(range(4))][::7] + [(2, 2, 0, 3, 1, 0)]):
        store = TableStore(spark, f"{scratch}/{n}")
        for k in order:
            record_snapshot(store, "log", spark.createDataFrame(STATES[k], SNAP), DAYS[k])
        log = store.read("log")
        found.add((tuple(_versions(history(log))), tuple(_versions(history(log, close_vanished=True)))))
        assert D.overlapping_versions(history(log).withColumnRenamed("version_key", "surrogate_key")).count() == 0
    assert len(found) == 1
    stay, close = found.pop()
    assert [v for v in stay if v[0] == 1] == [(1, "2024-01", "2024-02", "x", False), (1, "2024-02", "2024-03", "z", False), (1, "2024-03", "None", "x", True)]
    assert [v for v in stay if v[0] == 2] == [(2, "2024-01", "2024-04", "y", False), (2, "2024-04", "None", "n", True)]
    assert [v for v in close if v[0] == 2] == [(2, "2024-01", "2024-02", "y", False), (2, "2024-03", "2024-04", "y", False), (2, "2024-04", "None", "n", True)]
    assert [v for v in close if v[0] == 3] == [(3, "2024-01", "2024-03", None, False)]


def test_history_of_nothing_and_of_the_seeded_key(spark):
    assert history(spark.createDataFrame([], LOG)).count() == 0
    assert history(spark.createDataFrame([(0, "u", None, datetime(2024, 1, 1))], LOG), close_vanished=True).count() == 0


def test_a_late_snapshot_is_refused_by_the_interval_merge(spark):
    at = lambda day: F.to_timestamp(F.lit(day))
    states = [spark.createDataFrame([(1, "a", x)], "business_key int, label string, attributes string") for x in "xyz"]
    dim = D.scd2_merge(D.scd2_merge(D.empty_dimension(spark), states[0], at(DAYS[0])), states[1], at(DAYS[2]))
    with pytest.raises(Exception, match="late snapshot"):
        D.scd2_merge(dim, states[2], at(DAYS[1])).collect()


def test_asof_with_ten_thousand_versions_of_a_hot_key(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    log = [(1, f"v{k}", None, start + timedelta(seconds=200 * k + rng.randrange(200))) for k in range(10_000)]
    log += [(2, "only", None, start + timedelta(days=3)), (3, "p", None, start), (3, "q", None, start + timedelta(microseconds=1))]
    versions = history(spark.createDataFrame(log, LOG))
    facts = [(n, rng.choice([1, 1, 2, 3, 4, None]), start + timedelta(seconds=rng.randrange(-90_000, 2_600_000))) for n in range(3000)] + [(9999, 1, None)]
    table = spark.createDataFrame(facts, "n long, zone long, t timestamp")
    got = {r.n: r.z_label for r in asof_bucketed(table, versions, "zone", "t", "z").collect()}
    assert len(got) == len(facts)
    for n, zone, t in facts:
        fits = [(at, label) for key, label, _, at in log if key == zone and t is not None and at <= t] if zone in (1, 2, 3) else []
        assert got[n] == (max(fits)[1] if fits else None)
    # bucket rows grow with the versions, matches with the facts
    assert asof_bucketed(table, versions, "zone", "t", "z").count() == len(facts)


def _events(spark, n):
    rows = [(i, datetime(2024, 1, 5, 10, 0) + timedelta(minutes=7 * i), i % 9, "purchase", 10.0 + i, '{"k": 1}') for i in range(1, n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_delta_log_equals_the_batch_result(spark, tmp_path):
    from tripmart.streaming.deltas import DeltaLog, run_bounded
    from tripmart.streaming.trips import WINDOW_KEYS, accepted_rows, sliding_window_aggregates

    events = _events(spark, 60)
    src = tmp_path / "in"
    for k in (2, 0, 1, 0):  # out of order, and the second file once more
        events.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(str(src))
    log, progress = run_bounded(spark, str(src), "*.parquet", str(tmp_path / "out"))
    want = sorted(map(tuple, sliding_window_aggregates(accepted_rows(events)).select(*WINDOW_KEYS, "trip_count", "total_amount_cents_sum").collect()))
    shown = lambda x: sorted(map(tuple, x.windows().select(*WINDOW_KEYS, "trip_count", "total_amount_cents_sum").collect()))
    assert shown(log) == want
    rows = progress.frame().collect()
    assert sorted(r.batch_id for r in rows) == [0, 1, 2, 3]
    assert sum(r.input_rows for r in rows) == 59 + sum(1 for i in range(1, 60) if i % 3 == 0)
    assert all(r.event_lag_ms > 0 and r.trigger_ms > 0 for r in rows)
    # a replayed batch, a compaction, and late redelivery after it change nothing
    batch = accepted_rows(events).withColumn("bucket", F.lit(0)).drop("bucket")
    log.merge(batch, 1)
    assert shown(log) == want
    assert log.compact() == 3 and shown(log) == want
    log.merge(batch, 4)
    assert shown(log) == want
    assert log.compact() == 4 and log.compact() == 4 and shown(log) == want
    more = accepted_rows(_events(spark, 80))
    log.merge(more, 5)
    assert log.windows().agg(F.sum("trip_count")).first()[0] == 4 * more.count()
    with pytest.raises(ValueError, match="another checkpoint"):
        DeltaLog(spark, str(tmp_path / "out")).start(accepted_rows(spark.readStream.schema(events.schema).parquet(str(src))), "elsewhere")


def test_contract_names_the_file_at_fault(spark, tmp_path):
    raw = make_raw(spark, [{}, {"fare_amount": 3.0}]).drop("source_row_number", "source_month").coalesce(1)
    path = str(tmp_path / "m")
    raw.write.parquet(f"{path}/a")
    raw.drop("tip_amount").withColumn("fare_amount", F.col("fare_amount").cast("string")).write.parquet(f"{path}/b")
    raw.withColumn("total_amount", F.col("total_amount").cast("string")).write.parquet(f"{path}/c")
    rows = {r.file.split("/")[-2]: r for r in contract_files(spark, path, "2023-01").collect()}
    assert [rows[k].status for k in "abc"] == ["VALID", "MISSING_COLUMNS", "INCOMPATIBLE_TYPES"]
    assert rows["b"].missing_required == ["tip_amount"] and rows["c"].incompatible_types == {"total_amount": "string"}
    assert rows["c"].drift == {"total_amount": "string"} and {r.row_count for r in rows.values()} == {2}
    with pytest.raises(ValueError, match="MISSING_COLUMNS"):
        read_month(spark, path, "2023-01")


def test_a_month_of_files_with_types_of_one_family(spark, tmp_path):
    raw = make_raw(spark, [{"VendorID": 1}, {"VendorID": 2}]).drop("source_row_number", "source_month").coalesce(1)
    path = str(tmp_path / "m")
    raw.write.parquet(f"{path}/a")
    raw.withColumn("VendorID", F.col("VendorID").cast("int")).withColumnRenamed("airport_fee", "Airport_fee").write.parquet(f"{path}/b")
    got = [(r.source_row_number, r.VendorID) for r in read_month(spark, path, "2023-01").orderBy("source_row_number").collect()]
    assert got == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_positions_without_a_window_over_all_rows(spark):
    rng = random.Random(2)
    values = [7] * 700 + [rng.randrange(100) for _ in range(1300)] + [None] * 5
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id long, v int").repartition(5)
    got = {r.id: r.position for r in numbered(spark, df, "v", "id").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == [k for k, _ in sorted(enumerate(values), key=lambda x: (x[1] is not None, x[1] or 0, x[0]))]
    assert sorted(got.values()) == list(range(len(values)))
    known = df.filter("v is not null")
    from tripmart.operators.compare import quantile_classes

    same = quantile_classes(known, "v").select("id", "class")
    assert quantile_classes_spread(spark, known, "v").select("id", "class").exceptAll(same).count() == 0
    assert quantile_classes_spread(spark, known.limit(0), "v").count() == 0
    dim = D.insert_missing(D.empty_dimension(spark), spark.createDataFrame([(5, "e", None)], "business_key int, label string, attributes string"))
    fresh = spark.createDataFrame([(9, "i"), (3, "c")], "business_key int, label string")
    assert sorted((r.business_key, r.surrogate_key) for r in surrogates(spark, dim, fresh).collect()) == [(3, 2), (9, 3)]


def test_duplicates_by_bitmaps(spark):
    rows = [("m", 20240101, 1, "v", n) for n in [*range(1, 40_000), 7, 7, 39_999]] + [("m", 20240102, 1, "v", 7), ("m", 20240101, 2, "v", 7), ("n", 20240201, 1, "v", 1)]
    facts = spark.createDataFrame(rows, "source_month string, pickup_date_key int, source_asset_id long, source_version string, source_row_number long")
    out = duplicate_identities(facts)
    assert {r.source_month: r.duplicate_rows for r in out.collect()} == {"m": 3, "n": 0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "distinct" not in plan.lower()


def test_redaction_at_any_depth(spark):
    inner = {"token": "far", "status": "secret=1", "owner": "x"}
    for k in range(12):
        inner = {"labels": [inner] if k % 2 else inner}
    m = spark.createDataFrame([(json.dumps(inner),), ('{"status": "[not json"}',), (None,), ('{"status": "token=1"}',)], "p string")
    out = [r.m for r in m.select(redact_payload(F.col("p")).alias("m")).collect()]
    value = out[0]["labels"]
    while isinstance(value, str) and value[:1] in "{[" or isinstance(value, list):
        value = value[0] if isinstance(value, list) else json.loads(value)
        if isinstance(value, dict) and "labels" in value:
            value = value["labels"]
    assert value == {"token": "[REDACTED]", "status": "secret=[REDACTED]", "owner": "[OMITTED]"}
    assert out[1] == {"status": "[not json"} and out[2] is None and out[3] == {"status": "token=[REDACTED]"}
