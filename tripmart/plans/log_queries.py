"""Registered queries over logs and files: observation history, as-of joins against many versions, bounded
stream backfills, file contracts and positions. Same conventions as ``registry``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.history import asof_bucketed, history, record_snapshot
from tripmart.operators.ops import redact_payload
from tripmart.operators.ranking import numbered, quantile_classes_spread
from tripmart.session import scratch_path
from tripmart.sources.store import TableStore
from tripmart.sources.trips import cast_to_raw, contract_files, events_trip_view

SNAPSHOTS = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")


def _customer_log(spark, sf_dir):
    """Three states of ``customer``, recorded in the order first, third, second, second: in the second some
    keys are missing and some segments differ, in the third others are missing and some nations differ."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")

    def state(rows, label, place):
        return rows.select(key.alias("business_key"), label.alias("label"), F.concat(F.lit("nation="), place.cast("string")).alias("attributes"))

    moved = F.when(key % 5 == 0, F.lit("MOVED")).otherwise(segment)
    back = F.when((key % 5 == 0) & (key % 10 != 0), F.lit("MOVED")).otherwise(segment)
    first = state(c, segment, nation)
    second = state(c.filter(key % 11 != 0), moved, nation)
    third = state(c.filter(key % 13 != 0), back, F.when(key % 3 == 0, nation + 100).otherwise(nation))
    store = TableStore(spark, scratch_path(spark, "observations", unique=True))
    for rows, at in ((first, 0), (third, 2), (second, 1), (second, 1)):
        record_snapshot(store, "customer_log", rows, SNAPSHOTS[at])
    return store.read("customer_log")


def _shown(versions):
    return versions.select("business_key", "label", "attributes", F.col("observed_from").cast("timestamp_ntz").alias("observed_from"),
                           F.col("observed_to").cast("timestamp_ntz").alias("observed_to"), "is_current")


def scd2_customer_history(spark, sf_dir):
    """History from snapshots that came late and twice; keys missing from a snapshot stay."""
    return _shown(history(_customer_log(spark, sf_dir)))


def scd2_customer_gaps(spark, sf_dir):
    """The same log, where a key that a snapshot lacks ends there and opens anew when it returns."""
    return _shown(history(_customer_log(spark, sf_dir), close_vanished=True))


def asof_event_versions(spark, sf_dir):
    """Every event with its user's last purchase at or before it; each purchase is a version."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # of purchases at one instant, the one with the largest id counts
    bought = events.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("value"))
    member = F.col("user_id") + 1  # key 0 is the seeded row
    log = bought.select(member.alias("business_key"), F.col("value").cast("string").alias("label"),
                        F.col("ts").cast("string").alias("attributes"), F.col("ts").cast("timestamp").alias("observed_at"))
    pinned = asof_bucketed(events.select("event_id", "user_id", "ts", member.alias("member")), history(log), "member", "ts", "bought")
    return pinned.select("event_id", "user_id", F.col("bought_label").cast("double").alias("bought_value"),
                         F.col("bought_observed_from").cast("timestamp_ntz").alias("bought_at"))


def source_contract_files(spark, sf_dir):
    """A month of five files made from ``events``: one in order, one with an extra column and a
    narrower type of the same family, one without ``tip_amount``, one with fares as text, one without rows."""
    trips = cast_to_raw(events_trip_view(spark, sf_dir).drop("source_month"))
    rows = trips.withColumn("part", F.pmod("source_row_number", F.lit(4))).drop("source_row_number")
    path = scratch_path(spark, "contract", unique=True)

    def put(name, df):
        df.drop("part").coalesce(1).write.parquet(f"{path}/{name}")

    put("a", rows.filter("part = 0"))
    put("b", rows.filter("part = 1").withColumns({"zone_note": F.lit("x"), "VendorID": F.col("VendorID").cast("int")}))
    put("c", rows.filter("part = 2").drop("tip_amount"))
    put("d", rows.filter("part = 3").withColumn("fare_amount", F.col("fare_amount").cast("string")))
    put("e", rows.filter("part < 0"))
    found = contract_files(spark, path, "2024-01")
    return found.select(
        "source_month", F.element_at(F.split("file", "/"), -2).alias("file"), "status", F.array_join("missing_required", ",").alias("missing_required"),
        F.array_join("extra_columns", ",").alias("extra_columns"), F.array_join(F.map_keys("incompatible_types"), ",").alias("incompatible_columns"),
        F.array_join(F.array_sort(F.map_keys("drift")), ",").alias("drifted_columns"), "row_count")


def _backfill(spark, sf_dir):
    """``events`` in four files dealt by the id, so that each spans the whole time, one file a trigger;
    the first is delivered again at the end."""
    from tripmart.plans.warehouse import warehouse_for
    from tripmart.streaming.deltas import run_bounded

    root = scratch_path(spark, "backfill", unique=True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    schema = T.StructType(events.schema.fields)
    for k in range(4):
        events.filter((F.col("event_id") % 4) == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    spark.read.schema(schema).parquet(f"{root}/in").filter((F.col("event_id") % 4) == 0).coalesce(1).write.mode("append").parquet(f"{root}/in")
    bounds = warehouse_for(spark, sf_dir).table("outlier_bounds")
    return run_bounded(spark, f"{root}/in", "*.parquet", root, bounds=bounds)


def backfill_windows(spark, sf_dir):
    """The sliding windows from a delta log filled by bounded triggers, out of order, with a
    redelivery after all else; equal to the batch result."""
    log, _ = _backfill(spark, sf_dir)
    log.compact()
    return log.windows()


def backfill_progress(spark, sf_dir):
    """Totals of the progress table, which has one row per batch."""
    _, progress = _backfill(spark, sf_dir)
    return progress.frame().agg(F.count(F.lit(1)).alias("batches"), F.countDistinct("batch_id").alias("batch_ids"),
                                F.sum("input_rows").alias("input_rows"), F.sum("accepted_rows").alias("accepted_rows"),
                                F.count_if(F.col("event_lag_ms") > 0).alias("lagging_batches"))


def ranked_orders(spark, sf_dir):
    """Position and quantile class of every order by price, without a window over all rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    placed = numbered(spark, orders, "o_totalprice", "o_orderkey", out="price_position")
    return quantile_classes_spread(spark, placed, "o_totalprice", out="price_class").select("o_orderkey", "price_position", "price_class")


def redacted_deep_payloads(spark, sf_dir):
    """H4 beyond the levels of Column expressions: whole texts seven objects and lists deep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null")
    inner = F.struct(F.col("text").alias("event"), F.col("lang").alias("token"), F.col("source").alias("owner"))
    for k in range(6):
        inner = F.struct((F.array(inner) if k % 2 else inner).alias("labels"), F.lit("k").alias("api_key"))
    red = redact_payload(F.to_json(inner))["labels"]
    # labels holds JSON text of an object, or of a list of one text, level by level
    for k in range(5, -1, -1):
        if k % 2:
            red = F.from_json(red, "array<string>")[0]
        last = F.from_json(red, "map<string,string>")
        red = last["labels"]
    return docs.select("doc_id", last["event"].alias("event"), last["token"].alias("token"), last["owner"].alias("owner"))


LOG_QUERIES = {
    "scd2_customer_history": scd2_customer_history,
    "scd2_customer_gaps": scd2_customer_gaps,
    "asof_event_versions": asof_event_versions,
    "source_contract_files": source_contract_files,
    "backfill_windows": backfill_windows,
    "backfill_progress": backfill_progress,
    "ranked_orders": ranked_orders,
    "redacted_deep_payloads": redacted_deep_payloads,
}
