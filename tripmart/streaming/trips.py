"""Structured Streaming path (R1-R9): trip events from a file source (standing in for a
partitioned topic), the batch row rules applied unchanged (R9), de-duplication of redelivered
events within the watermark (R8), sliding-window aggregates (R2) with late-data handling
(R5), upserted per micro-batch into a date-partitioned table (R4/K16), raw accepted rows
appended (R3/K15), and progress metrics (R7). Backpressure (R6) is ``maxFilesPerTrigger``
here and ``maxOffsetsPerTrigger`` on a Kafka source.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.operators import rules
from tripmart.operators.convert import convert_accepted
from tripmart.operators.outliers import mark_outliers
from tripmart.schema import EVENTS
from tripmart.sources.store import TableStore
from tripmart.sources.trips import EVENTS_MONTH, trips_from_events

WINDOW_KEYS = ["window_start", "window_end", "payment_type_id"]


def event_stream(spark: SparkSession, source_dir: str, glob: str = "events.parquet",
                 max_files_per_trigger: int | None = 1) -> DataFrame:
    """A file stream of trip events with a declared schema (no inference). ``glob`` names a file of
    ``source_dir``, a pattern of files, or a folder of part files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{source_dir}/{glob}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.getFileStatus(path).isDirectory():
        source_dir, glob = f"{source_dir}/{glob}", "*.parquet"
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", glob)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source_dir)
    return events.repartition(F.xxhash64(*events.columns))  # a file of one row group is one task's until here


def accepted_rows(events: DataFrame, source_month: str = EVENTS_MONTH, bounds: DataFrame | None = None) -> DataFrame:
    """The batch rules on the stream, and the outlier flag from the published ``bounds`` (one row per
    month; no flag without them). ``event_time`` is the pickup instant."""
    trips = trips_from_events(events, source_month)
    accepted = convert_accepted(rules.candidate_rows(rules.classify(trips)))
    flagged = accepted.withColumn("has_statistical_outlier", F.lit(False)) if bounds is None else mark_outliers(accepted, bounds)
    return flagged.withColumn("event_time", F.col("pickup_at_local").cast("timestamp"))


def accepted_stream(events: DataFrame, source_month: str = EVENTS_MONTH, watermark: str = "2 hours",
                    bounds: DataFrame | None = None) -> DataFrame:
    """R9 + R8: accepted rows, de-duplicated on the source identity within the watermark.

    Event time is the pickup instant as TIMESTAMP (session zone UTC): watermarks need
    TIMESTAMP, batch tables keep TIMESTAMP_NTZ.
    """
    timed = accepted_rows(events, source_month, bounds)
    return timed.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["source_month", "source_row_number"])


def sliding_window_aggregates(accepted: DataFrame, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """R2: trips and sums per sliding event-time window and payment type (state bounded by
    the watermark; rows later than the watermark are dropped and counted, R5)."""
    g = accepted.groupBy(F.window("event_time", size, slide), F.col("payment_type_id")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount_cents").cast("bigint").alias("total_amount_cents_sum"),
        F.sum("distance_millimiles").cast("bigint").alias("distance_millimiles_sum"),
        F.count_if("has_statistical_outlier").alias("outlier_count"),
    )
    return g.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "payment_type_id",
        "trip_count",
        "total_amount_cents_sum",
        "distance_millimiles_sum",
        "outlier_count",
    )


def upsert_batch(store: TableStore, table: str):
    """``foreachBatch`` keyed merge. Only the window dates touched by the batch are
    read and rewritten (staged, then swapped), so a batch costs its own size, not the
    table's. The touched-date list is tiny (dates of one trigger)."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # its dates and its rows are read apart
        try:
            apply(batch)
        finally:
            batch.unpersist()

    def apply(batch: DataFrame) -> None:
        keyed = batch.withColumn("window_date", F.to_date("window_start").cast("string"))
        dates = [r.window_date for r in keyed.select("window_date").distinct().collect()]
        if not dates:
            return
        if store.exists(table):
            old = store.read(table).filter(F.col("window_date").isin(dates))
            newer = keyed.select(*[F.col(c).alias(f"n_{c}") if c not in WINDOW_KEYS else F.col(c)
                                   for c in keyed.columns])
            j = old.join(newer, WINDOW_KEYS, "full_outer")
            cols = [c for c in keyed.columns if c not in WINDOW_KEYS]
            merged = j.select(*WINDOW_KEYS, *[F.coalesce(F.col(f"n_{c}"), F.col(c)).alias(c) for c in cols])
        else:
            merged = keyed
        store.replace_partitions(table, merged, dates, column="window_date")

    return merge


@contextmanager
def plain_constraints(spark: SparkSession):
    """Queries started here derive no constraints. Spark hands every micro-batch to ``foreachBatch`` with the
    constraints of its plan, whose number multiplies with each rule and alias: seconds per trigger."""
    name = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_window_upsert(agg: DataFrame, store: TableStore, table: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    writer = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        upsert_batch(store, table)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def start_raw_append(accepted: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append accepted rows to a month-partitioned Parquet table (exactly-once via the
    checkpoint and the file sink's log)."""
    writer = (
        accepted.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("source_month")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """lag/throughput metrics of each finished micro-batch (driver metadata, one row per batch)."""
    rows = []
    for p in query.recentProgress:
        state = p.get("stateOperators") or [{}]
        rows.append(
            (
                int(p.get("batchId", -1)),
                int(p.get("numInputRows", 0)),
                float(p.get("inputRowsPerSecond") or 0.0),
                float(p.get("processedRowsPerSecond") or 0.0),
                int((p.get("durationMs") or {}).get("triggerExecution", 0)),
                int(sum(int(s.get("numRowsDroppedByWatermark", 0) or 0) for s in state)),
                str((p.get("eventTime") or {}).get("watermark", "")),
            )
        )
    return spark.createDataFrame(
        rows,
        "batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double, "
        "trigger_ms long, rows_dropped_by_watermark long, watermark string",
    )


def run_sliding_windows(spark: SparkSession, source_dir: str, root: str, table: str = "trip_windows",
                        glob: str = "events.parquet", bounds: DataFrame | None = None) -> tuple[TableStore, StreamingQuery]:
    """Run the window upsert to completion over what is available now (backfills, tests).

    All available files form one micro-batch: the watermark moves between batches only, so that files
    in any order and number give the same, complete windows. What was read and dropped is written to
    ``stream_progress`` (R5, R7).
    """
    store = TableStore(spark, root)
    agg = sliding_window_aggregates(accepted_stream(event_stream(spark, source_dir, glob, None), bounds=bounds))
    with plain_constraints(spark):
        q = start_window_upsert(agg, store, table, f"{root}/_checkpoints/{table}")
    q.awaitTermination()
    store.append("stream_progress", progress_frame(spark, q))
    return store, q
