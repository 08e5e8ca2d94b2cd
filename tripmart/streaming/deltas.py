"""Window sums as a log of per-batch deltas (R5, R6, K16), with redelivery checked against bitmaps.

Every micro-batch of any size adds the window sums of its own rows under its batch id. Readers add up
the committed batches, so rows count however late they come and whatever triggers they came in;
there is no watermark and no state store. A replayed batch replaces its own folders. Redelivered
events are recognised by the bitmaps of the row numbers of all committed batches before, 4 KiB
for 32,768 row numbers, however long ago they came.

Layout under ``root/table``: ``rows``, ``sums``, ``seen`` (each ``batch_id=N``), ``commits`` (one file per
batch, written last) and ``base/upto=N`` (compacted ``sums`` and ``seen`` with a ``DONE`` file).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tripmart.streaming.trips import WINDOW_KEYS, accepted_rows, event_stream, plain_constraints, sliding_window_aggregates

IDENTITY = ["source_month", "source_row_number"]
MEASURES = ["trip_count", "total_amount_cents_sum", "distance_millimiles_sum", "outlier_count"]
_SUMS = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()), T.StructField("payment_type_id", T.IntegerType()),
    *[T.StructField(m, T.LongType()) for m in MEASURES]])
_SEEN = T.StructType([T.StructField("source_month", T.StringType()), T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType())])


def bit_is_set(bitmap: str, number: str):
    """Whether the bitmap of a number's bucket has the number."""
    position = F.bitmap_bit_position(F.col(number))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(position, F.lit(8)))), F.lit(2)) == 1, F.lit(False))


class DeltaLog:
    """The log of one windowed table."""

    def __init__(self, spark: SparkSession, root: str, table: str = "trip_windows", slide: tuple[str, str] = ("1 hour", "15 minutes")):
        self.spark, self.base, self.slide = spark, f"{root}/{table}", slide
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._Path(f"{self.base}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _touch(self, name: str) -> None:
        self._fs.create(self._Path(f"{self.base}/{name}"), True).close()

    def compacted(self) -> int:
        """The last batch of the newest finished compaction; -1 if there is none."""
        found = [int(n.split("=")[1]) for n in self._names("base") if self._fs.exists(self._Path(f"{self.base}/base/{n}/DONE"))]
        return max(found, default=-1)

    def committed(self) -> list[int]:
        return sorted(int(n) for n in self._names("commits") if n.isdigit())

    def _read(self, kind: str, schema: T.StructType, before: int | None = None) -> DataFrame:
        """Compacted rows and those of the committed batches since (with ``before``: of earlier batches)."""
        upto = self.compacted()
        paths = [f"{self.base}/base/upto={upto}/{kind}"] if upto >= 0 else []
        paths += [f"{self.base}/{kind}/batch_id={n}" for n in self.committed() if n > upto and (before is None or n < before)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def seen(self, before: int | None = None) -> DataFrame:
        """One bitmap per (month, bucket of row numbers)."""
        return self._read("seen", _SEEN, before).groupBy("source_month", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def windows(self) -> DataFrame:
        """The current windows: the sums of all deltas."""
        return self._read("sums", _SUMS).groupBy(*WINDOW_KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch``: one micro-batch of accepted rows."""
        if batch_id <= self.compacted() or batch_id in self.committed():
            return  # a replay has the same rows
        number = F.col("source_row_number")
        one = batch.dropDuplicates(IDENTITY).withColumn("bucket", F.bitmap_bucket_number(number))
        known = one.join(self.seen(before=batch_id), ["source_month", "bucket"], "left")
        fresh = known.filter(~bit_is_set("bitmap", "source_row_number")).drop("bitmap")
        rows = f"{self.base}/rows/batch_id={batch_id}"
        fresh.write.mode("overwrite").parquet(rows)
        written = self.spark.read.schema(fresh.schema).parquet(rows)
        sums = sliding_window_aggregates(written, *self.slide)
        sums.select([F.col(f.name).cast(f.dataType) for f in _SUMS]).write.mode("overwrite").parquet(f"{self.base}/sums/batch_id={batch_id}")
        bitmaps = written.groupBy("source_month", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
        bitmaps.write.mode("overwrite").parquet(f"{self.base}/seen/batch_id={batch_id}")
        self._touch(f"commits/{batch_id}")

    def compact(self) -> int:
        """Fold all committed batches into one; their folders go with the next compaction but one, when no
        reader uses them any more. Returns the last batch folded."""
        done, old = self.committed(), self.compacted()
        if not done or done[-1] <= old:
            return old
        upto = done[-1]
        target = f"{self.base}/base/upto={upto}"
        self.windows().write.mode("overwrite").parquet(f"{target}/sums")
        self.seen().write.mode("overwrite").parquet(f"{target}/seen")
        self._touch(f"base/upto={upto}/DONE")
        for n in done:
            if n <= old:
                for kind in ("sums", "seen"):
                    self._fs.delete(self._Path(f"{self.base}/{kind}/batch_id={n}"), True)
        return upto

    def start(self, accepted: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Batch ids count from a checkpoint, so a log belongs to the checkpoint that began it."""
        owner = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
        if any(name != owner for name in self._names("owner")):
            raise ValueError(f"{self.base} was begun by another checkpoint than {checkpoint}")
        self._touch(f"owner/{owner}")
        writer = accepted.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.merge)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


class ProgressLog(StreamingQueryListener):
    """Every batch's progress as one JSON file, written when the batch ends; nothing is kept or lost in memory.

    ``event_lag_ms`` is the time from the newest event of the batch to its trigger.
    """

    SCHEMA = ("run_id string, batch_id long, trigger_at string, input_rows long, accepted_rows long, newest_event string, "
              "input_rows_per_second double, processed_rows_per_second double, trigger_ms long, event_lag_ms long")
    OBSERVED = "trip_batch"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark.sparkContext._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def observed(cls, accepted: DataFrame) -> DataFrame:
        """``accepted`` with the metrics that the log reads."""
        return accepted.observe(cls.OBSERVED, F.count(F.lit(1)).alias("rows"), F.max(F.unix_millis("event_time")).alias("newest_ms"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        import json
        from datetime import datetime, timezone

        p = json.loads(event.progress.json)
        seen = (p.get("observedMetrics") or {}).get(self.OBSERVED) or {}
        newest = seen.get("newest_ms")
        at = datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00"))
        row = {
            "run_id": p["runId"], "batch_id": p["batchId"], "trigger_at": p["timestamp"], "input_rows": p.get("numInputRows", 0),
            "accepted_rows": seen.get("rows"), "newest_event": None if newest is None else datetime.fromtimestamp(newest / 1000, timezone.utc).isoformat(),
            "input_rows_per_second": p.get("inputRowsPerSecond"), "processed_rows_per_second": p.get("processedRowsPerSecond"),
            "trigger_ms": (p.get("durationMs") or {}).get("triggerExecution"),
            "event_lag_ms": None if newest is None else int(at.timestamp() * 1000) - newest,
        }
        out = self._fs.create(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p['runId']}-{p['batchId']}.json"), True)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def frame(self) -> DataFrame:
        """One row per finished batch of every run."""
        if not self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(self.path)):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).json(self.path)


def run_bounded(spark: SparkSession, source_dir: str, glob: str, root: str, bounds: DataFrame | None = None,
                files_per_trigger: int = 1, table: str = "trip_windows") -> tuple[DeltaLog, ProgressLog]:
    """Run over what is available now in triggers of bounded size, to completion."""
    log, progress = DeltaLog(spark, root, table), ProgressLog(spark, f"{root}/progress")
    accepted = ProgressLog.observed(accepted_rows(event_stream(spark, source_dir, glob, files_per_trigger), bounds=bounds))
    spark.streams.addListener(progress)
    try:
        with plain_constraints(spark):
            query = log.start(accepted, f"{root}/_checkpoints/{table}")
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # the last batch's progress event
    finally:
        spark.streams.removeListener(progress)
    return log, progress
