"""Reference history from an observation log (V1, W5) and skew-safe as-of joins.

The log holds every snapshot row as it was observed: (business_key, label, attributes, observed_at).
Intervals are derived from the whole log each time, so snapshots may arrive late, twice or in any
order, and keys may vanish and return. A dimension of intervals cannot take a late snapshot: it no longer
knows when an unchanged state was seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.dims import row_hash
from tripmart.sources.store import TableStore

LOG_COLUMNS = ["business_key", "label", "attributes", "observed_at"]


def record_snapshot(store: TableStore, table: str, snapshot: DataFrame, observed_at: str) -> None:
    """Put a snapshot (business_key, label, attributes) into the log, in a partition of its own: the same
    snapshot recorded again replaces itself. ``observed_at`` is a timestamp as text."""
    day = observed_at.replace(" ", "T").replace(":", "-")
    rows = snapshot.select(
        F.col("business_key").cast("long").alias("business_key"), "label", F.col("attributes").cast("string").alias("attributes"),
        F.to_timestamp(F.lit(observed_at)).alias("observed_at"), F.lit(day).alias("snapshot_id"))
    store.replace_partitions(table, rows, [day], column="snapshot_id")


def history(log: DataFrame, close_vanished: bool = False, instants: DataFrame | None = None) -> DataFrame:
    """(version_key, business_key, label, attributes, observed_from, observed_to, is_current).

    Gaps and islands per key: an observation opens a version where its row hash differs from the one
    before; a version ends where the next one begins. With ``close_vanished`` a key that is missing from
    a snapshot ends there, and opens a new version when it returns; ``instants (observed_at)`` are the
    snapshots taken, by default those of the log. Business key 0 is skipped (the seeded row); of two
    states observed at one instant the one with the larger hash counts.
    """
    state = F.struct(row_hash("label", "attributes").alias("hash"), "label", "attributes")
    seen = (
        log.filter(F.col("business_key") != 0)
        .groupBy("business_key", F.col("observed_at").cast("timestamp").alias("observed_at"))
        .agg(F.max(state).alias("s"))
    )
    by_key = Window.partitionBy("business_key").orderBy("observed_at")
    fresh = F.lag("s.hash").over(by_key).isNull() | (F.lag("s.hash").over(by_key) != F.col("s.hash"))
    if close_vanished:
        taken = (log if instants is None else instants).select(F.col("observed_at").cast("timestamp").alias("observed_at")).distinct()
        # one row per snapshot taken
        taken = taken.withColumn("next_at", F.lead("observed_at").over(Window.orderBy("observed_at")))
        seen = seen.join(taken, "observed_at", "left")
        fresh = fresh | ~F.lag("next_at").over(by_key).eqNullSafe(F.col("observed_at"))
    island = F.sum(F.col("fresh").cast("int")).over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    marked = seen.withColumn("fresh", fresh).withColumn("island", island)
    end = F.max_by("next_at", "observed_at") if close_vanished else F.lit(None).cast("timestamp")
    versions = marked.groupBy("business_key", "island").agg(
        F.min("observed_at").alias("observed_from"), end.alias("observed_to"), F.max("s").alias("s"))
    if not close_vanished:
        following = F.lead("observed_from").over(Window.partitionBy("business_key").orderBy("observed_from"))
        versions = versions.withColumn("observed_to", following)
    return versions.select(
        F.xxhash64("business_key", "observed_from").alias("version_key"),
        "business_key",
        "s.label",
        "s.attributes",
        "observed_from",
        "observed_to",
        F.col("observed_to").isNull().alias("is_current"),
    )


# --- J12 with versions cut into time buckets ---------------------------------------------------

#: Buckets per version of a key: the more, the fewer versions a fact is compared with.
BUCKETS_PER_VERSION = 2


def _bucket(at: Column) -> Column:
    return F.floor((at - F.col("_lo")) / F.col("_width"))


def asof_bucketed(facts: DataFrame, versions: DataFrame, key_col: str, time_col: str, prefix: str,
                  per_version: int = BUCKETS_PER_VERSION) -> DataFrame:
    """J12 for keys with many versions: as ``dims.asof_lookup``, by an equi-join on (key, time bucket).

    A key's buckets are equally wide and ``per_version`` times as many as its versions, so its
    versions fill at most ``1 + per_version`` times their number of bucket rows whatever their
    lengths, and a fact meets only the versions of its own bucket (about ``1 + 1 / per_version`` when starts
    are spread evenly) in place of all of its key. A key with a third of all facts spreads over its buckets, and
    sides stay plain shuffles that Spark can split. ``versions`` must not overlap (J10); columns other
    than key, label, attributes, observed_from and observed_to are left out.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    v = versions.select(
        F.col("business_key").alias("_key"), "label", "attributes", micros("observed_from").alias("_from"), micros("observed_to").alias("_to"))
    scale = v.groupBy("_key").agg(
        F.min("_from").alias("_lo"), F.max("_from").alias("_hi"), F.count(F.lit(1)).alias("_n"),
    ).withColumn("_width", F.greatest(F.lit(1.0), F.ceil((F.col("_hi") - F.col("_lo") + 1) / (F.col("_n") * per_version))))
    # the last bucket also holds all that lies behind the last start
    last = _bucket(F.greatest(F.col("_from"), F.least(F.coalesce(F.col("_to") - 1, F.col("_hi")), F.col("_hi"))))
    cut = v.join(scale, "_key").withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("_from")), last)))
    right = cut.select(
        F.col("_key").alias("_vkey"), F.col("_bucket").alias("_vbucket"), F.col("_from").alias("_vfrom"), F.col("_to").alias("_vto"),
        F.col("label").alias(f"{prefix}_label"), F.col("attributes").alias(f"{prefix}_attributes"),
        F.timestamp_micros("_from").alias(f"{prefix}_observed_from"))
    timed = facts.withColumn("_at", micros(time_col)).join(scale.withColumnRenamed("_key", "_skey"), F.col(key_col) == F.col("_skey"), "left")
    placed = timed.withColumn("_fbucket", _bucket(F.least(F.col("_at"), F.col("_hi"))))
    hit = (
        (F.col(key_col) == F.col("_vkey")) & (F.col("_fbucket") == F.col("_vbucket"))
        & (F.col("_vfrom") <= F.col("_at")) & (F.col("_vto").isNull() | (F.col("_at") < F.col("_vto")))
    )
    out = placed.join(right, hit, "left")
    return out.select(*facts.columns, f"{prefix}_label", f"{prefix}_attributes", f"{prefix}_observed_from")
