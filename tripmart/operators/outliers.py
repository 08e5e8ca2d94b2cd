"""Statistical outlier bounds (A21-A27) and the outlier predicate.

Two bound methods, both one grouped aggregate per month:

* ``exact``: a histogram of the integer metric (month, metric, value -> count), combined
  map-side and spread over all tasks by value, then a running sum over at most the metric's
  domain (< 86,400 seconds, < 1,000,000 millimiles) per month. Deterministic, so it is the
  default and the one oracle-checked.
* ``kll``: Spark's mergeable KLL sketch (``kll_sketch_agg_float``, k = 4096), one binary
  sketch per month that can be stored and merged across months (calibration).

Bounds are one row per month; they are joined back by ``source_month`` with a broadcast
whose size is bounded by the number of months in the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.schema import (
    DISTANCE_RANGE,
    DURATION_RANGE,
    HIGH_QUANTILE,
    LOW_QUANTILE,
    SKETCH_K,
)

METRICS = {
    "duration_seconds": DURATION_RANGE,
    "distance_millimiles": DISTANCE_RANGE,
}


def _in_range(metric: str) -> Column:
    lo, hi = METRICS[metric]
    c = F.col(metric)
    return (c > lo) & (c < hi)


def exact_bounds(converted: DataFrame, low: float = LOW_QUANTILE, high: float = HIGH_QUANTILE) -> DataFrame:
    """Exact inclusive quantile bounds per month (the smallest value with at least that share at or
    below it); null bounds only when a month has no value in range."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.when(_in_range(m), F.col(m).cast("bigint")).alias("value")) for m in METRICS])
    counted = converted.select("source_month", F.inline(values)).groupBy("source_month", "metric", "value").agg(F.count(F.lit(1)).alias("n"))
    each = Window.partitionBy("source_month", "metric")  # at most the metric's domain
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    ranked = counted.select("*", F.sum(known).over(each.orderBy("value")).alias("upto"), F.sum(known).over(each).alias("total"))

    def at(metric: str, share: float) -> Column:
        reached = F.col("upto") >= F.ceil(F.lit(share) * F.col("total"))
        return F.min(F.when((F.col("metric") == metric) & reached, F.col("value")))

    bounds = [at(m, share).alias(f"{m}_{side}") for m in METRICS for side, share in (("low", low), ("high", high))]
    return ranked.groupBy("source_month").agg(*bounds)


def month_sketches(values: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One serialized KLL sketch (binary) per month and metric, plus the candidate count.

    ``values`` has ``source_month`` and the metric columns (float input is cast here).
    """
    aggs = [F.count(F.lit(1)).alias("candidate_rows")]
    for metric in METRICS:
        v = F.when(_in_range(metric), F.col(metric).cast("float"))
        aggs.append(F.call_function("kll_sketch_agg_float", v, F.lit(k)).alias(f"{metric}_sketch"))
    return values.groupBy("source_month").agg(*aggs)


def merge_sketches(sketches: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Merge month sketches (e.g. a calibration baseline) into one sketch per group."""
    group = group or []
    aggs = [F.sum("candidate_rows").alias("candidate_rows")]
    aggs += [
        F.call_function("kll_merge_agg_float", F.col(f"{m}_sketch")).alias(f"{m}_sketch") for m in METRICS
    ]
    aggs.append(F.collect_set("source_month").alias("baseline_months"))
    return sketches.groupBy(*group).agg(*aggs) if group else sketches.agg(*aggs)


def sketch_bounds(sketches: DataFrame, low: float = LOW_QUANTILE, high: float = HIGH_QUANTILE) -> DataFrame:
    """Quantile bounds and sketch size from serialized sketches.

    An empty sketch cannot be queried, so the getter is guarded on n > 0.
    """
    out = [c for c in sketches.columns if not c.endswith("_sketch")]
    cols = [F.col(c) for c in out]
    for metric in METRICS:
        sk = F.col(f"{metric}_sketch")
        n = F.call_function("kll_sketch_get_n_float", sk)
        q = F.call_function("kll_sketch_get_quantile_float", sk, F.array(F.lit(low), F.lit(high)))
        cols += [
            n.alias(f"{metric}_n"),
            F.when(n > 0, F.round(q[0]).cast("bigint")).alias(f"{metric}_low"),
            F.when(n > 0, F.round(q[1]).cast("bigint")).alias(f"{metric}_high"),
        ]
    return sketches.select(*cols)


def kll_bounds(converted: DataFrame, k: int = SKETCH_K, **kw) -> DataFrame:
    """A21 + A23 for the publish path: per-month sketch bounds."""
    return sketch_bounds(month_sketches(converted, k), **kw).select(
        "source_month", *[f"{m}_{s}" for m in METRICS for s in ("low", "high")]
    )


def outside(metric: str) -> Column:
    """Strictly outside either bound; equal is inside; a null bound tests nothing."""
    value, low, high = F.col(metric), F.col(f"{metric}_low"), F.col(f"{metric}_high")
    return F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))


def outlier_flag() -> Column:
    """Outside the bounds of any metric."""
    return reduce(lambda a, b: a | b, map(outside, METRICS))


def mark_outliers(converted: DataFrame, bounds: DataFrame) -> DataFrame:
    """Attach ``has_statistical_outlier``. Bounds are one row per month: a broadcast whose size is
    bounded by the number of months in the job, never by the number of trips."""
    joined = converted.join(F.broadcast(bounds), on="source_month", how="left")
    return joined.withColumn("has_statistical_outlier", outlier_flag()).drop(
        *[c for c in bounds.columns if c != "source_month"]
    )


def calibrate(converted_months: DataFrame, k: int = SKETCH_K, version_id: str | None = None) -> DataFrame:
    """Baseline calibration over several months into one threshold version (long form:
    one row per metric). Sketches are built per month, merged, then read once."""
    merged = merge_sketches(month_sketches(converted_months, k))
    bounds = sketch_bounds(merged)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"{m}_low").alias("low_bound"),
            F.col(f"{m}_high").alias("high_bound"),
            F.col(f"{m}_n").alias("n"),
        )
        for m in METRICS
    ]
    vid = F.lit(version_id) if version_id else F.sha2(F.concat_ws(",", F.array_sort("baseline_months")), 256)
    return bounds.select(
        vid.alias("threshold_version_id"),
        F.array_sort("baseline_months").alias("baseline_months"),
        F.lit(k).alias("k"),
        F.lit(LOW_QUANTILE).alias("low_quantile"),
        F.lit(HIGH_QUANTILE).alias("high_quantile"),
        F.explode(F.array(*rows)).alias("b"),
    ).select("threshold_version_id", "baseline_months", "k", "low_quantile", "high_quantile", "b.*")


OUTLIER_CODES = {"duration_seconds": "STAT_OUTLIER_DURATION", "distance_millimiles": "STAT_OUTLIER_DISTANCE"}


def outlier_issue_rows(converted: DataFrame, bounds: DataFrame) -> DataFrame:
    """One issue row per metric a trip is an outlier on, with the value and the bounds.
    Bounds are one row per month (broadcast, bounded by the months of the job)."""
    j = converted.join(F.broadcast(bounds), on="source_month", how="inner")
    parts = []
    for metric, code in OUTLIER_CODES.items():
        lo, hi, v = F.col(f"{metric}_low"), F.col(f"{metric}_high"), F.col(metric)
        parts.append(
            F.when(outside(metric),
                   F.struct(F.lit(code).alias("issue_code"), v.cast("bigint").alias("metric_value"),
                            lo.alias("low_bound"), hi.alias("high_bound")))
        )
    return j.select("source_month", "source_row_number", F.explode(F.array_compact(F.array(*parts))).alias("i")).select(
        "source_month", "source_row_number", "i.*")


def derived_metric_sketch_bounds(converted: DataFrame, k: int = SKETCH_K, low: float = LOW_QUANTILE,
                                 high: float = HIGH_QUANTILE) -> DataFrame:
    """KLL bounds of speed (mph) and fare per mile (dollars) per month. These metrics are
    continuous, so a value->count map would not be bounded: the sketch is the scalable form."""
    speed, fpm = (value() for value in DERIVED.values())
    g = converted.groupBy("source_month").agg(
        F.call_function("kll_sketch_agg_double", speed, F.lit(k)).alias("speed_mph_sketch"),
        F.call_function("kll_sketch_agg_double", fpm, F.lit(k)).alias("fare_per_mile_sketch"),
    )
    out = [F.col("source_month")]
    for m in ("speed_mph", "fare_per_mile"):
        sk = F.col(f"{m}_sketch")
        n = F.call_function("kll_sketch_get_n_double", sk)
        q = F.call_function("kll_sketch_get_quantile_double", sk, F.array(F.lit(low), F.lit(high)))
        out += [n.alias(f"{m}_n"), F.when(n > 0, q[0]).alias(f"{m}_low"), F.when(n > 0, q[1]).alias(f"{m}_high")]
    return g.select(*out)


#: Normalised rank error allowed to the sketches (k = 4096 gives well under 0.001 with high confidence).
RANK_ERROR = 0.002


def rank_checks(values: DataFrame, bounds: DataFrame, keys: list[str], low: float = LOW_QUANTILE,
                high: float = HIGH_QUANTILE, error: float = RANK_ERROR) -> DataFrame:
    """Per ``keys``, the exact number of values and whether each bound's true rank lies within
    ``error`` of its quantile. ``values`` has the keys and ``value``; ``bounds`` the keys, ``low`` and ``high``."""
    both = values.join(bounds, keys)
    n = F.count(F.lit(1))

    def near(bound: str, share: float) -> Column:
        below = F.count_if(F.col("value") < F.col(bound)) / n
        upto = F.count_if(F.col("value") <= F.col(bound)) / n
        return (below - error <= share) & (share <= upto + error)

    return both.groupBy(*keys).agg(n.alias("n"), near("low", low).alias("low_rank_ok"), near("high", high).alias("high_rank_ok"))


def in_range_values(converted: DataFrame) -> DataFrame:
    """(source_month, metric, value) of every value that the bounds are drawn from."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.when(_in_range(m), F.col(m).cast("double")).alias("value")) for m in METRICS])
    return converted.select("source_month", F.inline(pairs)).where("value is not null")


def long_bounds(bounds: DataFrame, metrics: list[str], keep: list[str]) -> DataFrame:
    """Wide bounds (``<metric>_low``, ``<metric>_high``) as one row per metric."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_low").cast("double").alias("low"), F.col(f"{m}_high").cast("double").alias("high")) for m in metrics])
    return bounds.select(*keep, F.inline(rows))


DERIVED = {
    "speed_mph": lambda: F.when(F.col("duration_seconds") > 0, F.col("distance_millimiles") * 3.6 / F.col("duration_seconds")),
    "fare_per_mile": lambda: F.when(F.col("distance_millimiles") > 0, F.col("fare_amount_cents") * 10.0 / F.col("distance_millimiles")),
}


def derived_values(converted: DataFrame) -> DataFrame:
    """(source_month, metric, value) of the derived metrics."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), value().alias("value")) for m, value in DERIVED.items()])
    return converted.select("source_month", F.inline(pairs)).where("value is not null")
