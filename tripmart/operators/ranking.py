"""Positions over all rows without a window over all rows.

Rows are range-partitioned by the order, sorted inside each partition and written; a row's
position is its index in the partition plus the rows of the partitions before it. Only the counts,
one row per partition, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import scratch_path

_INDEX_BITS = 33  # monotonically_increasing_id: partition above, index in the partition below


def numbered(spark: SparkSession, df: DataFrame, *order: Column | str, out: str = "position") -> DataFrame:
    """``df`` with ``out``: 0-based position in ascending ``order``, nulls first; equal rows in any order.

    A hash of the row ends the order, so that a value which a third of all rows share is cut into
    several ranges. The rows are written once, which fixes the partitions that are counted and numbered.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.withColumns({f"_o{k}": c for k, c in enumerate(cols)} | {"_spread": spread})
    keys = [*[f"_o{k}" for k in range(len(cols))], "_spread"]
    sorted_rows = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    path = scratch_path(spark, "numbered", unique=True)
    sorted_rows.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", _INDEX_BITS))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    before = counts.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    index = F.col("_id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return rows.join(before, "_part").select(*df.columns, (F.col("_before") + index).alias(out))


def quantile_classes_spread(spark: SparkSession, df: DataFrame, value: str, classes: int = 5, out: str = "class") -> DataFrame:
    """W4 over any number of rows, with the cuts of ``compare.quantile_classes``: the values at sorted
    positions ``n*i // classes``. The cuts, ``classes - 1`` numbers, pass through the driver."""
    if classes < 2:
        raise ValueError(f"{classes} classes cannot be told apart")
    ranked = numbered(spark, df, value, out="_position")
    n = ranked.count()
    at = [min(n - 1, n * i // classes) for i in range(1, classes)] if n else []
    value_at = {r["_position"]: r[value] for r in ranked.filter(F.col("_position").isin(at)).select("_position", value).collect()}
    count = sum([F.when(F.lit(value_at[p]) <= F.col(value), 1).otherwise(0) for p in at if value_at[p] is not None], F.lit(0))
    return ranked.select(*df.columns, F.least(count, F.lit(classes - 1)).cast("int").alias(out))


def surrogates(spark: SparkSession, dim: DataFrame, fresh: DataFrame) -> DataFrame:
    """K5 for many new members: ``fresh (business_key, ...)`` with surrogate_key = max of ``dim`` + position
    by business key, as ``dims.insert_missing`` numbers them."""
    top = dim.agg(F.coalesce(F.max("surrogate_key"), F.lit(0)).alias("top")).first().top
    rows = numbered(spark, fresh, "business_key", out="_position")
    return rows.select((F.lit(top) + 1 + F.col("_position")).cast("long").alias("surrogate_key"), *fresh.columns)
