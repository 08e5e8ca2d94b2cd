"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.shared import shared_path

MAX_ROUNDS = 60


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's smallest node.

    Each round points all larger neighbours of a node to the smallest one (large star), then all
    smaller ones (small star); both only take minima per node, combined before the shuffle. A round is
    written to the shared folder, which cuts the lineage and survives lost executors.
    """
    base = shared_path(spark, f"components/{uuid.uuid4().hex}")
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    mark = None
    for k in range(MAX_ROUNDS):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        star = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        star.write.parquet(f"{base}/{k}")
        now = spark.read.parquet(f"{base}/{k}")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == state:
            break
        mark = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
