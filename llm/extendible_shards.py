"""Operator 8, sharding: extendible hashing by bytes.

A row's place is a hash of its id. The directory maps hash prefixes to shards: it starts with one
bucket of no bits, and only a bucket over the byte limit splits on its next bit, until every shard
fits. Splitting needs byte sums per prefix alone: one histogram over the next ``STEP`` bits, with
map-side combination, decides up to ``STEP`` splits of every bucket at once; only rows of buckets that
are still too large enter the next histogram. A hot source or long documents spread by the hash.

Defined cases: null ids hash as the empty string; null text has no bytes; rows that share an id cannot
be parted: a bucket that cannot fit (one row over the limit, or one id) stops at ``MAX_DEPTH`` bits and is
marked ``over_limit``; an empty table has no shards; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.shared import shared_path

HASH_BITS = 60
STEP = 12
MAX_DEPTH = 48
SHARD_BYTES = 1 << 20


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long").alias("h"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"))


def directory(rows: DataFrame, limit: int, max_depth: int = MAX_DEPTH, step: int = STEP) -> DataFrame:
    """(depth, shard, over_limit) of every shard of ``rows (h, n_bytes)``; a shard is its prefix."""
    found = []
    rest = rows
    for low in range(0, max_depth, step):
        high = min(low + step, max_depth)
        fine = rest.groupBy(F.shiftright("h", HASH_BITS - high).alias("p")).agg(F.sum("n_bytes").alias("n"))
        every = fine.select("p", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("shard", F.expr(f"shiftright(p, {high} - depth)"))
        total = every.groupBy("depth", "shard").agg(F.sum("n").alias("n"))
        fits = every.select("p", "depth", "shard").join(total, ["depth", "shard"]).where(F.col("n") <= limit)
        first = fits.groupBy("p").agg(F.min("depth").alias("depth"))
        placed = fine.select("p").join(first, "p", "left")
        found.append(placed.where("depth is not null").select("depth", F.expr(f"shiftright(p, {high} - depth)").alias("shard"), F.lit(False).alias("over_limit")).distinct())
        over = placed.where("depth is null").select("p")
        if high == max_depth:
            found.append(over.select(F.lit(max_depth).alias("depth"), F.col("p").alias("shard"), F.lit(True).alias("over_limit")))
        else:
            if over.isEmpty():
                break
            rest = rest.join(over.withColumnRenamed("p", "_p"), F.shiftright("h", HASH_BITS - high) == F.col("_p"), "left_semi")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _written(docs: DataFrame, limit: int, id_col: str, text_col: str, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """Hashes and sizes of all rows, and the directory, both written once: texts are read a single time."""
    spark = docs.sparkSession
    base = shared_path(spark, f"shards/{uuid.uuid4().hex}")
    _hashed(docs, id_col, text_col).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    directory(rows.select("h", "n_bytes"), limit, max_depth).write.parquet(f"{base}/directory")
    return rows, spark.read.parquet(f"{base}/directory")


def assign(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", max_depth: int = MAX_DEPTH) -> DataFrame:
    """Per row: ``doc_id, n_bytes, depth, shard, shard_bytes, over_limit``."""
    rows, shards = _written(docs, limit, id_col, text_col, max_depth)
    depths = [r["depth"] for r in shards.select("depth").distinct().collect()]  # at most max_depth + 1
    near = F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("h", HASH_BITS - d).alias("shard")) for d in sorted(depths)] or [F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard"))])
    # one of a row's prefixes is in the directory; the sums per shard tell which, from the same join
    placed = rows.select("doc_id", "h", "n_bytes", F.inline(near)).join(shards, ["depth", "shard"])
    sums = placed.groupBy("depth", "shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return placed.join(sums, ["depth", "shard"]).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", "over_limit")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows as Parquet, one folder and one file per shard."""
    rows = docs.withColumn("_h", F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long"))
    _, shards = _written(docs, limit, id_col, text_col)
    named = shards.withColumn("_name", F.concat_ws("-", "depth", "shard"))
    depths = [r["depth"] for r in shards.select("depth").distinct().collect()]
    if not depths:
        docs.withColumn("shard", F.lit("0-0")).write.partitionBy("shard").parquet(path)
        return
    where = F.lit(False)
    for d in depths:
        where = where | ((F.col("depth") == d) & (F.col("shard") == F.shiftright("_h", HASH_BITS - d)))
    near = F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("_h", HASH_BITS - d).alias("shard")) for d in sorted(depths)])
    placed = rows.withColumn("_near", F.explode(near)).join(named, (F.col("_near.depth") == F.col("depth")) & (F.col("_near.shard") == F.col("shard")))
    placed.select(*docs.columns, F.col("_name").alias("shard_name")).repartition("shard_name").write.partitionBy("shard_name").parquet(path)


def op8_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table, shards of at most 1 MiB of text."""
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = f"""
WITH rows AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_BITS // 4}) AS BIGINT) AS h,
         CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes
  FROM documents),
every AS (SELECT h, n_bytes, CAST(d AS INT) AS depth, h >> ({HASH_BITS} - d) AS shard FROM rows, (SELECT unnest(range(0, {MAX_DEPTH + 1})) AS d)),
total AS (SELECT depth, shard, sum(n_bytes) AS n FROM every GROUP BY ALL),
fits AS (SELECT e.h, min(e.depth) AS depth FROM every e JOIN total t USING (depth, shard) WHERE t.n <= {SHARD_BYTES} GROUP BY e.h),
placed AS (SELECT r.doc_id, r.n_bytes, coalesce(f.depth, {MAX_DEPTH}) AS depth, r.h >> ({HASH_BITS} - coalesce(f.depth, {MAX_DEPTH})) AS shard, f.depth IS NULL AS over_limit
           FROM rows r LEFT JOIN fits f USING (h))
SELECT doc_id, n_bytes, depth, shard, CAST(sum(n_bytes) OVER (PARTITION BY depth, shard) AS BIGINT) AS shard_bytes, over_limit FROM placed
"""
