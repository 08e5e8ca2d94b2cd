"""Source fingerprint (S4, S5) and schema fingerprint.

The hash of a file is computed by executors and equals ``sha256sum``. A task reads a file in pieces with a
running digest, so that files of any size take constant memory. On stores that only Spark's readers reach, a
file is held whole in one task's memory, up to Spark's limit of 2 GB per file, beyond which the read fails. A
source of several files has one identity over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task holds of a file at a time.
PIECE = 8 << 20

#: Schemes that tasks open by themselves.
STREAMED_SCHEMES = ("file", "hdfs")


def _open(path: str):
    """A stream of a listed path, which is not percent-encoded."""
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream("/" + path[len("file:"):].lstrip("/"))
    store, name = fs.FileSystem.from_uri(quote(path, safe=":/"))
    return store.open_input_stream(name)


def _digests(batches):
    import hashlib

    import pyarrow as pa

    for batch in batches:
        hashes = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with _open(path) as source:
                while piece := source.read(PIECE):
                    digest.update(piece)
            hashes.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("byte_size"), pa.array(hashes, pa.string())],
                                         names=["path", "byte_size", "sha256"])


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, byte size, SHA-256 hex."""
    files = spark.read.format("binaryFile").load(path)
    listed = files.select("path", F.col("length").alias("byte_size"))
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    scheme = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme not in STREAMED_SCHEMES:
        return files.select("path", F.col("length").alias("byte_size"), F.sha2(F.col("content"), 256).alias("sha256"))
    return listed.mapInArrow(_digests, "path string, byte_size long, sha256 string")  # the listing reads no content


def source_fingerprint_of(spark: SparkSession, path: str) -> DataFrame:
    """One row for a file or a folder of files: total size, and the file's SHA-256 or, of several files, the
    SHA-256 over their names, sizes and hashes in name order."""
    name = F.element_at(F.split("path", "/"), -1)
    files = file_fingerprints(spark, path).select(name.alias("name"), "byte_size", "sha256")
    # one small row per file; the order makes the identity independent of how they were listed
    listed = files.agg(F.sort_array(F.collect_list(F.struct("name", "byte_size", "sha256"))).alias("f"), F.sum("byte_size").alias("byte_size"))
    lines = F.transform("f", lambda x: F.concat_ws(" ", x["sha256"], x["byte_size"].cast("string"), x["name"]))
    whole = F.when(F.size("f") == 1, F.col("f")[0]["sha256"]).otherwise(F.sha2(F.array_join(lines, "\n"), 256))
    return listed.select(F.lit(path).alias("path"), "byte_size", whole.alias("sha256"))


def source_identity(fingerprints: DataFrame, source_month: str, name: str = "yellow_tripdata") -> DataFrame:
    """Asset id ``name_month:hash12``; version = full hash."""
    return fingerprints.select(
        F.lit(source_month).alias("source_month"),
        F.concat(F.lit(f"{name}_{source_month}:"), F.substring("sha256", 1, 12)).alias("source_asset_id"),
        F.col("sha256").alias("source_version"),
        "byte_size",
    )


def schema_fingerprint(df: DataFrame) -> str:
    """SHA-256 of the schema JSON (computed from metadata only, no scan)."""
    import hashlib

    return hashlib.sha256(df.schema.json().encode("utf-8")).hexdigest()
