"""Session helpers: a local session for tests/bench and the shared working folder.

The library itself never creates a session inside a transform; callers pass one in.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Fall back from whole-stage codegen when a generated method is too large for the JIT
    # (HotSpot does not compile methods over 8,000 bytecodes): recommended on clusters too.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripmart") -> SparkSession:
    """Session for tests and the local benchmark. Cluster jobs bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TRIPMART_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator and points at shared storage; it is only
    read here; a cluster session without it is an error. Where a local session lacks it a private folder
    is created and registered, so ``DataFrame.checkpoint()`` and written tables work.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = tempfile.mkdtemp(prefix="tripmart-")
    spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder. ``unique`` adds a fresh leaf for one-off outputs."""
    root = ensure_shared_dir(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([root, *leaf])
