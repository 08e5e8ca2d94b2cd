"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the folder named by ``spark.checkpoint.dir``; a private one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _private.setdefault("root", f"file://{tempfile.mkdtemp(prefix='llm-')}")
    return f"{root.rstrip('/')}/{name}"


_private: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Make this subpackage importable in the Python workers of the session; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="llm-code-")) / "llm.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(here.glob("*.py")):
            out.write(file, f"llm/{file.name}")
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def shipped(query: Callable) -> Callable:
    """A query ``(spark, ...)`` that ships the subpackage first."""

    @wraps(query)
    def run(spark: SparkSession, *args, **kwargs):
        ship(spark)
        return query(spark, *args, **kwargs)

    return run


_shipped: set[str] = set()
