"""Table storage in the shared folder.

* *Versioned month tables* (K3, K7-K9, K11): a publish writes its rows beside the published ones, under
  ``table/source_month=M/publication=P``, where ``P`` is new for every attempt. Readers see the
  publication that the latest successful run record of each month names, so that one append to the run
  table switches all tables of a publish at once, and a failed or lost publish is never visible.
* *Versioned reference tables* (K5, K6): whole rewrites under ``table/publication=P``; the same run record names
  the version of each that readers see.
* *Commits* (K10): a publish's run records are one file, ``pipeline_run/commit-N``, created only if no other
  publisher has made commit ``N``; the file order is the order of publishes and gives distinct run ids.
* *Replaced partitions* (K16): staging, then checked renames; the old partition is set aside and put back
  if the new one cannot take its place.
* Appends and whole-table rewrites of tables outside publishes.

Data is always written by executors (``DataFrame.write``); the driver only renames and deletes
directories through the Hadoop FileSystem API.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLICATION = "publication"
RUN_TABLE = "pipeline_run"
MONTH = "source_month"
#: column of the run table: reference table -> publication that its rows are read from
REFERENCES = "reference_tables"

#: mark in the recorded schema: a publication holds the whole (reference) table, not a month
WHOLE = "whole_table"


@dataclass(frozen=True)
class Head:
    """The last commit: its number (0 if there is none), the next run id, the versions of reference tables."""

    number: int = 0
    next_id: int = 1
    tables: dict[str, str] = field(default_factory=dict)


def publication_time(publication: str) -> _dt.datetime:
    """When a publication began, from its name."""
    return _dt.datetime.strptime(publication[:15], "%Y%m%dT%H%M%S").replace(tzinfo=_dt.timezone.utc)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(conf)
        self._fs.mkdirs(self._Path(self.root))

    # -- paths -----------------------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _p(self, path: str):
        return self._Path(path)

    def exists(self, table: str) -> bool:
        return self._fs.exists(self._p(f"{self.path(table)}/_schema.json"))

    def _staging(self, table: str) -> str:
        return f"{self.root}/_staging/{table}-{uuid.uuid4().hex[:12]}"

    # -- schema sidecar --------------------------------------------------------------------
    def _write_schema(self, table: str, schema: T.StructType) -> None:
        """Record a schema whole: another publisher may be reading or recording it at the same time."""
        if self.exists(table) and self.schema(table) == schema:
            return
        self._fs.mkdirs(self._p(self.path(table)))
        written, target = f"{self._staging(table)}.json", f"{self.path(table)}/_schema.json"
        out = self._fs.create(self._p(written), True)
        out.write(bytearray(schema.json().encode("utf-8")))
        out.close()
        try:
            if not self._create(written, target) and self.schema(table) != schema:
                self._fs.delete(self._p(target), False)
                self._move(written, target)
        finally:
            self.delete_path(written)

    def schema(self, table: str) -> T.StructType:
        stream = self._fs.open(self._p(f"{self.path(table)}/_schema.json"))
        reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
            self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        text = []
        line = reader.readLine()
        while line is not None:
            text.append(line)
            line = reader.readLine()
        reader.close()
        return T.StructType.fromJson(json.loads("".join(text)))

    # -- reads -------------------------------------------------------------------------------
    def _all_versions(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.schema(table)).parquet(self.path(table))

    def pointers(self) -> DataFrame:
        """V4: (source_month, publication, run_id) that readers see: the latest successful run of each month."""
        runs = self._all_versions(RUN_TABLE).where((F.col("status") == "success") & F.col(PUBLICATION).isNotNull())
        return runs.groupBy("source_month").agg(F.max_by(PUBLICATION, "id").alias(PUBLICATION), F.max("id").alias("run_id"))

    def snapshot(self) -> list[str]:
        """The published folders at this moment, one per month, to read several tables alike."""
        if not self.exists(RUN_TABLE):
            return []
        return [f"{r.source_month}/{r.publication}" for r in self.pointers().collect()]

    def head(self) -> Head:
        """The state that the next commit builds on. Rows read are one per run and month."""
        numbers = [int(m[1]) for m in map(re.compile(r"commit-(\d+)\.parquet").fullmatch, self._names(self.path(RUN_TABLE))) if m]
        if not numbers:
            return Head()
        ok = F.when((F.col("status") == "success") & F.col(REFERENCES).isNotNull(), F.col("id"))
        row = self._all_versions(RUN_TABLE).agg(F.max("id").alias("top"), F.max_by(REFERENCES, ok).alias("tables")).first()
        return Head(max(numbers), (row.top or 0) + 1, dict(row.tables or {}))

    def _folders(self, table: str, folders: list[str]) -> DataFrame:
        """Rows of the listed publication folders; only these are listed, however many others there are."""
        schema = self.schema(table)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.path(table)).schema(schema).parquet(*folders)

    def read(self, table: str, snapshot: list[str] | None = None) -> DataFrame:
        """Read a table with its recorded schema; of a versioned table, the published rows only (those
        of ``snapshot``, or of now)."""
        schema = self.schema(table)
        if table == RUN_TABLE or PUBLICATION not in schema.names:
            return self._all_versions(table)
        if schema[PUBLICATION].metadata.get(WHOLE):
            return self.read_version(table, self.head().tables.get(table, ""))
        seen = self.snapshot() if snapshot is None else snapshot
        paths = [f"{self.path(table)}/{MONTH}={month}/{PUBLICATION}={name}" for month, _, name in (s.partition("/") for s in seen)]
        return self._folders(table, [p for p in paths if self._fs.exists(self._p(p))]).drop(PUBLICATION)

    def read_version(self, table: str, publication: str) -> DataFrame:
        """The rows of one publication, published or not."""
        return self._folders(table, self._publication_folders(table, publication)).drop(PUBLICATION)

    def read_files(self, table: str, files: list[tuple[str, str]], snapshot: list[str]) -> DataFrame:
        """Rows of the listed (month, file name) of a versioned month table, as of ``snapshot``."""
        seen = dict(s.split("/", 1) for s in snapshot)
        paths = [f"{self.path(table)}/{MONTH}={month}/{PUBLICATION}={seen[month]}/{name}" for month, name in files]
        return self._folders(table, paths).drop(PUBLICATION)

    def committed(self, publication: str) -> bool:
        """Whether a successful run record names ``publication``."""
        if not self.exists(RUN_TABLE):
            return False
        named = (F.col("status") == "success") & (F.col(PUBLICATION) == publication)
        return not self._all_versions(RUN_TABLE).where(named).isEmpty()

    def _names(self, folder: str) -> list[str]:
        p = self._p(folder)
        return [st.getPath().getName() for st in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _publication_folders(self, table: str, pattern: str) -> list[str]:
        """Folders of a table whose publication matches a glob, month and reference tables alike."""
        found = []
        for parent in (self.path(table), f"{self.path(table)}/{MONTH}=*"):
            found += [st.getPath().toString() for st in self._fs.globStatus(self._p(f"{parent}/{PUBLICATION}={pattern}")) or []]
        return found

    # -- writes ------------------------------------------------------------------------------
    def _partition_dirs(self, base: str, column: str) -> dict[str, str]:
        p = self._p(base)
        if not self._fs.exists(p):
            return {}
        out = {}
        for st in self._fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{column}="):
                out[name.split("=", 1)[1]] = st.getPath().toString()
        return out

    def _move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._p(source), self._p(target)):
            raise OSError(f"could not rename {source} to {target}")

    def _swap(self, fresh: str | None, target: str) -> None:
        """Put ``fresh`` (nothing: remove) in the place of ``target``; on failure the old one is put back."""
        aside = f"{self.root}/_staging/old-{uuid.uuid4().hex}"
        had = self._fs.exists(self._p(target))
        self._fs.mkdirs(self._p(f"{self.root}/_staging"))
        if had:
            self._move(target, aside)
        try:
            if fresh is not None:
                self._move(fresh, target)
        except OSError:
            if had:
                self._move(aside, target)
            raise
        if had:
            self._fs.delete(self._p(aside), True)

    def write_version(self, table: str, df: DataFrame, publication: str, sort_within: list[str] | None = None,
                      gather: tuple[str, ...] = (MONTH,)) -> None:
        """Add a publication of a month table. Rows are gathered by month (or by ``gather``) first, and Spark splits
        what is too large for one task and joins what is small, so that a month has a few large files, not one per
        task; tables that are aggregates already need no ``gather``."""
        out = df.hint("rebalance", *gather) if gather else df
        if sort_within:
            out = out.sortWithinPartitions(MONTH, *sort_within)
        # a folder of its own: jobs that append to one folder at a time remove each other's temporary files
        stage = self._staging(table)
        try:
            out.write.partitionBy(MONTH).parquet(stage)
            for month, folder in self._partition_dirs(stage, MONTH).items():
                parent = f"{self.path(table)}/{MONTH}={month}"
                self._fs.mkdirs(self._p(parent))
                self._move(folder, f"{parent}/{PUBLICATION}={publication}")
        finally:
            self.delete_path(stage)
        self._write_schema(table, T.StructType([*df.schema.fields, T.StructField(PUBLICATION, T.StringType())]))

    def drop_publication(self, tables: list[str], publication: str) -> None:
        """Remove the files of an unpublished publication, its merges (``P-1``, ...) included."""
        for table in tables:
            for folder in self._publication_folders(table, f"{publication}*"):
                self.delete_path(folder)

    def write_references(self, tables: dict[str, DataFrame], publication: str) -> None:
        """Add a version of reference tables of one schema, with ONE write job: for small tables the job count
        dominates. Nothing is visible before a commit names the version."""
        if not tables:
            return
        from functools import reduce

        frames = [df.withColumn("_table", F.lit(name)) for name, df in tables.items()]
        stage = self._staging("references")
        try:
            reduce(lambda a, b: a.unionByName(b), frames).write.partitionBy("_table").parquet(stage)
            fresh = self._partition_dirs(stage, "_table")
            for name, df in tables.items():
                self._fs.mkdirs(self._p(self.path(name)))
                target = f"{self.path(name)}/{PUBLICATION}={publication}"
                if name in fresh:
                    self._move(fresh[name], target)
                else:
                    self._fs.mkdirs(self._p(target))
                self._write_schema(name, T.StructType([*df.schema.fields, T.StructField(PUBLICATION, T.StringType(), metadata={WHOLE: True})]))
        finally:
            self.delete_path(stage)

    def commit(self, rows: DataFrame, number: int) -> bool:
        """Append run records (K10) as commit ``number``; False if another publisher has taken the number.

        Creating the file is the one step that publishes. It must fail where the target exists: a hard link does
        on local disks, a rename on HDFS. On stores whose rename replaces its target, only a check before it
        protects a commit, so publishers there must take turns.
        """
        stage = self._staging(RUN_TABLE)
        target = f"{self.path(RUN_TABLE)}/commit-{number:012d}.parquet"
        try:
            rows.coalesce(1).write.parquet(stage)
            written = next(f"{stage}/{n}" for n in self._names(stage) if n.startswith("part-"))
            self._write_schema(RUN_TABLE, rows.schema)
            return self._create(written, target)
        finally:
            self.delete_path(stage)

    def _create(self, source: str, target: str) -> bool:
        if self._fs.getScheme() == "file":
            try:
                os.link(*[self._p(x).toUri().getPath() for x in (source, target)])
            except FileExistsError:
                return False
            return True
        return not self._fs.exists(self._p(target)) and self._fs.rename(self._p(source), self._p(target))

    def sweep(self, tables: list[str], keep_hours: float = 24.0, now: _dt.datetime | None = None) -> list[str]:
        """Remove publications that readers no longer see, and return their folders.

        Kept: what the latest commits name, what they named within the last ``keep_hours`` (readers of an older
        snapshot), and unnamed publications that began within it (publishes under way).
        """
        limit = (now or _dt.datetime.now(_dt.timezone.utc)) - _dt.timedelta(hours=keep_hours)
        runs = self._all_versions(RUN_TABLE).where((F.col("status") == "success") & F.col(PUBLICATION).isNotNull())
        named = runs.select("id", "finished_at", F.col(MONTH).alias("of"), PUBLICATION).unionByName(
            runs.select("id", "finished_at", F.explode(REFERENCES).alias("of", PUBLICATION)))
        until = F.lead("finished_at").over(Window.partitionBy("of").orderBy("id", "finished_at"))
        current = named.withColumn("until", until).where(F.col("until").isNull() | (F.col("until") > F.lit(limit)))
        kept = {(r["of"], r[PUBLICATION]) for r in current.select("of", PUBLICATION).distinct().collect()}  # a row per month or table
        gone = []
        for table in tables:
            for folder in self._publication_folders(table, "*"):
                parent, name = folder.rsplit(f"/{PUBLICATION}=", 1)
                of = parent.rsplit(f"{MONTH}=", 1)[1] if f"/{MONTH}=" in parent else table
                if (of, name) not in kept and publication_time(name) < limit:
                    self.delete_path(folder)
                    gone.append(folder)
        return gone

    def replace_partitions(self, table: str, df: DataFrame, values: list[str], column: str = "source_month") -> None:
        """Replace the ``column`` partitions listed in ``values`` with the rows of ``df``.

        A value with no rows removes the old partition (an empty month is a real outcome, not a no-op);
        rows of any other value are an error, before anything is replaced.
        """
        stage = self._staging(table)
        try:
            df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(stage)
            fresh = self._partition_dirs(stage, column)
            if unlisted := sorted(set(fresh) - set(values)):
                raise ValueError(f"rows of unlisted {column}: {', '.join(unlisted)}")
            self._fs.mkdirs(self._p(self.path(table)))
            for value in values:
                self._swap(fresh.get(value), f"{self.path(table)}/{column}={value}")
        finally:
            self.delete_path(stage)
        # Partition column stays in the recorded schema (it is appended by discovery).
        self._write_schema(table, df.schema)

    def overwrite(self, table: str, df: DataFrame) -> None:
        """Whole-table rewrite via staging then swap (safe when ``df`` reads ``table`` itself)."""
        stage = self._staging(table)
        schema = df.schema
        df.write.mode("overwrite").parquet(stage)
        self._swap(stage, self.path(table))
        self._write_schema(table, schema)

    def delete_path(self, path: str) -> None:
        """Remove a work folder (stage) after a successful publish."""
        p = self._p(path)
        if self._fs.exists(p):
            self._fs.delete(p, True)

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(table))
        if not self.exists(table):
            self._write_schema(table, df.schema)
