"""Trip sources: monthly raw files (S1, S2, S8), the source contract (S3) and the
driver-table trip view (the test carrier built from ``events``).

Every reader returns a lazy DataFrame with the RAW_TRIP columns plus
``source_row_number`` (1-based file order) and ``source_month`` ('YYYY-MM').
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import CONTRACT_FAMILIES, RAW_TRIP, REQUIRED_COLUMNS

MONTH_RE = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def check_month(source_month: str) -> str:
    """A month argument must look like YYYY-MM."""
    if not MONTH_RE.match(source_month or ""):
        raise ValueError(f"source month must be YYYY-MM, got {source_month!r}")
    return source_month


# ---------------------------------------------------------------------------
# S3 source contract
# ---------------------------------------------------------------------------


@dataclass
class SourceContract:
    status: str = "VALID"  # VALID | MISSING_COLUMNS | INCOMPATIBLE_TYPES | ZERO_ROWS
    extra_columns: list[str] = field(default_factory=list)
    missing_required: list[str] = field(default_factory=list)
    incompatible_types: dict[str, str] = field(default_factory=dict)

    @property
    def is_valid(self) -> bool:
        return self.status == "VALID"


def _normalized_names(columns: list[str]) -> dict[str, str]:
    """Map contract names to file names; S2: the drifted ``Airport_fee`` spelling resolves to ``airport_fee``."""
    names = {c: c for c in columns}
    if "airport_fee" not in names and "Airport_fee" in names:
        names["airport_fee"] = names.pop("Airport_fee")
    return names


def check_contract(df: DataFrame, check_rows: bool = True) -> SourceContract:
    """Missing/extra columns and type families from the schema; zero rows by ``limit(1)``.

    Only the schema is inspected, except for one ``limit(1)`` probe: no full scan.
    """
    contract = check_schema(df.schema)
    if contract.is_valid and check_rows and df.limit(1).count() == 0:
        contract.status = "ZERO_ROWS"
    return contract


def check_schema(schema: T.StructType) -> SourceContract:
    """Missing and extra columns and type families of one physical schema."""
    names = _normalized_names(schema.names)
    present = set(names)
    contract = SourceContract(extra_columns=sorted(present - set(REQUIRED_COLUMNS)))
    missing = sorted(set(REQUIRED_COLUMNS) - present)
    if missing:
        contract.missing_required = missing
        contract.status = "MISSING_COLUMNS"
        return contract
    types = {f.name: f.dataType for f in schema.fields}
    for col, families in CONTRACT_FAMILIES.items():
        actual = types[names[col]]
        if families is None or type(actual).__name__ == "NullType":
            continue
        if not isinstance(actual, families):
            contract.incompatible_types[col] = actual.simpleString()
    if contract.incompatible_types:
        contract.status = "INCOMPATIBLE_TYPES"
    return contract


def contract_frame(spark: SparkSession, source_month: str, contract: SourceContract) -> DataFrame:
    """The contract outcome as a one-row DataFrame (one row per month file)."""
    return spark.createDataFrame(
        [
            (
                source_month,
                contract.status,
                contract.missing_required,
                contract.extra_columns,
                contract.incompatible_types,
            )
        ],
        "source_month string, status string, missing_required array<string>, "
        "extra_columns array<string>, incompatible_types map<string,string>",
    )


def cast_to_raw(df: DataFrame) -> DataFrame:
    """Project the contract columns in declared order and cast to RAW_TRIP (lenient casts)."""
    names = _normalized_names(df.columns)
    cols = [F.col(f"`{names[f.name]}`").try_cast(f.dataType).alias(f.name) for f in RAW_TRIP.fields]
    extras = [c for c in df.columns if c in ("source_row_number", "source_month")]
    return df.select(*cols, *[F.col(c) for c in extras])


# ---------------------------------------------------------------------------
# S1 / S8 month files
# ---------------------------------------------------------------------------


#: Footers that are read at a time.
FOOTER_READERS = 8


def month_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files of a month (a file, or a folder at any depth), in the order of their paths."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(root).isFile():
        return [fs.getFileStatus(root).getPath().toString()]
    found, files = fs.listFiles(root, True), []
    while found.hasNext():
        file = found.next().getPath()
        if not any(part.startswith(("_", ".")) for part in file.toString().removeprefix(root.toString()).split("/")):
            files.append(file.toString())
    return sorted(files)


def file_schemas(spark: SparkSession, files: list[str]) -> dict[str, T.StructType]:
    """The physical schema of every file: Spark reads each footer in a task, some files at a time."""
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        return dict(zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files), strict=True))


def contract_files(spark: SparkSession, path: str, source_month: str) -> DataFrame:
    """The contract outcome of every file of a month, one row per file.

    ``drift`` are the columns whose type differs from the month's first file, or that the first file
    lacks, with their types; ``row_count`` is read from the footers. A month is valid if all its
    files are and any has a row; an empty file beside others is no fault.
    """
    check_month(source_month)
    schemas = file_schemas(spark, month_files(spark, path))
    first = {f.name: f.dataType.simpleString() for f in next(iter(schemas.values())).fields} if schemas else {}
    rows = []
    for file, schema in schemas.items():
        c = check_schema(schema)
        drift = {f.name: f.dataType.simpleString() for f in schema.fields if first.get(f.name) != f.dataType.simpleString()}
        rows.append((source_month, file, c.status, c.missing_required, c.extra_columns, c.incompatible_types, drift))
    table = spark.createDataFrame(
        rows, "source_month string, file string, status string, missing_required array<string>, extra_columns array<string>, "
        "incompatible_types map<string,string>, drift map<string,string>")
    if not schemas:
        return table.withColumn("row_count", F.lit(0).cast("bigint"))
    # without columns Spark counts rows from the footers; local paths are listed with one slash
    scan = spark.read.schema(T.StructType([])).parquet(*schemas)
    name = F.regexp_replace(F.col("_metadata.file_path"), "^file:///", "file:/")
    counts = scan.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("row_count"))
    return table.join(counts, "file", "left").select(
        *table.columns[:2],
        F.when((F.col("status") == "VALID") & F.col("row_count").isNull(), F.lit("ZERO_ROWS")).otherwise(F.col("status")).alias("status"),
        *table.columns[3:], F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))


def month_faults(schemas: dict[str, T.StructType]) -> dict[str, SourceContract]:
    """The files whose schema breaks the contract."""
    checked = {file: check_schema(schema) for file, schema in schemas.items()}
    return {file: c for file, c in checked.items() if not c.is_valid}


def read_month(spark: SparkSession, path: str, source_month: str, validate: bool = True) -> DataFrame:
    """Read one raw month, every file by its own schema, check the contract of all files, cast.

    ``source_row_number`` numbers the rows of the whole month from 1: files in the order of their
    paths, rows in their physical order inside a file. It is the same at every read of the same files
    (never ``monotonically_increasing_id``). Files that agree in their schema are one scan.
    """
    check_month(source_month)
    schemas = file_schemas(spark, month_files(spark, path))
    if not schemas:
        raise ValueError(f"no files for {source_month}: {path}")
    if validate and (faults := month_faults(schemas)):
        raise ValueError(f"source contract failed for {source_month}: {faults}")
    alike: dict[str, list[str]] = {}
    for file, schema in schemas.items():
        alike.setdefault(schema.json(), []).append(file)
    index = F.col("_metadata.row_index") + F.lit(1)
    if len(schemas) == 1:
        df = spark.read.parquet(*schemas)
        if validate and df.limit(1).count() == 0:
            raise ValueError(f"source contract failed for {source_month}: {SourceContract('ZERO_ROWS')}")
        return cast_to_raw(df.withColumn("source_row_number", index).withColumn("source_month", F.lit(source_month)))
    scans = [spark.read.schema(schemas[files[0]]).parquet(*files) for files in alike.values()]
    files = reduce(lambda a, b: a.unionByName(b), [
        s.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n")) for s in scans])
    if validate and files.limit(1).count() == 0:
        raise ValueError(f"source contract failed for {source_month}: {SourceContract('ZERO_ROWS')}")
    # rows of the files before: one row per file, so the window over all of them is small
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))

    def numbered(scan: DataFrame) -> DataFrame:
        rows = scan.select("*", F.col("_metadata.file_path").alias("_file"), index.alias("_index")).join(files, "_file")
        return cast_to_raw(rows.withColumn("source_row_number", F.col("_before") + F.col("_index")).withColumn("source_month", F.lit(source_month)))

    return reduce(lambda a, b: a.unionByName(b), [numbered(s) for s in scans])


def read_months(spark: SparkSession, paths_by_month: dict[str, str]) -> DataFrame:
    """Read each month with its own physical schema, cast, then union by name."""
    frames = [read_month(spark, path, month) for month, path in sorted(paths_by_month.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---------------------------------------------------------------------------
# Driver-table trip view (test carrier): one trip per ``events`` row
# ---------------------------------------------------------------------------

EVENTS_MONTH = "2024-01"


def _every(rn: Column, n: int) -> Column:
    return rn % n == 0


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def _once(trips: DataFrame) -> DataFrame:
    """The same rows and columns, each column computed once per row: Catalyst does not move predicates or
    projections through a generator, which otherwise repeat a column's whole expression wherever a rule names it,
    in methods too large to compile."""
    return trips.select(F.inline(F.array(F.struct(*trips.columns))))


def events_trip_view(spark: SparkSession, sf_dir: str, source_month: str = EVENTS_MONTH) -> DataFrame:
    """Trips derived deterministically from ``events`` (the fixture view of the test tables)."""
    return trips_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), source_month)


def trips_from_events(ev: DataFrame, source_month: str = EVENTS_MONTH) -> DataFrame:
    """Map ``events`` rows (batch or stream) to raw trip rows.

    Each rule is a fixed residue of the row number, so every reject and flag rule fires on a
    known share of rows. All expressions are built-in Column functions (codegen, no UDF) and
    row-local, so the same mapping serves a streaming source unchanged.
    """
    rn = F.col("event_id") + F.lit(1)
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(
        rn.alias("rn"),
        "user_id",
        "event_type",
        "value",
        "ts",
        k.alias("k"),
    )
    rn, k, ts, value, user = F.col("rn"), F.col("k"), F.col("ts"), F.col("value"), F.col("user_id")
    day, hour = 86400, 3600
    ride = k * 30 + 60
    # Pickup and dropoff as one integer-second offset from ``ts`` (timestamp_ntz arithmetic is
    # exact, so +/- N days == +/- N*86400 seconds): one small expression per column, which keeps
    # the predicates Catalyst pushes into the scan filter small enough to JIT.
    pickup_shift = F.when(_every(rn, 113), F.lit(-31 * day)).when(_every(rn, 127), F.lit(31 * day)).otherwise(0)
    pickup = F.when(_every(rn, 97), F.lit(None).cast("timestamp_ntz")).otherwise(_plus_seconds(ts, pickup_shift))
    dropoff_shift = (
        F.when(_every(rn, 53), F.lit(-60))
        .when(_every(rn, 211), F.lit(40 * day))
        .when(_every(rn, 1999), F.lit(20 * hour))
        .when(_every(rn, 113), F.lit(-31 * day) + ride)
        .when(_every(rn, 127), F.lit(31 * day) + ride)
        .otherwise(ride)
    )
    dropoff = F.when(_every(rn, 89), F.lit(None).cast("timestamp_ntz")).otherwise(_plus_seconds(ts, dropoff_shift))
    null_d = F.lit(None).cast("double")
    trips = base.select(
        rn.alias("source_row_number"),
        F.when(_every(rn, 83), F.lit(9)).otherwise(F.lit(1) + user % 2).cast("bigint").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.when(_every(rn, 2909), F.lit(float("nan")))
        .when(_every(rn, 71), null_d)
        .when(_every(rn, 73), F.lit(-1.0))
        .otherwise(k % 7)
        .cast("double")
        .alias("passenger_count"),
        F.when(_every(rn, 31), F.lit(0.0))
        .when(_every(rn, 101), null_d)
        .when(_every(rn, 103), F.lit(float("nan")))
        .otherwise(value / 10.0)
        .alias("trip_distance"),
        F.when(_every(rn, 2503), F.lit(float("nan")))
        .when(_every(rn, 79), F.lit(99.0))
        .otherwise((F.lit(1) + k % 6).cast("double"))
        .alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.when(_every(rn, 2707), F.lit(3_000_000_000)).otherwise(F.lit(1) + user % 27).cast("bigint").alias("PULocationID"),
        (F.lit(1) + k % 27).cast("bigint").alias("DOLocationID"),
        F.when(F.col("event_type") == "purchase", 1)
        .when(F.col("event_type") == "view", 2)
        .when(F.col("event_type") == "click", 3)
        .when(F.col("event_type") == "signup", 4)
        .when(_every(rn, 5), 99)
        .otherwise(1)
        .cast("bigint")
        .alias("payment_type"),
        F.when(_every(rn, 41), -value).when(_every(rn, 107), null_d).otherwise(value).alias("fare_amount"),
        F.when(_every(rn, 61), null_d).otherwise(F.lit(0.5)).alias("extra"),
        F.when(_every(rn, 137), null_d).otherwise(F.lit(0.5)).alias("mta_tax"),
        F.when(_every(rn, 67), null_d).otherwise(value * 0.2).alias("tip_amount"),
        F.when(_every(rn, 131), F.lit(float("inf")))
        .when(_every(rn, 157), null_d)
        .otherwise(F.lit(0.0))
        .alias("tolls_amount"),
        F.when(_every(rn, 139), null_d).otherwise(F.lit(0.3)).alias("improvement_surcharge"),
        F.when(_every(rn, 3001), F.lit(9.1e16))
        .when(_every(rn, 43), F.lit(-1.0))
        .when(_every(rn, 109), null_d)
        .otherwise(value * 1.25)
        .alias("total_amount"),
        F.when(_every(rn, 149), null_d).otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.when(_every(rn, 151), null_d).otherwise(F.lit(0.0)).alias("airport_fee"),
    )
    return _once(cast_to_raw(trips)).withColumn("source_month", F.lit(check_month(source_month)))


def lineitem_trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per ``lineitem`` row: the second test carrier, of many months (the month of the ship date)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_shipdate is not null")
    rn = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    base = li.select("*", rn.alias("rn"), _plus_seconds(F.col("l_shipdate"), rn % 1440 * 60).alias("pickup"))
    rn, fare = F.col("rn"), F.col("l_extendedprice") / 100.0
    ride = _plus_seconds(F.col("pickup"), F.lit(60) + F.col("l_partkey") % 100 * 30)
    trips = base.select(
        rn.alias("source_row_number"),
        (F.lit(1) + F.col("l_suppkey") % 2).alias("VendorID"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.when(_every(rn, 89), F.lit(None).cast("timestamp_ntz")).otherwise(ride).alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.when(_every(rn, 31), F.lit(0.0)).otherwise(F.col("l_quantity") / 10.0).alias("trip_distance"),
        (F.lit(1) + F.col("l_linenumber") % 6).cast("double").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        (F.lit(1) + F.col("l_suppkey") % 27).alias("PULocationID"),
        (F.lit(1) + F.col("l_partkey") % 27).alias("DOLocationID"),
        (F.lit(1) + F.col("l_linenumber") % 6).cast("bigint").alias("payment_type"),
        F.when(_every(rn, 41), -fare).otherwise(fare).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (fare * 0.2).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (fare * 1.25).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
        _ship_month().alias("source_month"),
    )
    return _once(cast_to_raw(trips))


def _ship_month() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM")


def lineitem_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """The months of ``lineitem_trip_view``, from the first to the last."""
    ends = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.min(_ship_month()).alias("a"), F.max(_ship_month()).alias("b")).first()
    return months_between(ends.a, ends.b) if ends.a else []


def months_between(first: str, last: str) -> list[str]:
    """All months from one to another, as YYYY-MM."""
    return [str(m) for m in pd.period_range(check_month(first), check_month(last), freq="M")]
