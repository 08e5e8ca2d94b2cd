"""The monthly publish job (entry 1 of the reference): raw month(s) -> rules -> quarantine,
facts, issues, quality summary, hourly mart, dimensions, gates and the run record.

Execution shape (per job, any number of months):

1. one scan of the raw files classifies every row and writes a staging table partitioned by
   (source_month, is_rejected): every later output reads that stage with partition pruning
   instead of re-running the rules, and the written stage cuts the lineage;
2. outlier bounds: one tiny aggregate per month, written (pinned) and joined back;
3. facts: lookups of the small dimensions, gathered by month and sorted by pickup time within files
   for min/max skipping, written as a new publication beside the published one;
4. mart and gates read the written facts of that publication;
5. the run record is committed last: it names the publication and the versions of the reference tables, so that
   one file switches all tables of the month and the dimensions they refer to, and a publish that fails before or
   in its gates changes nothing for readers. Two publishers are ordered by their commits: the later one merges its
   assets and calendar with the earlier one's, and starts again if both gave out surrogate keys.
"""

from __future__ import annotations

import datetime as _dt
import logging
import os
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import dims as D
from tripmart.operators import outliers, rules
from tripmart.operators.convert import convert_accepted
from tripmart.operators.explorer import file_ranges
from tripmart.operators.fact import Dimensions, build_facts, duplicate_identities, null_key_counts, orphan_counts
from tripmart.operators.mart import hourly_mart, metrics_view
from tripmart.schema import PAYMENT_TYPE_LOOKUP, RATE_CODE_LOOKUP, RAW_TRIP, VENDOR_LOOKUP
from tripmart.sources.store import REFERENCES, Head, TableStore
from tripmart.sources.trips import check_contract

REF_TABLES = {
    "dim_vendor": VENDOR_LOOKUP,
    "dim_payment_type": PAYMENT_TYPE_LOOKUP,
    "dim_rate_code": RATE_CODE_LOOKUP,
}

RUN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("source_month", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("accepted_rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("flagged_rows", T.LongType()),
        T.StructField("source_version", T.StringType()),
        T.StructField("threshold_version_id", T.StringType()),
        T.StructField("reference_snapshot_id", T.StringType()),
        T.StructField("publication", T.StringType()),
    ]
)

#: A commit: the run records with the versions of the reference tables.
COMMIT_SCHEMA = T.StructType([*RUN_SCHEMA.fields, T.StructField(REFERENCES, T.MapType(T.StringType(), T.StringType()))])

#: Dimensions whose keys are given out by a publish: two publishers of one such table cannot both be right.
SURROGATE_TABLES = [*REF_TABLES, "dim_taxi_zone"]
REFERENCE_TABLES = [*SURROGATE_TABLES, "dim_date", "dim_time", "source_asset"]
ATTEMPTS = 5

VERSIONED = ["quarantine_rejected", "outlier_bounds", "fact_trips", "trip_quality_issue", "quality_result_summary", "trip_metrics_hourly", "trip_metrics_view",
             "fact_files"]

ASSET_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source_month", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("byte_size", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("is_synthetic", T.BooleanType()),
        T.StructField("parquet_schema_fingerprint", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


_LOG = logging.getLogger("tripmart.publish")


@contextmanager
def _step(name: str, timings: dict):
    """Record a step's wall time; printed when ``TRIPMART_TRACE`` is set."""
    t0 = time.perf_counter()
    yield
    timings[name] = round(time.perf_counter() - t0, 3)
    if os.environ.get("TRIPMART_TRACE"):
        print(f"[publish] {name}: {timings[name]:.2f}s", flush=True)
    _LOG.info("publish step %s took %.2fs", name, timings[name])


@dataclass
class SourceAsset:
    source_month: str
    source_asset_id: str
    source_version: str
    byte_size: int | None = None
    is_synthetic: bool = False
    schema_fingerprint: str | None = None


@dataclass
class PublishResult:
    run_ids: dict
    counts: list
    warnings: list
    timings: dict | None = None


# ---------------------------------------------------------------------------
# dimensions
# ---------------------------------------------------------------------------


class PublishConflict(RuntimeError):
    """Another publisher committed first and gave out surrogate keys of the same dimension."""


def write_dimensions(spark: SparkSession, store: TableStore, zone_candidates: DataFrame, months: list[str],
                     base: dict[str, str], publication: str) -> dict[str, str]:
    """Versions of the dimensions that miss reference rows or calendar days of this publish, on top
    of the versions ``base``. Returns the versions to read, the new ones among them.

    The four reference dimensions share one schema: which of them miss a business key is one
    small job, and all that need rows are written by one write job.
    """
    from functools import reduce

    candidates = {
        table: spark.createDataFrame([(k, v, None) for k, v in lookup.items()],
                                     "business_key int, label string, attributes string")
        for table, lookup in REF_TABLES.items()
    }
    candidates["dim_taxi_zone"] = zone_candidates
    current = {t: store.read_version(t, base[t]) if t in base else D.empty_dimension(spark) for t in candidates}
    stale = [t for t in candidates if t not in base]
    existing = [t for t in candidates if t in base]
    if existing:
        probes = [
            candidates[t].filter(F.col("business_key") != 0)
            .join(current[t].select("business_key"), "business_key", "left_anti")
            .select(F.lit(t).alias("t")).limit(1)
            for t in existing
        ]
        stale += [r.t for r in reduce(lambda a, b: a.unionByName(b), probes).collect()]  # <= 4 rows
    store.write_references({t: D.insert_missing(current[t], candidates[t]) for t in stale}, publication)
    tables = base | dict.fromkeys(stale, publication)
    tables |= write_calendar(spark, store, months, base, publication)
    if "dim_time" not in base:
        store.write_references({"dim_time": D.time_dimension(spark)}, publication)
        tables["dim_time"] = publication
    return tables


def write_calendar(spark: SparkSession, store: TableStore, months: list[str], base: dict[str, str], publication: str) -> dict[str, str]:
    """A version of ``dim_date`` with the days of ``months``, unless ``base`` has them. Its keys are dates, so
    that any order of such merges gives the same rows."""
    new_days = D.calendar_for_months(spark.createDataFrame([(m,) for m in months], "source_month string"))
    if "dim_date" in base:
        old = store.read_version("dim_date", base["dim_date"])
        if new_days.join(old.select("date_key"), "date_key", "left_anti").isEmpty():
            return {}
        new_days = D.add_missing_days(old, new_days)
    store.write_references({"dim_date": new_days}, publication)
    return {"dim_date": publication}


def read_dimensions(store: TableStore, tables: dict[str, str] | None = None) -> Dimensions:
    """Dimensions in the published versions, or in those of ``tables``. Vendor/payment/rate/time are bounded by
    construction (written only from fixed lookups / 1,440 minutes)."""
    seen = store.head().tables if tables is None else tables
    names = {"zone": "dim_taxi_zone", "payment": "dim_payment_type", "vendor": "dim_vendor", "rate": "dim_rate_code",
             "date": "dim_date", "time": "dim_time"}
    return Dimensions(**{role: store.read_version(table, seen[table]) for role, table in names.items()})


# ---------------------------------------------------------------------------
# the job
# ---------------------------------------------------------------------------

STAGE_COLUMNS = [f.name for f in RAW_TRIP.fields] + [
    "source_row_number",
    "reject_codes",
    "has_quality_issue",
    "issue_codes",
    "source_month",
    "is_rejected",
]


def publish(
    spark: SparkSession,
    store: TableStore,
    raw: DataFrame,
    assets: list[SourceAsset],
    zone_candidates: DataFrame,
    bounds_method: str = "exact",
    dag_id: str = "local",
    fail_reject_percent: float | None = None,
    warn_reject_percent: float | None = None,
    threshold_version_id: str | None = None,
) -> PublishResult:
    """Publish the months of ``assets`` from ``raw``.

    ``bounds_method``: 'exact' (per-month exact quantiles, default), 'kll' (per-month sketch)
    or 'version' (a saved calibrated threshold version; the active one when
    ``threshold_version_id`` is None). A publisher that lost its dimensions to another one starts again, all gates
    included, at most ``ATTEMPTS`` times.
    """
    contract = check_contract(raw, check_rows=False)  # G2, whoever read the frame
    if not contract.is_valid:
        raise ValueError(f"source contract failed: {contract}")
    for left in reversed(range(ATTEMPTS)):
        try:
            return _publish_once(spark, store, raw, assets, zone_candidates, bounds_method, dag_id, fail_reject_percent,
                                 warn_reject_percent, threshold_version_id)
        except PublishConflict as conflict:
            _LOG.warning("publish starts again: %s", conflict)
            if not left:
                raise
    raise AssertionError


def _publish_once(spark: SparkSession, store: TableStore, raw: DataFrame, assets: list[SourceAsset], zone_candidates: DataFrame,
                  bounds_method: str, dag_id: str, fail_reject_percent: float | None, warn_reject_percent: float | None,
                  threshold_version_id: str | None) -> PublishResult:
    from tripmart.plans import thresholds as TH

    months = sorted(a.source_month for a in assets)
    started = _dt.datetime.now(_dt.timezone.utc)
    publication = f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    timings: dict = {}
    stage_path = f"{store.root}/_work/stage-{publication}"
    try:
        base = store.head()
        with _step("dimensions", timings):
            tables = write_dimensions(spark, store, zone_candidates, months, base.tables, publication)
            dims = read_dimensions(store, tables)
        # 1. classify once into a month x outcome partitioned stage (cuts lineage, pruned reads);
        # the rows that reach it are counted on the way
        with _step("stage", timings):
            seen = Observation()
            staged = rules.classify(raw).select(*STAGE_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows"))
            staged.write.partitionBy("source_month", "is_rejected").parquet(stage_path)
            stage = spark.read.schema(staged.schema).parquet(stage_path)
        with _step("counts", timings):
            counts = [r.asDict() for r in rules.reconciliation_counts(stage).collect()]  # one row per month
            if unlisted := sorted({c["source_month"] for c in counts} - set(months)):
                raise ValueError(f"rows of months without an asset: {', '.join(unlisted)}")
            warnings = rules.gate_reconciliation(counts, warn_reject_percent, fail_reject_percent)

        # 2. quarantine (K1): rejected rows with their reason codes
        with _step("quarantine", timings):
            rejected = stage.filter(F.col("is_rejected")).drop("is_rejected", "has_quality_issue", "issue_codes")
            store.write_version("quarantine_rejected", rejected, publication)

        # 3. bounds, pinned per month, then facts
        accepted_stage = stage.filter(~F.col("is_rejected"))
        converted = convert_accepted(accepted_stage)
        with _step("bounds", timings):
            if bounds_method == "version":
                threshold_version_id = threshold_version_id or TH.active_version_id(store)
                if threshold_version_id is None:
                    raise ValueError("bounds_method='version' needs a saved, activated threshold version")
                bounds = TH.version_bounds_for_months(spark, store, threshold_version_id, months)
            elif bounds_method == "kll":
                bounds = outliers.kll_bounds(converted)
            else:
                bounds = outliers.exact_bounds(converted)
            store.write_version("outlier_bounds", bounds, publication, gather=())
            pinned = store.read_version("outlier_bounds", publication)
        with _step("facts", timings):
            accepted = outliers.mark_outliers(converted, pinned)
            ident = spark.createDataFrame(
                [(a.source_month, a.source_asset_id, a.source_version) for a in assets],
                "source_month string, _asset string, _version string",
            )
            with_ident = accepted.join(F.broadcast(ident), "source_month", "left")  # one row per month
            facts = build_facts(with_ident, dims, F.col("_asset"), F.col("_version"))
            # by day: where a month is large, a file holds the trips of a day and its pickup range is narrow
            store.write_version("fact_trips", facts, publication, sort_within=["pickup_at_local", "source_row_number"],
                                gather=("source_month", "pickup_date_key"))

        # 4. issues (K8) and their summary (K7)
        with _step("issues", timings):
            issues = rules.issue_rows(accepted_stage).withColumn("severity", F.lit("warning"))
            store.write_version("trip_quality_issue", issues, publication)
            written_issues = store.read_version("trip_quality_issue", publication)
            store.write_version("quality_result_summary", rules.issue_summary(written_issues), publication, gather=())

        # 5. mart (K9) from the written facts
        with _step("mart", timings):
            written = store.read_version("fact_trips", publication)
            store.write_version("fact_files", file_ranges(written), publication, gather=())
            store.write_version("trip_metrics_hourly", hourly_mart(written), publication, gather=())
            # J4 once per publish: dashboards read labelled rows instead of joining five dimensions per frame
            labelled = metrics_view(store.read_version("trip_metrics_hourly", publication), dims)
            store.write_version("trip_metrics_view", labelled, publication, gather=())

        # 6. gates on what was written, before readers can see it: month bounds (K4), orphans and null
        # keys (G5), duplicates (G3), written = accepted and rejected
        with _step("gates", timings):
            gate = publish_gates(written, dims)
            gate |= written_gates(written, store.read_version("quarantine_rejected", publication), counts, seen.get["rows"])
            status = "success" if not any(gate.values()) else "failed"

        # 7. source assets (K6 upsert) and run records (K10): this commit publishes
        with _step("records", timings):
            snapshot = TH.reference_snapshot_id(dims.zone).first()[0]  # one hash over dimension rows
            run_ids = commit_runs(spark, store, counts, assets, status, started, dag_id, base=base, tables=tables,
                                  threshold_version_id=threshold_version_id, reference_snapshot_id=snapshot,
                                  publication=publication)
        if status != "success":
            raise RuntimeError(f"publish gates failed: {gate}")
    except BaseException:
        if not store.committed(publication):
            store.drop_publication([*VERSIONED, *REFERENCE_TABLES], publication)
        raise
    finally:
        store.delete_path(stage_path)
    return PublishResult(run_ids=run_ids, counts=counts, warnings=warnings, timings=timings)


def written_gates(facts: DataFrame, quarantine: DataFrame, counts: list[dict], source_rows: int) -> dict:
    """Rows that were written, against the rows that were read and classified. Per month; the
    collected frames have one row per month."""
    rows = {}
    for name, df in (("accepted_rows", facts), ("rejected_rows", quarantine)):
        rows[name] = {r["source_month"]: r["count"] for r in df.groupBy("source_month").count().collect()}
    wrong = {f"written_{name}": sum(abs(c[name] - by.get(c["source_month"], 0)) for c in counts) for name, by in rows.items()}
    return wrong | {"source_rows": abs(source_rows - sum(sum(by.values()) for by in rows.values()))}


def publish_gates(written: DataFrame, dims: Dimensions) -> dict:
    """K4 + G5 + G3 on the written facts. Month bounds and the nine foreign keys are checked in
    one pass (orphan joins are broadcast, no shuffle); duplicate identities need one distinct
    aggregate. Returns the violation counts (all zero on success)."""
    lo, hi = rules.month_key_bounds("source_month")
    flagged = written.withColumn("_out_of_month", (F.col("pickup_date_key") < lo) | (F.col("pickup_date_key") >= hi))
    extra = {"out_of_month": F.count_if(F.col("_out_of_month"))} | null_key_counts()
    orphan_row = orphan_counts(flagged, dims, extra=extra)
    result = {r.foreign_key: int(r.orphan_rows) for r in orphan_row.collect()}  # one row per check
    result["duplicates"] = int(duplicate_identities(written).agg(F.coalesce(F.sum("duplicate_rows"), F.lit(0))).first()[0])
    return result


def sweep_publications(store: TableStore, keep_hours: float = 24.0, now: _dt.datetime | None = None) -> list[str]:
    """Remove what no commit of the last ``keep_hours`` names, of month and reference tables."""
    return store.sweep([*VERSIONED, *REFERENCE_TABLES], keep_hours, now)


def merged_assets(spark: SparkSession, store: TableStore, assets: list[SourceAsset], counts: list[dict], base: dict[str, str]) -> DataFrame:
    """K6: insert or update source assets; an update only changes row_count and ingested_at.
    A keyed full-outer merge with the version in ``base`` of the (small) asset table."""
    now = _dt.datetime.now(_dt.timezone.utc)
    rows = {c["source_month"]: c["source_rows"] for c in counts}
    new = spark.createDataFrame(
        [
            (a.source_asset_id, a.source_month, a.source_version, a.byte_size, rows.get(a.source_month, 0),
             a.is_synthetic, a.schema_fingerprint, now)
            for a in assets
        ],
        ASSET_SCHEMA,
    )
    if "source_asset" not in base:
        return new
    old = store.read_version("source_asset", base["source_asset"])
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns])
    j = old.join(n, old.id == n.n_id, "full_outer")
    return j.select(
        F.coalesce("id", "n_id").alias("id"),
        F.coalesce("source_month", "n_source_month").alias("source_month"),
        F.coalesce("sha256", "n_sha256").alias("sha256"),
        F.coalesce("byte_size", "n_byte_size").alias("byte_size"),
        F.coalesce("n_row_count", "row_count").alias("row_count"),
        F.coalesce("is_synthetic", "n_is_synthetic").alias("is_synthetic"),
        F.coalesce("parquet_schema_fingerprint", "n_parquet_schema_fingerprint").alias("parquet_schema_fingerprint"),
        F.coalesce("n_ingested_at", "ingested_at").alias("ingested_at"),
    )


def _references(spark: SparkSession, store: TableStore, assets: list[SourceAsset], counts: list[dict], base: Head, head: Head,
                tables: dict[str, str], publication: str, version: str) -> dict[str, str]:
    """The reference versions that a commit on top of ``head`` names: ``head``'s, this publish's new dimensions, and
    its assets (and calendar days, if ``head`` has other ones) merged with ``head``'s as ``version``."""
    fresh = {t: v for t, v in tables.items() if v == publication}
    moved = {t for t in REFERENCE_TABLES if head.tables.get(t) != base.tables.get(t)}
    if clash := sorted(moved & set(SURROGATE_TABLES) & set(fresh)):
        raise PublishConflict(f"commit {head.number} has other keys of {', '.join(clash)}")
    named = head.tables | {t: v for t, v in fresh.items() if t not in moved}
    if "dim_date" in moved & set(fresh):
        named |= write_calendar(spark, store, sorted(a.source_month for a in assets), head.tables, version)
    store.write_references({"source_asset": merged_assets(spark, store, assets, counts, head.tables)}, version)
    return named | {"source_asset": version}


def commit_runs(spark: SparkSession, store: TableStore, counts: list[dict], assets: list[SourceAsset],
                status: str, started: _dt.datetime, dag_id: str, base: Head, tables: dict[str, str], publication: str,
                threshold_version_id: str | None = None, reference_snapshot_id: str | None = None) -> dict:
    """One run row per month, with ids that follow those of the commit before. If another publisher takes the
    commit number first, ids and merges are made anew on its commit; each failed try is another one's commit."""
    by_month = {c["source_month"]: c for c in counts}
    tries = 0
    while True:
        head = store.head()
        tries += 1
        named = None
        if status == "success":
            named = _references(spark, store, assets, counts, base, head, tables, publication, f"{publication}-{tries}")
        finished = _dt.datetime.now(_dt.timezone.utc)
        rows, ids = [], {}
        for i, a in enumerate(sorted(assets, key=lambda x: x.source_month)):
            c = by_month.get(a.source_month, {})
            ids[a.source_month] = head.next_id + i
            rows.append(
                (
                    head.next_id + i, dag_id, f"{dag_id}-{a.source_month}-{a.source_version[:12]}", "publish_month",
                    a.source_month, status, started, finished, (finished - started).total_seconds(),
                    c.get("source_rows", 0), c.get("accepted_rows", 0), c.get("rejected_rows", 0),
                    c.get("flagged_rows", 0), a.source_version, threshold_version_id, reference_snapshot_id,
                    publication, named,
                )
            )
        if store.commit(spark.createDataFrame(rows, COMMIT_SCHEMA), head.number + 1):
            return ids
