"""Operations read models: publication state (W1, J6, J7, A18, M3), quality summary (A17, M4),
fingerprints (W2), thresholds (W3), alerts (M5, L7), options and coverage (A19, A29, M2),
staleness (H7) and alert-payload redaction (H4)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import (
    SAFE_ALERT_FIELDS,
    SENSITIVE_KEY_PATTERN,
    SENSITIVE_VALUE_PATTERN,
)


def latest_per(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per ``key`` under ``order`` (DISTINCT ON). Partitioned by key,
    so each task holds only the rows of its keys."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def warehouse_version(runs: DataFrame) -> DataFrame:
    """Max successful run id as text, '0' when there is none."""
    return runs.filter(F.col("status") == "success").agg(
        F.coalesce(F.max("id").cast("string"), F.lit("0")).alias("warehouse_version")
    )


def publication_state(runs: DataFrame, assets: DataFrame) -> DataFrame:
    """M3: latest run per month, synthetic-source flag (EXISTS on month + hash, J6) and the
    warehouse version (J7: the one-row max over all runs, carried by a window over the run
    table instead of a join)."""
    # one run per month is left before the one-row maximum is attached
    per_month = runs.groupBy("source_month").agg(
        F.max_by(F.struct(*runs.columns), "id").alias("r"), F.max(F.when(F.col("status") == "success", F.col("id"))).alias("_ok"))
    newest = F.max("_ok").over(Window.partitionBy()).cast("string")
    latest = per_month.select("r.*", F.coalesce(newest, F.lit("0")).alias("warehouse_version"))
    synthetic = (
        assets.filter(F.col("is_synthetic"))
        .select(F.col("source_month").alias("_m"), F.col("sha256").alias("_h"))
        .distinct()
        .withColumn("_synthetic", F.lit(True))
    )
    j = latest.join(synthetic, (latest.source_month == synthetic._m) & (latest.source_version == synthetic._h), "left")
    return j.select(
        "source_month",
        "status",
        F.col("finished_at").alias("published_at"),
        "source_rows",
        "accepted_rows",
        "rejected_rows",
        "flagged_rows",
        F.col("accepted_rows").alias("loaded_rows"),
        F.col("accepted_rows").alias("published_rows"),
        "source_version",
        "threshold_version_id",
        "reference_snapshot_id",
        F.coalesce(F.col("_synthetic"), F.lit(False)).alias("is_synthetic"),
        "warehouse_version",
    )


def quality_summary(summary: DataFrame) -> DataFrame:
    """Issue rows by month, code and severity."""
    return summary.groupBy("source_month", "issue_code", "severity").agg(
        F.sum("row_count").cast("bigint").alias("row_count")
    )


def fingerprints(assets: DataFrame) -> DataFrame:
    """Latest fingerprint per month (ingested_at desc, id as tie-break)."""
    latest = latest_per(assets, "source_month", [F.col("ingested_at").desc(), F.col("id").desc()])
    return latest.select(
        "source_month", "sha256", "parquet_schema_fingerprint", "byte_size", "row_count", "is_synthetic",
        "ingested_at",
    )


def thresholds(runs: DataFrame) -> DataFrame:
    """Threshold and snapshot ids of the latest successful run per month."""
    latest = latest_per(runs.filter(F.col("status") == "success"), "source_month", [F.col("id").desc()])
    return latest.select(
        "source_month",
        "threshold_version_id",
        "reference_snapshot_id",
        F.lit(None).cast("int").alias("k"),
        F.lit(None).cast("double").alias("normalized_rank_error"),
        F.lit(None).cast("string").alias("baseline_months"),
    )


def alerts(runs: DataFrame, limit: int = 20) -> DataFrame:
    """M5 + L7: non-success runs as alerts, newest first, last ``limit``."""
    return (
        runs.filter(F.col("status") != "success")
        .select(
            F.coalesce("finished_at", "started_at").alias("occurred_at"),
            F.lit("pipeline").alias("source"),
            F.col("status").alias("severity"),
            F.concat_ws(" / ", "dag_id", "run_id").alias("event_summary"),
        )
        .orderBy(F.col("occurred_at").desc(), F.col("event_summary"))
        .limit(limit)
    )


def is_stale_column(published_at: Column, now: Column, hours: int = 36) -> Column:
    """H7: null or older than ``hours`` at ``now``."""
    return published_at.isNull() | ((now - published_at) > F.expr(f"INTERVAL {int(hours)} HOURS"))


# --- M2 options and coverage -------------------------------------------------------------


def date_coverage(view: DataFrame) -> DataFrame:
    """First and last pickup date of the published metrics; an error when nothing is published."""
    empty = F.raise_error(F.lit("no published metrics")).cast("date")
    return view.agg(F.coalesce(F.min("pickup_date"), empty).alias("minimum_date"), F.max("pickup_date").alias("maximum_date"))


def filter_options(view: DataFrame) -> DataFrame:
    """Distinct (key, label) options per dimension and the non-null boroughs, as one long
    frame (option_kind, option_key, option_label), in one pass over the mart view."""
    kinds = [("zone", "pickup_zone_key", "pickup_zone_label"), ("payment", "payment_type_key", "payment_type_label"),
             ("vendor", "vendor_key", "vendor_label"), ("rate", "rate_code_key", "rate_code_label")]
    option = [F.struct(F.lit(kind).alias("option_kind"), F.col(key).cast("int").alias("option_key"),
                       F.col(label).alias("option_label")) for kind, key, label in kinds]
    option.append(F.struct(F.lit("borough").alias("option_kind"), F.lit(None).cast("int").alias("option_key"),
                           F.col("pickup_borough").alias("option_label")))
    rows = view.select(F.inline(F.array(*option))).distinct()
    return rows.filter((F.col("option_kind") != "borough") | F.col("option_label").isNotNull())


# --- H4 redaction ----------------------------------------------------------------------------


#: Levels of nested objects and lists that Column expressions look into; rows that go deeper are
#: redacted by ``_deep_redactor``.
REDACTION_DEPTH = 4
_DEEPER = "\ue000deeper\ue000"
#: Payloads that ``_deep_redactor`` holds as Python values at a time.
REDACTION_ROWS = 64


def _redacted(value: Column, depth: int) -> Column:
    """The text of a JSON value of a safe field: objects by key, lists by element, other values masked."""
    masked = F.regexp_replace(value, SENSITIVE_VALUE_PATTERN, "$1=[REDACTED]")
    if depth == 0:
        return F.when(value.rlike(r"^[\[{]"), F.lit(_DEEPER)).otherwise(masked)
    fields = F.from_json(value, "map<string,string>")
    items = F.from_json(value, "array<string>")
    return (
        F.when(value.startswith("{") & fields.isNotNull(), F.to_json(_redacted_fields(fields, depth - 1)))
        .when(value.startswith("[") & items.isNotNull(), F.to_json(F.transform(items, lambda v: _redacted(v, depth - 1))))
        .otherwise(masked)
    )


def _redacted_fields(fields: Column, depth: int) -> Column:
    safe = F.array(*[F.lit(k) for k in SAFE_ALERT_FIELDS])
    return F.transform_values(
        fields,
        lambda k, v: F.when(k.rlike(SENSITIVE_KEY_PATTERN), F.lit("[REDACTED]"))
        .when(F.array_contains(safe, k), _redacted(v, depth))
        .otherwise(F.lit("[OMITTED]")),
    )


def _deep_redactor():
    """An Arrow function with the same rules and no limit of depth; rows that need none come as null. A batch goes
    through it in pieces: nested texts, whose escapes double with each level, are never held for a whole batch. All
    it uses is local, so that workers need not import this package."""
    safe, secret_key, secret, piece = frozenset(SAFE_ALERT_FIELDS), SENSITIVE_KEY_PATTERN, SENSITIVE_VALUE_PATTERN, REDACTION_ROWS

    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import json
        import re
        import sys

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))

        def text(value):
            """A parsed JSON value as ``from_json`` gives it in a map of strings."""
            return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)

        def fields(found):
            return {k: "[REDACTED]" if re.search(secret_key, k) else masked(text(v)) if k in safe else "[OMITTED]" for k, v in found.items()}

        def masked(value):
            if value is None:
                return None
            if value[:1] in ("{", "["):
                try:
                    found = json.loads(value)
                    return text(fields(found) if isinstance(found, dict) else [masked(text(v)) for v in found])
                except ValueError:
                    pass  # not JSON: masked as text
            return re.sub(secret, r"\1=[REDACTED]", value, flags=re.ASCII)

        for batch in batches:
            for at in range(0, len(batch), piece):
                found = [None if p is None else list(fields(json.loads(p)).items()) for p in batch.slice(at, piece).to_pylist()]
                yield pa.array(found, pa.map_(pa.string(), pa.string()))

    return F.arrow_udf(redact, T.MapType(T.StringType(), T.StringType()))


def redact_payload(payload: Column, depth: int = REDACTION_DEPTH) -> Column:
    """H4 over a JSON object string: a sensitive key's value becomes '[REDACTED]', a key outside the safe
    list '[OMITTED]', and ``key=value`` secrets in the whole text of safe values are masked. Objects and
    lists in safe fields are treated the same way, at any depth: ``depth`` levels by Column expressions,
    the rows that go deeper by an Arrow function. Returns ``map<string,string>``; nested values are JSON
    text, their numbers and booleans as strings."""
    found = _redacted_fields(F.from_json(payload, "map<string,string>"), depth)
    deeper = F.coalesce(F.exists(F.map_values(found), lambda v: F.coalesce(v.contains(_DEEPER), F.lit(False))), F.lit(False))
    return F.when(deeper, _deep_redactor()(F.when(deeper, payload))).otherwise(found)
