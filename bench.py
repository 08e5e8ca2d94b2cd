"""Benchmark: the publish job plus the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line: {"metric", "value" (sum of per-query seconds), "unit", "queries", "sf", ...}.

* ``etl_publish``: the monthly publish job end to end (rules, stage, quarantine, bounds, facts,
  issues, summary, mart, gates, run record) into a fresh warehouse folder.
* ETL operators on the raw model and dashboard/explorer queries on the published warehouse, each
  timed as plan + full execution (``collect`` of the result, ``noop`` write for wide ones). Every
  repeat builds a new frame, so that no shuffle of the run before is reused; of ``BENCH_REPEAT``
  (default 3) the median is reported.
* ``dashboard_load``: all 19 frames of one uncached dashboard load, collected at the same time from
  eight threads, as a page asks for them.
* ``sliding_window_events``: the streaming path to completion (availableNow).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from statistics import median

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "trip_reject_counts",
    "exact_bounds",
    "accepted_trips",
    "kpis",
    "daily_metrics",
    "hourly_metrics",
    "zone_metrics",
    "breakdown_payment",
    "revenue_components",
    "avg_fare_per_mile",
    "peak_hours",
    "revenue_by_payment",
    "filter_options",
    "explorer_page_next",
    "explorer_page_previous",
    "zone_movers",
    "kpi_comparison",
    "zone_quantile_classes",
    "fact_trips",
    "latest_run_state",
]
WIDE = {"accepted_trips", "fact_trips"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from tripmart.session import local_session, scratch_path

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(int(cpus) if cpus.isdigit() else 8, 1))))
    spark = local_session(cores=cpus, shuffle_partitions=shuffle, app="tripmart-bench")

    from tripmart.plans import warehouse as W
    from tripmart.plans.registry import QUERIES
    from tripmart.sources.store import TableStore

    times: dict[str, float] = {}

    # 1. publish into a fresh folder (timed), then register it for the warehouse queries
    t0 = time.perf_counter()
    store = TableStore(spark, scratch_path(spark, "bench-warehouse", unique=True))
    W.publish_events_month(spark, store, sf_dir)
    times["etl_publish"] = time.perf_counter() - t0
    key = (sf_dir, W._input_signature(spark, sf_dir), W._code_version())
    W._CACHE[(spark.sparkContext.applicationId, key)] = W.Warehouse(store)

    # 2. queries
    for name in HEADLINE:
        taken = []
        for _ in range(repeat):
            t = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            if name in WIDE:
                df.write.format("noop").mode("overwrite").save()
            else:
                df.collect()
            taken.append(time.perf_counter() - t)
        times[name] = median(taken)

    from tripmart.plans.dashboard import load_dashboard_data
    from tripmart.plans.registry import SECOND_HALF

    taken = []
    for _ in range(repeat):
        t = time.perf_counter()
        frames = load_dashboard_data(W.Warehouse(store), SECOND_HALF)
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda df: df.collect(), frames.values()))
        taken.append(time.perf_counter() - t)
    times["dashboard_load"] = median(taken)

    # 3. streaming to completion
    t = time.perf_counter()
    QUERIES["sliding_window_events"](spark, sf_dir).collect()
    times["sliding_window_events"] = time.perf_counter() - t

    out = {
        "metric": "total_seconds_publish_plus_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf,
        "config": {
            "master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": shuffle,
            "spark.sql.adaptive.enabled": True,
            "median_of": repeat,
        },
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
