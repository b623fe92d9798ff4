"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line with per-query wall seconds.

Each query is executed once, in full, through the no-op sink (every row is
produced, nothing is shipped to the driver). The raw view is landed once
(timed as ``land_raw_demand``), and so does the cleaned table; a JIT warm-up runs on the smallest fixture."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandlens.plans.catalog import QUERIES, cleaned_demand  # noqa: E402
from demandlens.session import build_session  # noqa: E402
from demandlens.sources.fixture import landed_raw_demand  # noqa: E402

HEADLINE = [
    "clean_demand",
    "warehouse_outliers",
    "quality_summary",
    "cleaning_step_report",
    "handle_nulls_median",
    "demand_features",
    "describe_demand",
    "month_dow_heatmap",
    "warehouse_impact",
    "pareto_categories",
    "seasonal_boxplot_stats",
    "demand_acf",
    "seasonal_decompose",
    "lag_pairs",
    "leaderboard",
    "score_request_features",
    "forecast_tournament",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = build_session(
        app_name="demandlens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    # warm-up, not timed: JVM JIT of the cleaning and window code paths on
    # the smallest fixture (nothing of the measured scale is read or cached)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir.rstrip("/"):
        for key in ("clean_demand", "demand_features"):
            QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    QUERIES["raw_demand"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    # the raw view lands once per session (the ingest of the raw files)
    t0 = time.time()
    landed_raw_demand(spark, sf_dir)
    times["land_raw_demand"] = round(time.time() - t0, 3)
    # so does the cleaned table that exploration, training and scoring read
    t0 = time.time()
    cleaned_demand(spark, sf_dir)
    times["land_cleaned_demand"] = round(time.time() - t0, 3)
    failed = {}
    for key in only or HEADLINE:
        t0 = time.time()
        try:
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.time() - t0, 3)
        except Exception as exc:  # keep measuring the others; report it
            failed[key] = repr(exc)[:300]
            print(f"bench: {key} failed: {failed[key]}", file=sys.stderr)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
