"""Time the headline queries: one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_ALL (every query) steer it."""

from __future__ import annotations

import json
import os
import sys
import time

from waymark.queries import QUERIES, load_all
from waymark.session import build_session

# Headline queries: the largest joins, aggregations, orderings and geometry jobs of the library.
HEADLINE = [
    "eph_by_country", "eph_weighted", "metric_levels", "failed_routes_by_country", "bootstrap_interval", "extrapolated_totals",
    "describe_features", "feature_statistics", "threshold_sweep", "auc", "calibration_table", "empirical_cdf",
    "reuse_known_routes", "reuse_known_sections", "merge_error_logs", "sanity_checks", "training_join", "latest_per_key",
    "dedup_rounded_stretch", "dedup_chain", "km_cap", "time_split_train", "finished_run_metrics", "lane_enrichment", "edge_runs",
    "feature_weights", "sign_features", "route_haversine_length", "route_geodesic_length", "route_hausdorff",
    "route_mutual_containment", "stretch_turn_features", "trace_features", "route_comparison_states", "matched_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    load_all()
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(cpus, 2 * int(cpus) if cpus.isdigit() else 16, "waymark-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    times, failed = {}, {}
    for name in names:
        start = time.time()
        try:
            # noop: every row and column is produced, nothing is stored.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        except Exception as error:  # one broken query must not hide the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
        print(f"{name} {times.get(name, failed.get(name))}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
