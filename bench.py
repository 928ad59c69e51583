"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1 after a warm-up)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gapweave.plans.catalog import QUERIES  # noqa: E402
from gapweave.session import build_session  # noqa: E402

HEADLINE = [
    "column_profile_sketched",
    "type_profile",
    "describe_columns",
    "iqr_summary",
    "limit_summary",
    "box_statistics",
    "correlations",
    "line_fit",
    "weighted_line_fit",
    "frequent_combinations",
    "group_growth",
    "integrity_violations",
    "constraints",
    "relation_summary",
    "scores_aligned",
    "merge_similar_names",
    "group_similar_combinations",
    "hierarchy_fill",
    "score_grade_fill",
    "stratified_median_fill",
    "knn_labels",
    "knn_numbers",
    "chained_fill",
    "density_clusters",
    "projection_scores",
    "class_report",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"), shared=tempfile.mkdtemp(prefix="gapweave-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    repeats = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
